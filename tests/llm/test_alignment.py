"""Alignment of tokenizers against whole encodings by the libraries themselves and a plain search for overlaps."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

PARTS = ["a", "the", "é", "日本", " ", "  ", "\n", "\t", "\n\n", " \n", "'s", "don't", "<|endoftext|>", "12345", "!!!", "\r\n", "\xa0", "▁", "\x00", "\x1c", "🙂", "ﬁ", "é", "x\ty", ";\r", "   ", "\v", "\f", "</s>", "<unk>", "<0x41>", "　"]


def odd_texts(n=300, seed=3):
    r = random.Random(seed)
    made = ["".join(r.choice(PARTS) for _ in range(r.randint(0, 25))) for _ in range(n)]
    return [*made, None, "", " ", "  ", "\n", "\t ", "a ", "▁", "same text", "same text", "word " * 3000, "x" * 5000]


def encoders():
    import sentencepiece
    from tokenizers import Tokenizer

    from loamline.llm import alignment

    a, b = alignment.paths()
    one, two = Tokenizer.from_file(a), sentencepiece.SentencePieceProcessor(model_file=b)
    one.encode_special_tokens = True
    letters = {c: i for i, c in enumerate(alignment._letters())}

    def encode(text):
        """(ids and ends in bytes) of both sides, or None."""
        if not text:
            return None
        raw = (" " + text).encode()
        x, y = one.encode(" " + text, add_special_tokens=False).ids, two.encode(text)
        ax = [bytes(letters[c] for c in one.id_to_token(i)) for i in x]
        by = [bytes([int(two.id_to_piece(i)[3:5], 16)]) if two.is_byte(i) else two.id_to_piece(i).replace("▁", " ").encode() for i in y]
        if b"".join(ax) != raw or b"".join(by) != raw:
            return None
        return x, np.cumsum([len(t) for t in ax]).tolist(), y, np.cumsum([len(t) for t in by]).tolist()

    return encode


def plain(texts):
    """By text: groups, links as pairs of ids."""
    encode, out = encoders(), []
    for t in texts:
        found = encode(t)
        if found is None:
            out.append(None)
            continue
        x, ex, y, ey = found
        cuts, links, groups, i, j = sorted(set(ex) & set(ey)), [], [], 0, 0
        for c in cuts:
            p, q = ex.index(c, i) + 1, ey.index(c, j) + 1
            groups.append((x[i:p], y[j:q]))
            links += [(x[u], y[v]) for u in range(i, p) for v in range(j, q) if max(ex[u - 1] if u else 0, ey[v - 1] if v else 0) < min(ex[u], ey[v])]
            i, j = p, q
        out.append((x, y, groups, links))
    return out


def expected(ids, texts):
    each = plain(texts)
    count = Counter(link for e in each if e for link in e[3])
    top = Counter()
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    rows = []
    for i, e in zip(ids, each, strict=True):
        if e is None:
            rows.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        x, y, groups, links = e
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        rows.append((i, len(x), len(y), len(groups), len(links), sum(count[k] == top[k[1]] for k in links), sum(count[k] for k in links), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(rows, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()), key=repr)


def test_query_equals_a_plain_search(spark):
    from loamline.llm import queries

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert got(queries.op13_token_alignment(spark, sf)) == expected([d.doc_id for d in docs], [d.text for d in docs])


@pytest.mark.parametrize("chunk", [1, 1 << 22])
def test_odd_texts(spark, chunk):
    from loamline.llm import alignment

    texts = odd_texts()
    rows = [(None if k % 7 == 0 else k // 2, t, 1.0, 2) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, total double, chunk int").repartition(3)
    assert got(alignment.aligned(docs, chunk_bytes=chunk)) == expected([r[0] for r in rows], texts)
    assert alignment.aligned(docs.limit(0)).collect() == []


def test_groups_as_lists(spark):
    from loamline.llm import alignment

    texts = odd_texts(80, 5)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r, want in zip(sorted(alignment.alignments(docs).collect()), plain(texts), strict=True):
        x, y, groups, _ = want or ([], [], [], [])
        assert (r.a_ids, r.b_ids) == (list(x), list(y))
        assert list(zip(r.group_a, r.group_b, strict=True)) == [(len(a), len(b)) for a, b in groups]


def test_small_memory_gives_the_same():
    from loamline.llm import alignment

    texts = odd_texts(400, 9)
    small, large = alignment.Aligner(*alignment.paths(), most=20), alignment.Aligner(*alignment.paths())
    for lo in range(0, 400, 40):
        x, y = small.align(texts[lo : lo + 40]), large.align(texts[lo : lo + 40])
        assert all(np.array_equal(getattr(x, f), getattr(y, f)) for f in x.__dataclass_fields__)
