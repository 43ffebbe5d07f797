"""Whole queries against plain versions that are written anew here, and both sides of every switch."""

import hashlib
import itertools
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def rows_of(df):
    return sorted(df.collect(), key=repr)


def test_language_scores(spark, docs):
    from loamline.llm import langid

    model = langid.fitted(docs, ~langid.held_out())
    vocab = langid.vocabulary(model.path)

    def log_sum(word):
        word, a = langid.START + word, [np.ones(len(model.languages), np.longdouble)]
        for j in range(1, len(word) + 1):
            ways = [a[j - n] * model.probs[vocab.get(word[j - n : j], 0)] for n in range(1, j + 1) if n == 1 or word[j - n : j] in vocab]
            a.append(sum(ways))
        return np.log(a[-1]).astype(float)

    some = docs.where("doc_id % 4 = 0")
    for r in langid.predicted(some.select("doc_id", "text"), model).collect():
        words = re.findall(r"[^\W\d_]+", (r.text or "").lower())
        total = sum((log_sum(w) for w in words), np.zeros(len(model.languages)))
        share = 1 / np.exp(total - total.max()).sum()
        assert (r.lang_pred, r.score) == (model.languages[int(total.argmax())] if words else "und", pytest.approx(share if words else 0, abs=1e-3))


def test_language_odd_texts(spark, docs):
    from loamline.llm import langid

    model = langid.fitted(docs)
    rows = [(1, "½ Ⅷ ² 12 _", 0.5), (2, None, 0.5), (3, "", 0.5), (4, "the ½and of", 0.5), (4, "the ½and of", 0.5), (None, "a" * 100_000, 0.5)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, score double")
    got = rows_of(langid.predicted(df, model))
    assert [(r.doc_id, r.lang_pred, r.score) for r in got if r.doc_id in (1, 2, 3)] == [(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0)]
    assert len(got) == 6 and all(0 <= r.score <= 1 and r.score != 0.5 for r in got)
    small = langid.MEMO_BYTES, langid.MEMO
    try:  # a memory that holds next to nothing gives the same
        langid.MEMO = 50
        texts = docs.select("text").limit(20).toPandas()["text"]
        import pyarrow as pa

        from loamline.llm import wordhash

        wordhash._holder.clear()
        less = model.predict(pa.array(texts))
        wordhash._holder.clear()
        langid.MEMO_BYTES, langid.MEMO = small
        assert less == model.predict(pa.array(texts))
    finally:
        langid.MEMO_BYTES, langid.MEMO = small


def near_links(docs):
    sets = {}
    for r in docs.collect():
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), r.text))
        sets[r.doc_id] = frozenset(zip(*[w[k:] for k in range(5)], strict=False)) if len(w) >= 5 else frozenset([tuple(w)])
    return {a: {b for b, y in sets.items() if a != b and 5 * len(x & y) >= 4 * len(x | y)} for a, x in sets.items()}


def least_of(links):
    out = {}
    for a in sorted(links):
        held = [a]
        while held:
            x = held.pop()
            if x not in out:
                out[x] = a
                held += links[x]
    return out


@pytest.mark.parametrize("broadcast", [1_000_000, 0])
def test_jaccard_classes(spark, docs, monkeypatch, broadcast):
    from loamline.llm import jaccard

    monkeypatch.setattr(jaccard, "BROADCAST_ROWS", broadcast)
    monkeypatch.setattr(jaccard, "BLOCK", 2 if not broadcast else jaccard.BLOCK)  # several blocks for each group
    links = near_links(docs)
    assert {r.doc_id: (r.class_id, r.n_links) for r in jaccard.classes(docs).collect()} == {a: (c, len(links[a])) for a, c in least_of(links).items()}


def test_secret_base_fields(spark, docs):
    from loamline.llm import queries, secrets

    kinds = [("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A, 12, 2), ("access", "AKIA[A-Z0-9]+", 0, 18, 0), ("hex", "[0-9a-f]+", 0, 16, 0)]
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in queries.op3_secret_scan(spark, SF).collect():
        found = [(m.start(), k, f"{name}:{m.start()}:{m.end()}") for k, (name, pattern, flags, least, g) in enumerate(kinds) for m in re.finditer(pattern, texts[r.doc_id], flags) if len(m[g]) >= least]
        n = Counter(k for _, k, _ in found)
        assert (r.n_assign, r.n_access, r.n_hex) == (n[0], n[1], n[2])
        base = [x for _, _, x in sorted(found)]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        spans = [x for x in r.spans.split(",") if x]
        assert [x for x in spans if not x.startswith("crf")] == base and spans == sorted(spans, key=lambda x: (int(x.split(":")[1]), ["assign", "access", "hex", "crf"].index(x.split(":")[0])))
    assert secrets._scan("", secrets.trained([])) == []


def test_viterbi():
    from loamline.llm import secrets

    r = np.random.default_rng(5)
    steps = r.normal(size=(3, 3))
    steps[secrets.OUT, secrets.INSIDE] = -1e9
    field = secrets.Field(r.normal(size=(secrets.SLOTS, 3)), steps)
    for n in range(1, 7):
        slots = [list(r.integers(0, secrets.SLOTS, 4)) for _ in range(n)]
        score = lambda y: sum(field.weights[s, k].sum() for s, k in zip(slots, y, strict=True)) + sum(steps[a, b] for a, b in zip(y, y[1:], strict=False))  # noqa: B023, E731
        best = max((y for y in itertools.product(range(3), repeat=n) if y[0] != secrets.INSIDE), key=score)
        assert field.decode(slots) == list(best)


@pytest.mark.parametrize("hosts", [200_000, 0])
def test_page_texts(spark, monkeypatch, hosts):
    import html as entities

    from loamline.llm import html

    monkeypatch.setattr(html, "BROADCAST_HOSTS", hosts)
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    want = Counter()
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html or "", re.S)
        blocks = re.split(r"</?(?:p|h1|li|ul)\b[^>]*>", inner[1]) if inner else []
        clean = [" ".join(entities.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in blocks]
        text = "\n".join(c for c in clean if c)
        want[(r.page_id, r.url, text, len(text))] += 1
    assert Counter(tuple(r) for r in html.extracted(pages).collect()) == want


def test_page_names(spark):
    from loamline.llm import html

    page = '<div class="post comment-open"><p>One long line of the article, all of it.</p><div class="related-work"><p>Work that is related to it.</p></div><p>See <math><mi>x</mi></math>.</p><div class="post-comments"><p>me</p></div><div id="site-footer">f</div><div class="cookie-notice">c</div></div>'
    rows = [(1, "http://h.org/a", page), (1, "http://h.org/a", page)]
    got = html.extracted(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert [r.text for r in got] == ["One long line of the article, all of it.\nWork that is related to it.\nSee x."] * 2


def test_kept_texts(spark, docs):
    import unicodedata

    from loamline.llm import quality

    rules = quality.Rules()
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(-1, "word " * 30 + "\n says click "), (-2, "here we go\n" + "word " * 30), (-3, "Menú\n" * 40 + "a b c d."), (-4, "Menu\n" * 40 + "a b c d."), (-5, "fin…\n" * 3 + "one two three four. " * 9), (-6, "Alle Rechte vorbehalten " * 20), (-7, None), (-8, "x"), (-9, "TOUS DROITS RÉSERVÉS\nConditions d’utilisation\n" * 15), (-10, "Politi\u0301ca de privacidad POLÍTICA DE PRIVACIDAD\n" * 20), (-11, "To read more of this you can click here, or else go on " + "and on " * 60), (-12, "a\nclick here click here\n\nclick here\n" + "b c d e f. " * 12)]
    got = {r.doc_id: (r.kept, r.n_lost_words) for r in quality.cleaned(spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)).collect()}
    other = {r.doc_id: (r.kept, r.n_lost_words) for r in quality.cleaned(spark.createDataFrame(rows[::-1], "doc_id bigint, text string").repartition(5)).collect()}
    assert got == other  # the verdict doesn't depend on neighbours
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        lost = 0
        for line in (text or "").split("\n"):
            w = re.findall(r"[^\x20\x09-\x0D]+", line)
            if not w:
                continue
            c = w[-1][-1]
            closed = c in ".!?:;\"')]}" or ord(c) > 127 and unicodedata.category(c)[0] == "P"
            bars = len(re.findall(r"[|>\t]", line))
            marked = sum(any(x in "#*$%&|<>" for x in t) for t in w)
            low = unicodedata.normalize("NFC", line).replace("’", "'").lower()
            phrased = any(p in low and len(w) <= 6 * len(p.split()) for p in rules.phrases)
            if len(w) < rules.open_words and not closed or bars >= rules.min_bars and len(w) <= rules.bar_words * bars or marked > rules.max_symbol * len(w) or phrased:
                lost += len(w)
        grams = defaultdict(list)
        for j in range(len(words) - 7):
            grams[tuple(words[j : j + 8])].append(j)
        repeated = len({j + d for at in grams.values() if len(at) > 1 for j in at for d in range(8)})
        kept = len(words) >= 20 and 100 * repeated <= 30 * len(words) and lost <= rules.max_loss * len(words)
        assert got[i] == (kept, lost), (i, text)


@pytest.mark.parametrize("parts", [1_000_000, 0])
def test_shards_follow_the_curve(spark, docs, monkeypatch, parts):
    from loamline.llm import sharding

    monkeypatch.setattr(sharding, "BROADCAST_PARTS", parts)
    at = defaultdict(list)
    for r in sharding.curve_shards(docs).collect():
        at[r.shard].append((r.slot, r.curve))
    along = [c for s in sorted(at) for _, c in sorted(at[s])]
    assert along == sorted(along) and len(along) == docs.count()


def test_text_cuts(spark):
    from loamline.llm import sharding

    names = [f"https://common.example.org/{k:04}" for k in range(1600)]
    cuts = sharding.text_cuts(spark.createDataFrame([(n,) for n in names], "source string"), "source", 16, 5)
    assert cuts == names[100::100]
    hot = spark.createDataFrame([("b",)] * 60 + [("a",)] * 20 + [("c",)] * 20 + [(None,)], "source string")
    assert sharding.text_cuts(hot, "source", 16, 5) == ["b", "c"]
    assert sharding.text_cuts(hot.limit(0), "source", 16, 5) == []


def test_written_shards(spark, tmp_path):
    from loamline.llm import sharding

    rows = [(1, "a", "s", "en", 1, "x"), (1, "a", "s", "en", 1, "x"), (None, "b", "s", None, 1, "y"), (2, None, None, "de", 0, "z")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string, n_chars bigint, shard string")
    sharding.write_shards(df, str(tmp_path / "out"), shards=2)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(back.columns) == ["doc_id", "lang", "n_chars", "shard", "source", "text"]
    assert rows_of(back.drop("shard").select(*[c for c in df.columns if c != "shard"])) == rows_of(df.drop("shard"))
    assert sorted(r["count"] for r in back.groupBy("shard").count().collect()) == [2, 2]


def test_best_fit_against_a_plain_search():
    from loamline.llm import packing

    r = np.random.default_rng(8)
    for capacity in (7, 64, 100):
        lengths = sorted(r.integers(1, capacity + 1, 300).tolist(), reverse=True)
        rooms, tight = [], []
        for n in lengths:
            fits = [x for x in rooms if x >= n]
            room = min(fits, default=capacity)
            if fits:
                rooms.remove(room)
            rooms.append(room - n)
            tight.append(capacity - room)
        number, offset = packing.best_fit(lengths, capacity)
        assert offset == tight and max(number) + 1 == len(rooms)


def test_groups_are_packed_from_the_longest_piece_down(spark):
    from loamline.llm import packing
    from loamline.llm.common import staged

    # by falling length 400 pairs fill 400 sequences; in the order given the short ones come first
    lengths = [1000 + k for k in range(400)] + [packing.CAPACITY - 1000 - k for k in range(400)]
    docs = spark.createDataFrame([(k, 0, 0, n, k) for k, n in enumerate(lengths)], packing.PIECES).repartition(7)
    rows = packing.pack(staged(docs)).collect()
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert len(rows) == 800 and len(bins) == 400
    for held in bins.values():
        assert [n for _, n in sorted(held)] == sorted((n for _, n in held), reverse=True) and sum(n for _, n in held) == packing.CAPACITY


def test_encoder_on_odd_texts():
    import random

    from loamline.llm import packing

    encode = packing.Encoder(packing.vocabulary_path(), 200)  # forgets nearly all
    r = random.Random(9)
    odd = ["".join(r.choice("aAbΣσς éÉß'’.,!12٣½ \t\n\r\x0b\xa0 　漢字🙂éİıſK_-\x1c\x85<|>") for _ in range(r.randint(0, 60))) for _ in range(1500)]
    odd += ["x <|endoftext|> Y", "", "<|startoftext|>", " ".join(odd) * 40]
    ids, first = encode.encoded(odd)
    assert all(encode.tokenizer.encode(t, add_special_tokens=False).ids == ids[first[k] : first[k + 1]].tolist() for k, t in enumerate(odd))


def test_contamination_of_odd_items(spark, monkeypatch):
    from loamline.llm import decontaminate

    bench = spark.createDataFrame([(1, "one two three four five six"), (None, "seven eight nine ten"), (2, None), (1, "one two three four five six")], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, "One two three four five six", 1), (1, "clean words only here", 2), (None, "say seven eight nine ten", 3), (3, None, 4), (4, "", 5)], "doc_id bigint, text string, n_hit int")
    for words in (4_000_000, 2):
        monkeypatch.setattr(decontaminate, "BROADCAST_WORDS", words)
        got = {(r.doc_id, r.n_words): (r.n_hit, r.n_items, r.contaminated) for r in decontaminate.contamination(docs, bench).collect()}
        assert got == {(1, 6): (6, 1, True), (1, 4): (0, 0, False), (None, 5): (4, 0, True), (3, 0): (0, 0, False), (4, 0): (0, 0, False)}
        assert sorted(r.n_hit for r in decontaminate.clean_documents(docs, bench).collect()) == [2, 4, 5]


def test_preferences_with_null_turns(spark):
    from loamline.llm import preferences

    turn = "array<struct<role: string, text: string>>"
    pairs = spark.createDataFrame([([("user", "hi"), ("assistant", None)], [("user", "hi"), (None, "b")], 7), (None, [], 8)], f"chosen {turn}, rejected {turn}, prompt int")
    a, b = sorted(preferences.formatted(pairs).collect(), key=lambda r: -r.n_prompt_turns)
    assert (a.prompt, a.chosen, a.chosen_mask, a.rejected, a.rejected_mask) == ("<|im_start|>user\nhi<|im_end|>\n", "<|im_start|>assistant\n<|im_end|>\n", "22:32", "<|im_start|>user\nb<|im_end|>\n", "")
    assert (b.prompt, b.chosen, b.rejected) == ("", "", "")
    empty = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert preferences.paired(empty).count() == 0


def test_pipeline_against_plain_stages(spark, docs):
    import corpus_pipeline
    from loamline.llm import decontaminate, packing, secrets

    stages = dict(corpus_pipeline.STAGES)
    kept = stages["jaccard_join"](spark, docs, SF)
    classes = least_of(near_links(docs))
    assert sorted(classes[r.doc_id] for r in kept.collect()) == sorted(set(classes.values()))
    clean = stages["decontamination"](spark, docs, SF)
    bad = {r.doc_id for r in decontaminate.contamination(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).where("contaminated").collect()}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in docs.collect()} - bad and bad
    texts = {r.doc_id: r.text for r in docs.collect()}
    hidden = {r.doc_id: r.text for r in stages["secret_scan"](spark, docs, SF).collect()}
    found = {(i, t[b:e]) for i, t in texts.items() for _, _, e, b in secrets.base_spans(t)}
    assert found and hidden.keys() == texts.keys() and not any(value in hidden[i] for i, value in found)
    packed = stages["best_fit_packing"](spark, docs, SF).groupBy("doc_id").sum("length").collect()
    encode = packing.Encoder(packing.vocabulary_path())
    assert {r[0]: r[1] for r in packed} == {i: len(encode(t)) // 4 + 1 for i, t in texts.items()}


def test_pipeline_odd_rows(spark):
    import corpus_pipeline

    long = "word and more of the same words " * 9000
    rows = [(1, None, "en"), (2, "", "en"), (3, "!!! ??", None), (4, "One two three four five six seven.", "en"), (5, "One two three four five six seven.", "en"), (5, "One two three four five six seven.", "en"), (None, "alone is here and there", None), (6, long, "en"), (7, "password=abcdef012345678901", "de")]
    odd = spark.createDataFrame([(i, t, g, "s", len(t or ""), 0.5, 1, "x") for i, t, g in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, row_key int, __row string")
    odd = odd.withColumn("__lang", F.lit("kept")).withColumn("__SCORE", F.lit(7)).withColumn("__redacted", F.col("text"))
    for df in (odd, odd.limit(0)):
        n = df.count()
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, df, SF)
            if name != "best_fit_packing":
                assert out.columns == df.columns, name
                assert out.where("__row = 'x' and __lang = 'kept' and __SCORE = 7 and __redacted <=> text or text like '%[SECRET]%'").count() == out.count(), name
                assert out.count() == {"language_id": min(n, 6), "jaccard_join": min(n, 7)}.get(name, n), name
            else:
                assert out.select("doc_id").distinct().count() == min(n, 8)


def test_query_of_url_rules_on_odd_rows(spark):
    from loamline.llm import urls

    pages = spark.createDataFrame([(1, None, "h"), (None, "", "h"), (2, "http://a.org/" + "x/" * 5000, "h"), (2, "http://a.org/" + "x/" * 5000, "h")], "page_id bigint, url string, host string")
    rules = [("org", "/x/x", "block"), ("org", "/x/x", "allow")]
    for make in (lambda p: urls.verdicts(p, rules), lambda p: urls.joined_verdicts(p, spark.createDataFrame(rules, "host string, path string, verdict string"))):
        got = make(pages).collect()
        assert Counter(r.verdict for r in got) == {"allow": 2, "block": 2} and {r.host for r in got} == {"", "a.org"}
        assert make(pages.limit(0)).count() == 0


def test_planted_secrets_in_texts_held_out(spark, docs):
    """The field is fitted on half of the texts; made secrets of another seed are planted in the other half."""
    import random

    from loamline.llm import secrets

    field = secrets.fitted(docs.where("doc_id % 2 = 0"))
    texts = [r.text for r in docs.where("doc_id % 2 = 1").collect() if r.text and len(r.text.split()) > 30]
    r, found, planted, exact = random.Random(11), 0, 0, 0
    made = [x for x in secrets.made_examples(900, 4321) if x[2]]
    for k, (chunk, before, [(s, e)]) in enumerate(made):
        words = texts[k % len(texts)].split(" ")[:200]
        at = r.randrange(len(words))
        head = " ".join([*words[:at], *before, ""])
        text = head + chunk + " " + " ".join(words[at:])
        lo, hi = len(head) + s, len(head) + e
        spans = [(b if k < 3 else a, z) for a, k, z, b in secrets._scan(text, field)]
        planted += 1
        found += any(a < hi and z > lo for a, z in spans)
        exact += (lo, hi) in spans
    n_words = sum(len(t.split()) for t in texts)
    false = sum(k == 3 for t in texts for _, k, _, _ in secrets._scan(t, field))
    print(f"recall {found / planted:.3f}, exact {exact / planted:.3f}, spans added {false} in {n_words} words")
    assert found >= 0.85 * planted and exact >= 0.75 * planted and false <= n_words / 1000
    for plain in ("id 123e4567-e89b-12d3-a456-426614174000 ok", "order ORD-2024-001234 sent", "see v0.9.1-14-gabc1234 and IMG_20240101.jpg"):
        assert secrets._scan(plain, field) == []
