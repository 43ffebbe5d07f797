"""The manifest against a plain tree, on odd rows and any number of them."""

import hashlib
import random
import zlib

import pytest


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def framed(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def lowered(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def climbed(nodes):
    """The root over nodes, and for each the siblings left and right by level."""
    paths, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, at in enumerate(places):
            run = nodes[at // 8 * 8 : at // 8 * 8 + 8]
            paths[k].append(("".join(run[: at % 8]), "".join(run[at % 8 + 1 :])))
        nodes = [sha(*nodes[k : k + 8]) for k in range(0, len(nodes), 8)]
        places = [at // 8 for at in places]
    return nodes[0] if nodes else None, paths


def expected(rows):
    """rows: (doc_id, text, lang, source, n_chars)."""
    leaf = lambda i, t, g, s, n: sha(*map(framed, (i, s, g, n, t)))
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for g in names:
        own = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees.append((own, *climbed([leaf(*r) for r in own])))
    root, tops = climbed([t[1] for t in trees])
    out = []
    for (own, subroot, paths), top in zip(trees, tops, strict=True):
        for r, path in zip(own, paths, strict=True):
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            d = leaf(r[0], lowered(r[1]) if bad else r[1], *r[2:])
            for left, right in path + top:
                d = sha(left, d, right)
            out.append((r[0], leaf(*r), subroot, root, sha(*(left + right for left, right in path + top)), d, d == root))
    return sorted(out, key=repr)


def made(n, langs, seed=1):
    r = random.Random(seed)
    texts = ["", None, "Word ÄÉ", "lower", "A" * 5000, "é\n日本"]
    rows = [(None if k % 41 == 0 else k // 2, r.choice(texts), r.choice(langs), r.choice(["s", None]), r.choice([1, None])) for k in range(n)]
    return rows + rows[: n // 5]


@pytest.mark.parametrize(("n", "langs"), [(0, ["en"]), (1, [None]), (9, ["en"]), (64, ["en", None]), (700, ["en", "en", "en", "en", "de", None, "", "É"]), (150, [f"g{k}" for k in range(90)])])
def test_manifest_equals_a_plain_tree(spark, n, langs):
    from loamline.llm import merkle

    rows = made(n, langs)
    docs = spark.createDataFrame([(*x, "g", 5, "x") for x in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, g string, i int, __row string").repartition(3)
    got = merkle.manifest(docs)
    assert sorted((tuple(r) for r in got.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=repr) == expected(rows)


def test_a_path_proves_its_row_alone(spark):
    from loamline.llm import merkle

    docs = spark.createDataFrame([(k, f"t{k}", "ab"[k % 2], "s", 1) for k in range(30)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for r in merkle.proven(docs).collect():
        d = sha(*map(framed, (r.id, "s", r.group, 1, f"t{r.id}")))
        assert d == r.leaf
        for step in r.path:
            d = sha(step.left, d, step.right)
        assert d == r.root and r.changed is None
