"""N-gram Jaccard join by chosen paths (Christiani, Pagh and Sivertsen, 2018), with exact verification.

A document is the set of its word 5-grams. Documents with equal sets are one class. Each class gets a signature of
min-hashes, a sample of its tokens. A path picks places of the signature at random, each with the chance 1 / (split * size);
classes that share the values there go on together. Runs are repeated until pairs at the threshold meet with the target
recall. A first, short pass links each member of a bucket that looks like the bucket's first or last one, so that large groups of near copies are one
group before the rest: later a bucket whose members are in one group has nothing to compare. Other buckets are split on until they are small,
and the last are compared block against block. A bucket gives one edge for each group that it joins, not for each member. What meets and looks alike is linked, and linked groups are
verified once on their whole sets, again block against block (a block holds about BLOCK_GRAMS grams), so no task holds an unbounded group and no pair
leaves a task: tasks return counts of links and one edge for each member.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import wordhash as wh
from .common import staged, text_slices, tidy

NGRAM, THRESHOLD = 5, 0.8
#: Places of the signature; likeness by signature from which classes are verified, four deviations below the threshold.
PLACES, LIKELY = 64, 0.6
#: A path takes a place with the chance 1 / (SPLIT * PLACES); below the threshold, so that paths of near pairs seldom die out.
SPLIT, FIRST_LEVEL, LAST_LEVEL, RECALL = 0.7, 2, 6, 0.999
#: Runs of the short pass.
FIRST_RUNS = 4
#: Classes that a bucket may hold before it is split into further paths; classes in a block of a bucket, and of a group for verification.
SPLIT_FROM, BUCKET, BLOCK = 4096, 2048, 1024
#: Grams that a block of a group holds for verification, about; BLOCK bounds its classes.
BLOCK_GRAMS = 250_000
#: Rows up to which a table of class numbers is broadcast.
BROADCAST_ROWS = 1_000_000
_SEEDS = wh.seeded(PLACES, 101)


def survival(levels: int, likeness: float = THRESHOLD, split: float = SPLIT) -> float:
    """The chance that two sets of this likeness share a path of so many levels in one run."""
    p = 1.0
    for _ in range(levels):
        p = 1 - math.exp(-likeness / split * p)
    return p


def runs_needed(recall: float = RECALL, levels: int = LAST_LEVEL) -> int:
    """Runs with which pairs at the threshold meet with this recall even where all their buckets are split to the last level."""
    return math.ceil(math.log(1 - recall) / math.log(1 - survival(levels)))


def shingle_sets(b: np.ndarray, o: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different 5-gram hashes of each text, one after another, and where each begins; a text of fewer words is one gram."""
    w = wh.words(b, o, wh.ALNUM, True)
    n = np.diff(w.first)
    g, whole = wh.grams(w, NGRAM)
    at = np.flatnonzero(whole)
    keys, of = [g[at]], [w.text[at]]
    for k in range(1, NGRAM):
        short = np.flatnonzero(n == k)
        if len(short):
            h, _ = wh.grams(w, k)
            keys.append(h[w.first[short]])
            of.append(short)
    key, doc = np.concatenate(keys), np.concatenate(of)
    order = np.lexsort((key, doc))
    key, doc = key[order], doc[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
    key, doc = key[new], doc[new]
    return key, np.searchsorted(doc, np.arange(len(o)))


def _digests(key: np.ndarray, first: np.ndarray, b: np.ndarray, o: np.ndarray) -> np.ndarray:
    """A hash of each set; of a text without words, of its bytes."""
    total = np.zeros(len(key) + 1, wh.U)
    np.cumsum(wh.mix(key + wh.U(77)), out=total[1:])
    n = np.diff(first)
    out = wh.mix((total[first[1:]] - total[first[:-1]]) ^ wh.mix(n.astype(wh.U)))
    bare = np.flatnonzero(n == 0)
    if len(bare):
        out[bare] = wh.mix(wh.span_hashes(b, o[bare], o[bare + 1]) ^ wh.U(3))
    return out


def _signatures(key: np.ndarray, first: np.ndarray) -> np.ndarray:
    """PLACES min-hashes of 16 bits of each set; zeros for an empty one."""
    n = len(first) - 1
    out = np.zeros((n, PLACES), np.uint16)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        for p in range(PLACES):
            h = key * _SEEDS[p]
            h ^= h >> wh.U(29)
            out[full, p] = (wh.mix(np.minimum.reduceat(h, first[full])) & wh.U(0xFFFF)).astype(np.uint16)
    return out


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text, text's hash to doc_id, text's hash, set's hash, size, signature."""
    for batch in batches:
        null = np.asarray(batch.column(1).is_null())
        for lo, hi, b, o in text_slices(batch.column(1)):
            key, first = shingle_sets(b, o)
            digest = _digests(key, first, b, o).view(np.int64)
            n = np.where(null[lo:hi], -1, np.diff(first))
            sig = pa.FixedSizeBinaryArray.from_buffers(pa.binary(2 * PLACES), hi - lo, [None, pa.py_buffer(np.ascontiguousarray(_signatures(key, first)))])
            own = (batch.column(k).slice(lo, hi - lo) for k in (0, 2))
            yield pa.RecordBatch.from_arrays([*own, pa.array(digest), pa.array(n), sig.cast(pa.binary())], ["doc_id", "text_hash", "digest", "n_grams", "signature"])


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.cast(pa.binary())
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), PLACES)


def _chosen(node: np.ndarray, sig: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The next nodes of each path: rows and their children."""
    places = wh.mix(node[:, None] + _SEEDS[None, :])
    row, place = np.nonzero((places >> wh.U(11)).astype(np.float64) / 2.0**53 < 1 / (SPLIT * PLACES))
    return row, wh.mix(places[row, place] ^ wh.mix(sig[row, place].astype(wh.U) + wh.U(17)))


def _paths(levels: int, runs: int, first: int = 0) -> Callable:
    """Mapper from (digest, signature) to (digest, bucket), each once, for runs from `first`; runs of 0 go on from the bucket given."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, 2048):
                batch = whole.slice(a, 2048)
                digest, sig = np.asarray(batch.column(0)), _matrix(batch.column(1))
                outs = []
                for r in range(runs or 1):
                    row = np.arange(len(digest))
                    node = np.full(len(digest), wh.seeded(first + r + 1, 999)[-1]) if runs else np.asarray(batch.column(2)).view(wh.U)
                    for _ in range(levels):
                        at, node = _chosen(node, sig[row])
                        row = row[at]
                    outs.append(np.stack([digest[row], node.view(np.int64)]))
                rows = np.unique(np.concatenate(outs, axis=1), axis=1) if runs else np.concatenate(outs, axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(rows[0]), pa.array(rows[1])], ["digest", "bucket"])

    return walk


def _grouped(batches: Iterator[pa.RecordBatch], key: str, rows: int = 20_000) -> Iterator[pa.Table]:
    """Tables of whole groups of rows sorted by key, about `rows` each."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.asarray(batch.column(batch.schema.get_field_index(key)))
        size += batch.num_rows
        cut = int(np.searchsorted(keys, keys[-1])) if keys[0] <= keys[-1] else 0
        if size >= rows:
            last = held[-1].column(held[-1].schema.get_field_index(key))[-1].as_py() if held else None
            if cut == 0 and last is not None and last != keys[-1]:
                yield pa.Table.from_batches(held)
                held, size = [batch], batch.num_rows
                continue
            if cut:
                yield pa.Table.from_batches([*held, batch.slice(0, cut)])
                held, size = [batch.slice(cut)], batch.num_rows - cut
                continue
        held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def _least(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n places the least place that edges a-b join it with."""
    out = np.arange(n)
    while len(a):
        low = np.minimum(out[a], out[b])
        new = out.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, out[a], low)
        np.minimum.at(new, out[b], low)
        new = new[new]
        if (new == out).all():
            return out
        out = new
    return out


def _star(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Brute force in buckets, sorted by bucket: rows (bucket, digest, label, signature, side); an edge from each label to the least it is joined with.

    side: 0 compares with all; 1 and 2 compare with the other side only. Those of one label are linked already, so only labels are.
    """
    for t in _grouped(batches, "bucket"):
        bucket, side, label = (t[c].to_numpy() for c in ("bucket", "side", "label"))
        sig = _matrix(t["signature"].combine_chunks())
        a, b = [], []
        for d in range(1, len(bucket)):
            at = np.flatnonzero(bucket[d:] == bucket[:-d])
            if not len(at):
                break
            at = at[((side[at] == 0) | (side[at] != side[at + d])) & (label[at] != label[at + d])]
            for k in range(0, len(at), 8192):
                x = at[k : k + 8192]
                like = (sig[x] == sig[x + d]).sum(1) >= LIKELY * PLACES
                a.append(x[like])
                b.append(x[like] + d)
        if a:
            names, ends = np.unique(np.concatenate([label[np.concatenate(a)], label[np.concatenate(b)]]), return_inverse=True)
            to = _least(len(names), *np.split(ends, 2))
            own = np.flatnonzero(to != np.arange(len(names)))
            yield pa.RecordBatch.from_arrays([pa.array(names[own]), pa.array(names[to[own]])], ["a", "b"])


def in_blocks(df: DataFrame, key: str) -> DataFrame:
    """Rows of groups `key` for comparison in groups `bucket` of bounded size: whole, or for each pair of blocks of a large group.

    df has the number of blocks of the row's group as `blocks`. A row of a large group goes to its own block and to one group for each other block.
    """
    joined = df.withColumnRenamed("blocks", "__blocks").withColumn("__mine", F.expr("cast(pmod(xxhash64(digest, 5), __blocks) as int)"))
    one = f"transform(sequence(0, __blocks - 1), o -> struct(xxhash64({key}, least(__mine, o), greatest(__mine, o)) as bucket, case when o = __mine then 0 when __mine < o then 1 else 2 end as side))"
    return joined.withColumn("__to", F.explode(F.expr(one))).select(*[c for c in df.columns if c not in ("bucket", "side", "blocks")], "__to.bucket", "__to.side")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b) of whole numbers, both ways added here: rows (digest, label), the least member.

    Each round, a node takes the least label of its neighbours, and then its label's label.
    """
    both = staged(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = staged(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("digest"), F.least("a", "m").alias("label")))
    while True:
        near = both.join(labels.withColumnRenamed("digest", "b"), "b").groupBy("a").agg(F.min("label").alias("m"))
        new = labels.join(near.withColumnRenamed("a", "digest"), "digest").select("digest", F.col("label").alias("__old"), F.least("label", "m").alias("label"))
        # the label of a label; a label is itself a node
        up = new.select(F.col("digest").alias("label"), F.col("label").alias("up"))
        new = staged(new.join(up, "label").select("digest", "__old", F.least("label", "up").alias("label")))
        changed = new.where("label <> __old").limit(1).count()
        labels = new.select("digest", "label")
        if not changed:
            return labels


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """label, digest, weight, blocks, text to label, digest, weight, blocks, set."""
    for batch in batches:
        for lo, hi, b, o in text_slices(batch.column(4)):
            key, first = shingle_sets(b, o)
            raw = key.tobytes()
            sets = pa.array([raw[8 * s : 8 * e] for s, e in zip(first[:-1], first[1:], strict=True)], pa.binary())
            out = pa.RecordBatch.from_arrays([*(batch.column(k).slice(lo, hi - lo) for k in range(4)), sets], ["label", "digest", "weight", "blocks", "grams"])
            yield out.filter(pa.array(_digests(key, first, b, o).view(np.int64) == out.column(1).to_numpy()))


def near_pairs(key: np.ndarray, first: np.ndarray, group: np.ndarray, side: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs within equal group, and of different sides where these aren't 0, whose sets have at least the threshold's likeness."""
    n = np.diff(first)
    owner = np.repeat(np.arange(len(n)), n)
    out_a, out_b = [], []
    cuts = np.flatnonzero(np.diff(group)) + 1
    for lo, hi in zip(np.append(0, cuts), np.append(cuts, len(group)), strict=True):
        m = hi - lo
        if m < 2:
            continue
        k, own = key[first[lo] : first[hi]], owner[first[lo] : first[hi]] - lo
        _, col, seen = np.unique(k, return_inverse=True, return_counts=True)
        keep = seen[col] > 1  # grams of one set alone join nothing
        col = np.unique(col[keep], return_inverse=True)[1]
        own = own[keep]
        both = np.zeros((m, m), np.float32)
        width = int(col.max()) + 1 if len(col) else 0
        order = np.argsort(col, kind="stable")
        col, own = col[order], own[order]
        step = min(16384, max(1024, (1 << 22) // m))
        for c in range(0, width, step):  # dense strips of bounded size
            s, e = np.searchsorted(col, [c, c + step])
            strip = np.zeros((m, min(step, width - c)), np.float32)
            strip[own[s:e], col[s:e] - c] = 1
            both += strip @ strip.T
        size, near = n[lo:hi], np.zeros((m, m), bool)
        for r in range(0, m, 256):
            union = size[r : r + 256, None] + size[None, :] - both[r : r + 256]
            near[r : r + 256] = (both[r : r + 256] >= threshold * union - 1e-6) & (both[r : r + 256] > 0)
        near = np.triu(near, 1)
        if side[lo:hi].any():
            near &= side[lo:hi, None] != side[None, lo:hi]
        a, b = np.nonzero(near)
        out_a.append(a + lo)
        out_b.append(b + lo)
    none = np.zeros(0, np.int64)
    return (np.concatenate(out_a), np.concatenate(out_b)) if out_a else (none, none)


def _verified(threshold: float) -> Callable:
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _grouped(batches, "bucket", 512):
            once = np.ones(len(t), bool)
            once[1:] = (np.diff(t["digest"].to_numpy()) != 0) | (np.diff(t["bucket"].to_numpy()) != 0)
            t = t.filter(pa.array(once))
            bucket, side, digest, weight = (t[c].to_numpy() for c in ("bucket", "side", "digest", "weight"))
            grams = t["grams"].combine_chunks().cast(pa.large_binary()).to_pylist()
            first = np.append(0, np.cumsum([len(g) // 8 for g in grams]))
            a, b = near_pairs(np.frombuffer(b"".join(grams), wh.U), first, bucket, side, threshold)
            to = _least(len(bucket), a, b)
            links = (np.bincount(a, weight[b], len(bucket)) + np.bincount(b, weight[a], len(bucket))).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(digest), pa.array(digest[to]), pa.array(links)], ["a", "b", "links"])

    return check


def _few(df: DataFrame) -> DataFrame:
    """df, broadcast where it is small; df must be stored."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _like_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (digest, signature, first, signature of the first) to edges where both look alike."""
    for batch in batches:
        like = (_matrix(batch.column(1)) == _matrix(batch.column(3))).sum(1) >= LIKELY * PLACES
        at = pa.array(np.flatnonzero(like))
        yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(2).take(at)], ["a", "b"])


def _first_links(names: DataFrame) -> DataFrame:
    """Labels of groups found with FIRST_RUNS runs, comparing with the first member of each bucket only.

    A member keeps one edge, to the least of the first members that it looks like; first members that it has besides are tied
    to that one, each such pair once. So edges are at most one for each member and few between first members.
    """
    rows = staged(names.mapInArrow(tidy(_paths(FIRST_LEVEL, FIRST_RUNS)), "digest bigint, bucket bigint"))
    firsts = rows.groupBy("bucket").agg(F.min("digest").alias("first"), F.max("digest").alias("__last")).where("first <> __last").select("bucket", "first")
    met = rows.join(firsts, "bucket").where("digest <> first").select("digest", "first").distinct()
    signed = met.join(names, "digest").join(names.select(F.col("digest").alias("first"), F.col("signature").alias("other")), "first")
    like = signed.select("digest", "signature", "first", "other").mapInArrow(tidy(_like_first), "a bigint, b bigint")
    own = staged(like.groupBy("a").agg(F.min("b").alias("b"), F.collect_set("b").alias("__firsts")))  # at most one first member for each path
    between = own.where("size(__firsts) > 1").select(F.explode("__firsts").alias("a"), "b").where("a <> b").distinct()
    return components(own.select("a", "b").unionByName(between))


def _likely(reps: DataFrame, recall: float) -> DataFrame:
    """Labels (digest, label) of groups of classes that look alike, from buckets of chosen paths."""
    names = reps.where("n_grams > 0").select("digest", "signature")
    known = staged(_first_links(names))
    names = staged(names.join(known, "digest", "left").select("digest", "signature", F.coalesce("label", "digest").alias("label")))
    tags = names.select("digest", "label")
    rows = names.select("digest", "signature").mapInArrow(tidy(_paths(FIRST_LEVEL, runs_needed(recall), FIRST_RUNS)), "digest bigint, bucket bigint")
    edges = known.select(F.col("digest").alias("a"), F.col("label").alias("b")).where("a <> b")
    for level in range(FIRST_LEVEL, LAST_LEVEL + 1):
        # buckets of one class or one group have nothing to compare and go; only the rest take a signature along
        rows = rows.join(tags, "digest") if "label" not in rows.columns else rows
        counts = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y")
        rows = staged(rows.join(counts.select("bucket", "n"), "bucket").select("digest", "label", "bucket", "n"))
        end = level == LAST_LEVEL
        met = (rows if end else rows.where(f"n <= {SPLIT_FROM}")).join(names.select("digest", "signature"), "digest")
        small = in_blocks(met.withColumn("blocks", F.expr(f"cast(ceil(n / {BUCKET}) as int)")).drop("n"), "bucket")
        found = small.repartition("bucket").sortWithinPartitions("bucket", "digest").mapInArrow(tidy(_star), "a bigint, b bigint")
        edges = edges.unionByName(found)
        if end or rows.where(f"n > {SPLIT_FROM}").limit(1).count() == 0:
            break
        on = rows.where(f"n > {SPLIT_FROM}").select("digest", "bucket").join(names.select("digest", "signature"), "digest")
        rows = on.select("digest", "signature", "bucket").mapInArrow(tidy(_paths(1, 0)), "digest bigint, bucket bigint")
    return components(edges.distinct())


def classes(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """Rows (doc_id, class_id, n_links, n_copies): near-duplicate class and number of linked documents of each row of docs (doc_id, text).

    Two documents are linked if the Jaccard similarity of their sets of word 5-grams is at least `threshold`; a class is
    a connected group, named by its least doc_id. n_copies counts other documents with the same set. Documents of fewer than five words are one gram of all their words;
    texts without words are alike only if equal; a null text is alone. Ties and repeated rows count as
    documents of their own, rows without doc_id too, whose class_id is null where no row of the class has one; very long
    texts are taken whole; other columns are ignored; an empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    sketches = staged(rows.mapInArrow(tidy(_sketch), "doc_id bigint, text_hash bigint, digest bigint, n_grams bigint, signature binary"))
    alone = sketches.where("n_grams < 0").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(0).cast("long").alias("n_copies"))
    told = sketches.where("n_grams >= 0")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"))  # a row with doc_id where there is one
    reps = told.groupBy("digest").agg(first.alias("r"), F.count(F.lit(1)).alias("weight"), F.max("n_grams").alias("n_grams"), F.max("signature").alias("signature"))
    reps = staged(reps.select("digest", F.col("r.doc_id").alias("rep"), F.col("r.text_hash").alias("text_hash"), "weight", "n_grams", "signature"))
    likely = _likely(reps, recall)
    members = staged(likely.join(reps.select("digest", "rep", "text_hash", "weight", "n_grams"), "digest"))
    # blocks are told before texts are read, and only of groups of several blocks, which are few
    large = staged(members.groupBy("label").agg(F.expr(f"cast(greatest(ceil(count(1) / {BLOCK}), ceil(sum(n_grams) / {BLOCK_GRAMS})) as int)").alias("blocks")).where("blocks > 1"))
    sized = members.join(_few(large), "label", "left").select("label", "digest", "weight", F.coalesce("blocks", F.lit(1)).alias("blocks"), "rep", F.col("text_hash").alias("__hash"))
    sized = _few(staged(sized))
    texts = rows.join(sized, (rows["text_hash"] == sized["__hash"]) & rows["doc_id"].eqNullSafe(sized["rep"])).select("label", "digest", "weight", "blocks", "text")
    sets = texts.mapInArrow(tidy(_sets), "label bigint, digest bigint, weight bigint, blocks int, grams binary")
    dealt = in_blocks(sets, "label")
    checked = staged(dealt.repartition("bucket").sortWithinPartitions("bucket", "digest").mapInArrow(tidy(_verified(threshold)), "a bigint, b bigint, links bigint"))
    links = checked.groupBy("a").agg(F.sum("links").alias("links"))
    joined = components(checked.where("a <> b"))
    near = joined.join(links.withColumnRenamed("a", "digest"), "digest", "left").join(reps.select("digest", "rep"), "digest")
    least = near.groupBy("label").agg(F.min("rep").alias("class_id"))
    near = near.join(least, "label").select("digest", "class_id", "links")
    # stored, so that the next join can split a digest that very many rows have
    full = staged(reps.join(near, "digest", "left").select("digest", F.coalesce("class_id", "rep").alias("class_id"), F.coalesce("links", F.lit(0)).alias("links"), "weight"))
    out = told.select("doc_id", "digest").join(full, "digest").select("doc_id", "class_id", F.expr("cast(links + weight - 1 as bigint)").alias("n_links"), F.expr("cast(weight - 1 as bigint)").alias("n_copies"))
    return out.unionByName(alone)
