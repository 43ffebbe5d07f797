"""Merkle manifest of a dataset: a tree of hashes for each value of a column, and one over their roots.

Slot pivot: conditional aggregates spread the children of each parent into one column a slot. All columns joined are the
parent's input; all but a child's own are its siblings, so one pivot serves the way up and the way down. Levels are stored, as
each is read twice. DataFrame functions alone; no group larger than a run of FANOUT nodes meets in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import staged

FANOUT = 8
#: Rows of the table of ranges up to which it is broadcast.
BROADCAST_RANGES = 500_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
STEP = "array<struct<left: string, right: string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex of the SHA-256 of the parts, one after another."""
    return F.sha2(F.concat(*parts), 256)


def framed(c: Column) -> Column:
    """A value with its length in bytes before it, so that neighbours can't be mistaken; `-` for null."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def folded(text: Column) -> Column:
    """A to Z in lower case and nothing else."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def leaves(docs: DataFrame, columns: tuple[str, ...], group: str, order: str, tampered: dict[str, tuple[Column, Column]] | None = None) -> DataFrame:
    """Rows (g, id, leaf, changed): the hash of each row's columns, and, where a value was tampered with, the hash of what is there now.

    tampered: for a column, where it is changed and what it is then. group may be null; equal rows give equal leaves.
    """
    now = {c: F.col(f"`{c}`") for c in columns}
    leaf = digest(*[framed(x) for x in now.values()])
    changed = F.lit(None).cast("string")
    if tampered:
        where = reduce(lambda a, b: a | b, [F.coalesce(w, F.lit(False)) for w, _ in tampered.values()])
        then = now | {c: F.when(w, x).otherwise(now[c]) for c, (w, x) in tampered.items()}
        changed = F.when(where, digest(*[framed(x) for x in then.values()]))
    return docs.select(F.col(f"`{group}`").cast("string").alias("g"), F.col(f"`{order}`").alias("id"), leaf.alias("leaf"), changed.alias("changed"))


def placed(rows: DataFrame, *order: str) -> DataFrame:
    """rows (g, ...) with their place `i` from 0 within g, and `n`, the rows of g; stored.

    Rows are sorted in ranges, so a group that holds most of them is spread over tasks; each range and group starts where those
    before it end. Rows that are equal in g and order are told apart by their number alone, which only moves equal rows.
    """
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = staged(rows.withColumn("__row", F.monotonically_increasing_id()))
    keys = "g", *order, "__row"
    at = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("__row").withColumn("__at", F.monotonically_increasing_id())
    at = staged(at.withColumn("__part", F.shiftright("__at", 33)))
    ranges = at.groupBy("g", "__part").agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__first"))
    group = Window.partitionBy("g")  # a row for each of its ranges
    before = F.sum("__n").over(group.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    starts = staged(ranges.select(F.col("g").alias("__g"), F.col("__part").alias("__p"), (F.coalesce(before, F.lit(0)) - F.col("__first")).alias("__by"), F.sum("__n").over(group).alias("n")))
    if starts.count() <= BROADCAST_RANGES:
        starts = F.broadcast(starts)
    out = at.join(starts, at.g.eqNullSafe(F.col("__g")) & (F.col("__part") == F.col("__p")))
    return staged(out.select(*[c for c in at.columns if not c.startswith("__")], (F.col("__at") + F.col("__by")).alias("i"), "n"))


def _spread(nodes: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """A row for each run of FANOUT nodes (g, p, n) with columns c0 and on for each of columns c."""
    slots = [F.max(F.when(F.pmod("i", F.lit(FANOUT)) == s, F.col(c))).alias(f"{c}{s}") for c in columns for s in range(FANOUT)]
    return nodes.groupBy("g", F.expr(f"i div {FANOUT}").alias("p")).agg(F.max("n").alias("n"), *slots)


def _all(but: range | None = None) -> Column:
    return F.concat(*[F.coalesce(f"d{s}", F.lit("")) for s in (range(FANOUT) if but is None else but)]) if but is None or len(but) else F.lit("")


def risen(nodes: DataFrame, carry: tuple[str, ...] = ()) -> tuple[list[DataFrame], list[DataFrame]]:
    """The pivots of all levels over nodes (g, i, n, d, carry), from below, and by level the roots (g, d) that groups end with.

    A group's level ends with one node; a group of one node has it for its root.
    """
    most, pivots, roots = nodes.agg(F.max("n")).first()[0] or 0, [], []
    while True:
        roots.append(nodes.where("n = 1").select("g", "d"))
        if most <= 1:
            return pivots, roots
        pivots.append(staged(_spread(nodes.where("n > 1"), ("d", *carry) if not pivots else ("d",))))
        nodes = pivots[-1].select("g", F.col("p").alias("i"), F.expr(f"(n + {FANOUT - 1}) div {FANOUT}").alias("n"), F.sha2(_all(), 256).alias("d"))
        most = -(-most // FANOUT)


def descended(pivots: list[DataFrame], roots: list[DataFrame], top: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Nodes of the lowest pivot (g, d, carry) with `root`, their group's root, and `path`, the steps from them upwards.

    top: (g, root, path), the path of each group's root. A step is what stands left and right of a node in its run. Groups of
    one node are not among the rows.
    """
    kept = [c for c in top.columns if c not in ("g", "path")]
    above = None
    for level in range(len(pivots) - 1, -1, -1):
        ends = roots[level + 1].select(F.col("g").alias("__h")).join(top, F.col("__h").eqNullSafe(F.col("g"))).select("g", F.lit(0).cast("long").alias("i"), *kept, "path")
        above = ends if above is None else above.unionByName(ends)
        above = above.select(F.col("g").alias("__g"), F.col("i").alias("__i"), *kept, F.col("path").alias("__path"))
        joined = pivots[level].join(above, F.col("g").eqNullSafe(F.col("__g")) & (F.col("p") == F.col("__i")))
        more = carry if not level else ()
        slots = [F.struct((F.col("p") * FANOUT + s).alias("i"), *[F.col(f"{c}{s}").alias(c) for c in ("d", *more)], _all(range(s)).alias("left"), _all(range(s + 1, FANOUT)).alias("right")) for s in range(FANOUT)]
        each = joined.select("g", *kept, "__path", F.explode(F.array(*slots)).alias("e")).where("e.d is not null")
        path = F.concat(F.array(F.struct("e.left", "e.right")), F.col("__path"))
        above = each.select("g", *kept, "e.i", *[F.col(f"e.{c}") for c in (("d", *more) if not level else ())], path.alias("path"))
        if level:
            above = staged(above)
    return above


def proven(docs: DataFrame, columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), group: str = "lang", order: str = "doc_id", tampered: dict[str, tuple[Column, Column]] | None = None) -> DataFrame:
    """Every row of docs as (group, id, leaf, changed, subroot, root, path): what a reader needs to prove one row against the root alone.

    leaf: the hash of the row's columns. In each group leaves are taken by order, and runs of FANOUT are hashed until one is left,
    the subroot; subroots by group, null first, give the root alike. path: by level, up to the root, what stands left and right of
    the node in its run. changed: the leaf's hash after tampering, null where nothing was done.

    Null values count as `-`, an empty text as `0:`; a null group is a group of its own, and null ids come first. Rows that
    share an id are taken by their leaf, so repeated rows lie side by side and each gets a path. Texts are hashed whole. Other
    columns, whatever their names, are ignored. No rows give none.
    """
    rows = placed(leaves(docs, columns, group, order, tampered), "id", "leaf").withColumnRenamed("leaf", "d")
    pivots, roots = risen(rows, ("id", "changed"))
    ends = staged(reduce(DataFrame.unionByName, roots))
    above = placed(ends.select(F.lit(0).alias("g"), F.col("g").alias("id"), "d"), "id")
    top_pivots, top_roots = risen(above, ("id",))
    whole = [r for t in top_roots for r in t.collect()]  # the root of all: one row, or none
    root = F.lit(whole[0]["d"] if whole else None).cast("string")
    none = F.array().cast(STEP)
    alone = above.where("n = 1").select(F.col("id").alias("g"), F.col("d").alias("subroot"), none.alias("path"))
    tops = alone
    if top_pivots:
        start = _whole(docs, none)
        tops = alone.unionByName(descended(top_pivots, top_roots, start, ("id",)).select(F.col("id").alias("g"), F.col("d").alias("subroot"), "path"))
    tops = staged(tops)
    out = rows.where("n = 1").join(tops.withColumnRenamed("g", "__g"), F.col("g").eqNullSafe(F.col("__g"))).select("g", "subroot", "d", "id", "changed", "path")
    if pivots:
        out = out.unionByName(descended(pivots, roots, tops, ("id", "changed")).select(*out.columns))
    return out.select(F.col("g").alias("group"), "id", F.col("d").alias("leaf"), "changed", "subroot", root.alias("root"), "path")


def _whole(like: DataFrame, path: Column) -> DataFrame:
    """The root of all as a group: its own path is empty."""
    return like.sparkSession.range(1).select(F.lit(0).alias("g"), path.alias("path"))


def folded_up(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, leaf, lambda d, step: F.sha2(F.concat(step["left"], d, step["right"]), 256))


def siblings_digest(path: Column) -> Column:
    """The hash of all siblings, level by level, from left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def manifest(docs: DataFrame) -> DataFrame:
    """The manifest of documents with every third one tampered with: its letters A to Z in lower case.

    Which are tampered with is told by the CRC of the decimal doc_id; a row without doc_id, and a null text, stay as they are.
    A text without such letters stays as it is too, and so verifies. Odd rows as in `proven`.
    """
    third = F.crc32(F.encode(F.col("doc_id").cast("long").cast("string"), "UTF-8")) % 3 == 0
    rows = proven(docs, tampered={"text": (third, folded(F.col("text")))})
    again = folded_up(F.coalesce("changed", "leaf"), F.col("path"))
    out = rows.select(F.col("id").cast("long").alias("doc_id"), "leaf", "subroot", "root", siblings_digest(F.col("path")).alias("proof_sha256"), again.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
