"""Stored hashes in sorted runs with a narrow key, so that a search reads a few per cent of them.

A run is a table (key, hash, file) in ranges of key and sorted by it; key holds KEY_BITS of a second hash of the hash. Sorted keys lie close
together, so that Parquet's delta encoding leaves two to four bytes of each, against some fifty of a row. A search reads the keys
alone, and looks up whole hashes only for keys that it has found: pages are small, and few keys are told to their statistics. Loads write small runs; merging joins runs of like size into
one, so there are few of them, and also leaves out what was forgotten.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.sources import workspace
from loamline.sources.workspace import stored

KEY_BITS = 40
#: Rows of new hashes up to which they are broadcast; keys found up to which the runs' statistics are asked for each.
BROADCAST_ROWS, FEW_KEYS = 1_000_000, 2_000
#: The same for whole hashes.
BROADCAST_HASHES = 100_000
#: Values of one list that are told to statistics each: they become one nested condition, for which the stack of a task must do.
TOLD = 100
#: Rows of one file of a run, and of a group of rows in it.
FILE_ROWS = 4_000_000
RUN = "key bigint, hash string, file string"
GONE = "hash string, of string"
#: Rows of a page, the least that a search reads of a column.
PAGES = {"parquet.page.row.count.limit": "1000"}
#: Of one run: how its columns are encoded.
OPTIONS = {**PAGES, "parquet.writer.version": "v2", "parquet.enable.dictionary#key": "false", "parquet.enable.dictionary#hash": "false", "parquet.block.size": str(32 << 20), "compression": workspace.CODEC}


def key_of(hash_: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(hash_), 64 - KEY_BITS)


def ranges(n: int) -> list[Column]:
    """Conditions that deal hashes to n like ranges of their key."""
    ends = [(k << KEY_BITS) // n for k in range(n + 1)]
    key = key_of(F.col("hash"))
    return [(key >= a) & (key < b) for a, b in zip(ends, ends[1:], strict=False)] if n > 1 else [F.lit(True)]


def left(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows (hash, load, ...) but those that are gone (hash, of). Only the hash is joined by, as rows are dealt by it already."""
    lost = gone.groupBy("hash").agg(F.collect_set("of").alias("__of")).withColumnRenamed("hash", "__hash")
    return rows.join(lost, (F.col("hash") == F.col("__hash")) & F.array_contains("__of", F.col("load")), "left_anti")


def written(rows: DataFrame, path: str, count: int, gone: DataFrame | None = None) -> None:
    """Writes rows (hash, file) as a run; count: about how many there are. gone: (hash, of) of rows (hash, file, load) that are left out.

    Many rows are written by ranges of keys one after another, so that only those of one are shuffled at once; rows are read for each.
    """
    files, n = max(1, -(-count // FILE_ROWS)), workspace.parts(count)
    n = min(n, files)
    for k, mine in enumerate(ranges(n)):
        some = rows.where(mine) if gone is None else left(rows.where(mine), gone.where(mine))
        keyed = some.select(key_of(F.col("hash")).alias("key"), "hash", "file")
        # a few files need no sample of ranges
        keyed = keyed.coalesce(1) if files == 1 else keyed.repartitionByRange(-(-files // n), "key")
        keyed.sortWithinPartitions("key").write.mode("append" if k else "overwrite").options(**OPTIONS).parquet(path)


def among(column: Column | str, values: list[int]) -> Column:
    """Whether the column is one of the values: lists of TOLD, under a balanced tree of conditions. For a column that is named the lists
    are told as text: literals made one by one take the driver seconds."""

    def listed(some: list[int]) -> Column:
        return F.expr(f"`{column}` in ({', '.join(f'{v}L' for v in some)})") if isinstance(column, str) else column.isin(some)

    parts = [listed(values[k : k + TOLD]) for k in range(0, len(values), TOLD)] or [F.lit(False)]
    while len(parts) > 1:
        parts = [parts[k] | parts[k + 1] if k + 1 < len(parts) else parts[k] for k in range(0, len(parts), 2)]
    return parts[0]


@contextmanager
def told(spark: SparkSession) -> Iterator[None]:
    """What is computed within asks the statistics of pages for each value of lists by `among`, where Spark else asks for their least and greatest."""
    name = "spark.sql.parquet.pushdown.inFilterThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, str(max(int(before), TOLD)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def found(runs: DataFrame, gone: DataFrame, new: DataFrame, count: int) -> DataFrame:
    """Of runs (key, hash, file, load) those rows (hash, load), a stored table, whose hash is in new (hash), but not those that are gone
    (hash, of: the run's folder).

    new must be stored, as it is read twice. While it is small it is broadcast and the runs aren't shuffled; else hashes are looked up
    by ranges of keys, one after another, of which the runs' statistics tell the pages.
    """
    if count > BROADCAST_ROWS:
        n = workspace.parts(count + runs.count())
        ends = [(k << KEY_BITS) // n for k in range(n + 1)]
        each = []
        for k, mine in enumerate(ranges(n)):
            some = runs.where((F.col("key") >= ends[k]) & (F.col("key") < ends[k + 1])).select("hash", "load")
            each.append(left(some.join(new.where(mine).select("hash"), "hash", "left_semi"), gone.where(mine)))
        return stored(*each)
    keys = new.select(key_of(F.col("hash")).alias("key")).distinct()
    hits = runs.select("key").join(F.broadcast(keys), "key", "left_semi")
    few = [r[0] for r in hits.distinct().limit(FEW_KEYS + 1).collect()]  # most keys of new lines aren't there
    if not few:
        return runs.sparkSession.createDataFrame([], "hash string, load string")
    if len(few) <= FEW_KEYS:
        runs = runs.where(among("key", sorted(few)))
    wanted = new.select("hash", key_of(F.col("hash")).alias("key"))
    rows = runs.join(F.broadcast(wanted) if count <= min(BROADCAST_ROWS, BROADCAST_HASHES) else wanted, ["key", "hash"], "left_semi")
    rows = rows.join(gone.select("hash", F.col("of").alias("load")), ["hash", "load"], "left_anti").select("hash", "load")
    if len(few) > FEW_KEYS:
        return stored(rows)
    with told(runs.sparkSession):
        return stored(rows)


def to_merge(sizes: dict[str, int], ratio: int = 4, least: int = 4) -> list[str]:
    """Runs to be merged: those of like size, from the smallest up, once there are `least` of them. Each row is so merged a few times over all loads."""
    out: list[str] = []
    total = 0
    for name, n in sorted(sizes.items(), key=lambda x: (x[1], x[0])):
        if out and n > ratio * max(total, 1):
            break
        out.append(name)
        total += n
    return out if len(out) >= least else []
