"""Dimensions, deduplication and joins of the star schema. All are DataFrame to DataFrame."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loamline.functions.text import lookup_key, norm_value
from loamline.sources import workspace
from loamline.sources.workspace import stored


#: Rows of texts up to which a table is broadcast: its copies in the driver take some hundred bytes each.
BROADCAST_ROWS = 100_000


def joinable(df: DataFrame, count: int | None = None) -> DataFrame:
    """df, which is stored, to be joined to many rows: broadcast while it is small, else hashed, so that the many rows aren't sorted."""
    return F.broadcast(df) if (df.count() if count is None else count) <= BROADCAST_ROWS else df.hint("shuffle_hash")


def distinct_values(df: DataFrame, column: str, position: tuple[str, ...], case_sensitive: bool = False, derived: dict[str, Column] | None = None) -> DataFrame:
    """Rows (key, value, derived): of equal keys the last spelling by position; derived columns are computed once a key."""
    value = norm_value(F.col(column))
    out = df.where(F.col(column).isNotNull()).select(lookup_key(F.col(column), case_sensitive).alias("key"), value.alias("value"), F.struct(*position).alias("__at"))
    out = out.groupBy("key").agg(F.max_by("value", "__at").alias("value"))
    return out.withColumns(derived) if derived else out


def shared_values(df: DataFrame, columns: list[str], position: tuple[str, ...], case_sensitive: bool = False) -> DataFrame:
    """As distinct_values, over several columns that share a dimension."""
    each = F.explode(F.array(*[F.struct(F.col(c).alias("value"), F.lit(k).alias("k")) for k, c in enumerate(columns)])).alias("e")
    long = df.select(*position, each).select(*position, "e.value", "e.k")
    return distinct_values(long, "value", (*position, "k"), case_sensitive)


def new_values(values: DataFrame, dimension: DataFrame) -> DataFrame:
    return values.join(dimension.select("key"), "key", "left_anti")


def existing_values(values: DataFrame, dimension: DataFrame) -> DataFrame:
    return values.join(dimension.select("key"), "key", "left_semi")


def numbered(values: DataFrame, after: int = 0, key: str = "key", parts: int | None = None) -> DataFrame:
    """values with `id` from after + 1 on in the order of key, without one task over all rows.

    Ranges of sorted keys, stored once so that both uses see the same, get their start by prefix sums over the ranges' counts, a
    table with one row for each range.
    """
    spark = values.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = values.repartitionByRange(parts, key).sortWithinPartitions(key).withColumn("__part", F.spark_partition_id())
    ranged = stored(ranged)
    within = Window.partitionBy("__part").orderBy(key)
    ranged = ranged.withColumn("__row", F.row_number().over(within))
    counts = ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"), F.min(key).alias("__least"))
    starts = counts.select("__part", F.coalesce(F.sum("__n").over(Window.orderBy("__least").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__start"))
    out = ranged.join(F.broadcast(starts), "__part")
    return out.withColumn("id", (F.col("__start") + F.col("__row") + after).cast("long")).drop("__part", "__row", "__start")


def numbered_within(values: DataFrame, group: str, tops: DataFrame, key: str = "key", parts: int | None = None) -> DataFrame:
    """As numbered, for all groups in one pass: each group's ids go on after its `top` in tops (group, top)."""
    parts = parts or int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = stored(values.repartitionByRange(parts, group, key).sortWithinPartitions(group, key).withColumn("__part", F.spark_partition_id()))
    ranged = ranged.withColumn("__row", F.row_number().over(Window.partitionBy("__part", group).orderBy(key)))
    counts = ranged.groupBy(group, "__part").agg(F.count(F.lit(1)).alias("__n"), F.min(key).alias("__least"))
    before = Window.partitionBy(group).orderBy("__least").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    starts = counts.join(tops, group, "left").select(group, "__part", (F.coalesce(F.sum("__n").over(before), F.lit(0)) + F.coalesce("top", F.lit(0))).alias("__start"))
    out = ranged.join(F.broadcast(starts), [group, "__part"])
    return out.withColumn("id", (F.col("__start") + F.col("__row")).cast("long")).drop("__part", "__row", "__start")


def resolved(facts: DataFrame, dimension: DataFrame, column: str, to: str, case_sensitive: bool = False) -> DataFrame:
    """facts with the id of column's value in the dimension (id, key)."""
    ids = dimension.select(F.col("key").alias("__key"), F.col("id").alias(to))
    return facts.withColumn("__key", lookup_key(F.col(column), case_sensitive)).join(ids, "__key", "left").drop("__key")


def resolved_all(facts: DataFrame, dimension: DataFrame, columns: dict[str, str], case_sensitive: bool = False) -> DataFrame:
    return reduce(lambda f, kv: resolved(f, dimension, kv[0], kv[1], case_sensitive), columns.items(), facts)


def unresolved(facts: DataFrame, columns: list[str]) -> DataFrame:
    """Rows in which an id is missing; none after a complete load."""
    return facts.where(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns]))


def first_of_hash(batch: DataFrame, position: tuple[str, ...] = ("file", "offset")) -> DataFrame:
    """The first record of each hash. A partial minimum before the shuffle keeps a hash with very many copies in small pieces."""
    rest = [c for c in batch.columns if c != "hash"]
    least = batch.groupBy("hash").agg(F.min_by(F.struct(*rest), F.struct(*position)).alias("__r"))
    return least.select("hash", "__r.*").select(*batch.columns)


def first_of_stored(batch: DataFrame, position: tuple[str, ...] = ("file", "offset")) -> DataFrame:
    """The same for a stored batch: only narrow hashes are shuffled for all rows, and whole rows for those whose came more than once."""
    return reduce(lambda a, b: a.unionByName(b), first_in_parts(batch, [batch], position)[0])


def first_in_parts(batch: DataFrame, parts: list[DataFrame], position: tuple[str, ...] = ("file", "offset")) -> tuple[list[DataFrame], int]:
    """The same for a stored batch that is the union of parts, in parts; and how many rows that are."""

    def keyed(rows: DataFrame) -> DataFrame:
        return rows.withColumn("__h", F.when(F.col("hash").isNotNull(), F.xxhash64("hash")))

    total = batch.count()
    again = stored(keyed(batch.select("hash")).groupBy("__h").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1"))
    n, rows = again.where("__h is not null").agg(F.count(F.lit(1)), F.coalesce(F.sum("__n"), F.lit(0))).first()
    if not n:
        return parts, total
    again = again.select("__h")
    out = [keyed(p).join(joinable(again, n), "__h", "left_anti").select(*batch.columns) for p in parts]
    m = workspace.parts(rows)
    for k in range(m):
        some = again.where(F.pmod("__h", F.lit(m)) == k) if m > 1 else again
        out.append(first_of_hash(keyed(batch).join(joinable(some, -(-n // m)), "__h", "left_semi").select(*batch.columns), position))
    return out, total - rows + n


def not_known(batch: DataFrame, hashes: DataFrame) -> DataFrame:
    return batch.join(hashes.select("hash"), "hash", "left_anti")


def last_offsets(batch: DataFrame) -> DataFrame:
    return batch.groupBy("file").agg(F.max("offset").alias("file_offset"))


def merged_offsets(old: DataFrame, batch: DataFrame) -> DataFrame:
    """Offsets by file: the batch's where it has the file."""
    new = last_offsets(batch).withColumnRenamed("file_offset", "__new")
    return old.join(new, "file", "full_outer").select("file", F.coalesce("__new", "file_offset").alias("file_offset"))


def load_report(batch: DataFrame, kept: DataFrame) -> DataFrame:
    """By table: rows in, rows kept, duplicates skipped."""
    given = batch.groupBy("table").agg(F.count(F.lit(1)).alias("rows_in"))
    saved = kept.groupBy("table").agg(F.count(F.lit(1)).alias("rows_kept"))
    out = given.join(saved, "table", "left").withColumn("rows_kept", F.coalesce("rows_kept", F.lit(0)))
    return out.withColumn("skipped", F.col("rows_in") - F.col("rows_kept"))


def duplicate_targets(sources: DataFrame) -> DataFrame:
    """Targets that more than one url has."""
    return sources.groupBy("target").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list("url")).alias("urls")).where("n > 1")


def field_drift(records: DataFrame, declared: DataFrame) -> DataFrame:
    """Keys of records that aren't declared (A) and declared ones that never occur (D), with counts."""
    found = records.select(F.explode(F.map_keys("fields")).alias("field")).groupBy("field").agg(F.count(F.lit(1)).alias("n"))
    both = found.join(declared.select("field", F.lit(True).alias("__d")), "field", "full_outer")
    both = both.where("__d is null or n is null")
    return both.select("field", F.coalesce("n", F.lit(0)).cast("long").alias("n"), F.when(F.col("__d").isNull(), F.lit("A")).otherwise(F.lit("D")).alias("status"))


def last_updates(updates: DataFrame, keys: list[str], value: str, position: str) -> DataFrame:
    return updates.groupBy(*keys).agg(F.max_by(value, position).alias(value))


def updated(facts: DataFrame, changes: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """facts with new values of columns from changes, matched by keys; changes has one row a key."""
    new = changes.select(*keys, F.lit(True).alias("__hit"), *[F.col(c).alias(f"__new_{c}") for c in columns])
    out = facts.join(new, keys, "left")
    return out.select(*[F.when(F.col("__hit"), F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in facts.columns])


def without(facts: DataFrame, removed: DataFrame, key: str) -> DataFrame:
    """facts without rows of the removed keys."""
    return facts.join(removed.select(key), key, "left_anti")


def all_variants(tables: dict[str, DataFrame]) -> DataFrame:
    """Every table's rows with its name; columns that one lacks are null."""
    parts = [df.withColumn("table", F.lit(name)) for name, df in sorted(tables.items())]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def multi_mapped(df: DataFrame, column: str, table: DataFrame, to: str) -> DataFrame:
    """By a table (value, targets): the first target; unchanged where there is none."""
    first = table.groupBy("value").agg(F.min_by(F.element_at("targets", 1), "ord").alias("__to"))
    return df.join(first, df[column] == first["value"], "left").withColumn(to, F.coalesce("__to", column)).drop("__to", "value")


def inverted(table: DataFrame) -> DataFrame:
    """From (value, targets) to (target, values)."""
    return table.select("value", F.explode("targets").alias("target")).groupBy("target").agg(F.array_sort(F.collect_set("value")).alias("values"))
