"""Following growing files as a stream, with global deduplication and effectively-once output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.operators import hashruns, tables
from loamline.sources import sinks, workspace, xlog

Handle = Callable[[DataFrame], DataFrame]


def stored_rows(spark: SparkSession, out: str, schema) -> DataFrame:
    """All batches written so far."""
    return spark.read.schema(schema).parquet(f"{out}/batch=*") if sinks.exists(spark, out) else spark.createDataFrame([], schema)


def known_hashes(spark: SparkSession, runs: str, but: str) -> DataFrame:
    """Stored hashes (key, hash, file, load) of all batches but one, that may be run again."""
    schema = f"{hashruns.RUN}, load string"
    return spark.read.schema(schema).parquet(runs).where(F.col("load") != but) if sinks.exists(spark, runs) else spark.createDataFrame([], schema)


def follow(spark: SparkSession, path: str, out: str, checkpoint: str, handle: Handle | None = None, dedup: str | None = None, once: bool = True, every: str = "250 milliseconds", **options):
    """A query from files under path to Parquet under out.

    Each batch goes to a folder of its checkpoint and number and overwrites it, so a batch that is run again after a failure leaves
    one copy. dedup: a column of which only the first row ever is kept, against all batches stored before this one; hashes
    never expire. They are kept in sorted runs beside out, of which a batch reads the narrow keys. With dedup a lost
    checkpoint loses and doubles nothing; without it, lines are then written once more. handle is called anew for each batch, so
    rule tables that it reads take effect at once. once: catch up and stop; else go on every interval, in which bursts of changes make one batch.
    """

    def put(batch: DataFrame, number: int) -> None:
        rows, name = handle(batch) if handle else batch, f"{number:09d}-{sinks.checkpoint_id(spark, checkpoint)[:8]}"
        if not dedup:
            rows.write.mode("overwrite").parquet(f"{out}/batch={name}")
            return
        rows = workspace.stored(tables.first_of_hash(rows.withColumnRenamed(dedup, "hash")))
        runs = known_hashes(spark, f"{out}-hashes", name)
        gone = spark.createDataFrame([], hashruns.GONE)
        count = rows.count()
        fresh = workspace.stored(tables.not_known(rows, hashruns.found(runs, gone, rows.select("hash"), count)))
        hashruns.written(fresh.select("hash", F.lit("").alias("file")), f"{out}-hashes/load={name}", count)
        fresh.withColumnRenamed("hash", dedup).write.mode("overwrite").parquet(f"{out}/batch={name}")

    if once:
        options = {k: v for k, v in options.items() if k != "quietSeconds"}
    options = sinks.offset_log(spark, checkpoint) | options
    writer = xlog.tail(spark, path, **options).writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()


def caught_up(spark: SparkSession, path: str, out: str, checkpoint: str, **how) -> None:
    """Loads all that is there and returns."""
    follow(spark, path, out, checkpoint, **how).awaitTermination()


def backfilled(spark: SparkSession, path: str, out: str, checkpoint: str, **how):
    """Catches up first, then follows on the same checkpoint."""
    caught_up(spark, path, out, checkpoint, **how)
    return follow(spark, path, out, checkpoint, once=False, **how)
