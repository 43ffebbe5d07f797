"""Stored dimensions, sorted by a narrow hash of their keys, so that a small load reads only the pages that can hold its keys.

Column `slot` of the stored files is that hash. Files written without it are read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamline.operators import hashruns
from loamline.sources import workspace
from loamline.sources.workspace import stored

#: Keys of one load up to which they are broadcast to the stored ones, and to its rows.
BROADCAST_KEYS = 100_000
SLOT = "slot bigint"


def slot_of() -> Column:
    """Of a row (dimension, key)."""
    return F.shiftrightunsigned(F.xxhash64("dimension", "key"), 64 - hashruns.KEY_BITS).alias("slot")


def written(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Writes rows (dimension, key, ...) to a folder for each dimension, each file sorted by slot."""
    options = {"parquet.enable.dictionary#slot": "false", "parquet.enable.dictionary#key": "false", "compression": workspace.CODEC, **hashruns.PAGES}
    rows.withColumn("slot", slot_of()).sortWithinPartitions("dimension", "slot").write.mode(mode).options(**options).partitionBy("dimension").parquet(path)


def known(old: DataFrame, keys: DataFrame, count: int) -> DataFrame:
    """Of old (dimension, key, id, slot) the rows (dimension, key, id) whose key is in keys (dimension, key); a stored table.

    keys are stored, as they are read several times, and differ; count: how many they are. Few are told to the files' statistics.
    """
    if count > hashruns.FEW_KEYS:
        return stored(old.join(F.broadcast(keys) if count <= BROADCAST_KEYS else keys, ["dimension", "key"], "left_semi").select("dimension", "key", "id"))
    rows = keys.select("dimension", slot_of()).collect()
    mine = F.col("dimension").isin(sorted({r[0] for r in rows})) & (F.col("slot").isNull() | hashruns.among("slot", sorted({r[1] for r in rows})))
    with hashruns.told(old.sparkSession):
        return stored(old.where(mine).join(F.broadcast(keys), ["dimension", "key"], "left_semi").select("dimension", "key", "id"))
