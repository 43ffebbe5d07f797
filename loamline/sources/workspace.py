"""Folders for tables between jobs, shared by the driver and all executors."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

from loamline.sources import sinks

#: How stored tables are written: text of hashes takes half the room that Spark's own choice leaves.
CODEC = "zstd"
#: Rows of a part, about, of what shuffles whole rows, and the most parts: each part's shuffled files are removed before the next is begun.
PART_ROWS, MOST_PARTS = 2_000_000, 8


def folder(spark: SparkSession) -> str:
    """A fresh folder under spark.checkpoint.dir. Where that is unset, a local one serves a local session; a cluster must name one."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root}/{uuid.uuid4().hex}"


#: Bytes of code of a method up to which the JVM compiles it; Spark's own limit lets long rules become methods that are interpreted.
COMPILED = 8000


@contextmanager
def compiled(spark: SparkSession) -> Iterator[None]:
    """What is computed within is cut into methods that the JVM compiles."""
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), COMPILED)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


class _Open(threading.local):
    """Folders made within each of a thread's `passing`, the innermost last."""

    def __init__(self):
        self.folders: list[list[str]] = []


_open = _Open()
#: How many `passing` hold for a session, of all threads, and the setting before them.
_held: dict[int, tuple[int, str | None]] = {}
_lock = threading.Lock()
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _hold(spark: SparkSession, by: int) -> None:
    with _lock:
        key = spark._jsparkSession.hashCode()
        n, before = _held.pop(key, None) or (0, spark.conf.get(CLEANUP, None))
        if n + by:
            _held[key] = n + by, before
            spark.conf.set(CLEANUP, "true")
        elif before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Tables that this thread stores within are removed at the end, and what a job shuffled as soon as it is over. So nothing that
    reads them lazily may be handed out."""
    mine: list[str] = []
    _open.folders.append(mine)
    _hold(spark, 1)
    try:
        yield
    finally:
        _open.folders.pop()
        with suppress(Py4JError):  # what stays takes room only, and must not hide an error
            _hold(spark, -1)
            for path in mine:
                sinks.removed(spark, path)


def parts(rows: int) -> int:
    """In how many parts so many rows are shuffled whole."""
    return max(1, min(MOST_PARTS, -(-rows // PART_ROWS)))


def files_dealt(df: DataFrame, n: int) -> list[DataFrame]:
    """df, whose rows are those of stored tables one by one, in n parts of whole files."""
    names = sorted({f.rsplit("/", 1)[-1] for f in df.inputFiles()}) if n > 1 else []
    dealt = [names[k::n] for k in range(min(n, len(names)))]
    quoted = [", ".join(f"'{x}'" for x in some) for some in dealt]
    return [df.where(f"_metadata.file_name in ({some})") for some in quoted] if len(dealt) > 1 else [df]


def stored(*dfs: DataFrame, outlives: bool = False) -> DataFrame:
    """A table, computed once into such a folder; of several of one schema, one after another. outlives: the innermost `passing` leaves
    it to the one around it."""
    spark, schema = dfs[0].sparkSession, dfs[0].schema
    path = folder(spark)
    if len(_open.folders) > outlives:
        _open.folders[-1 - outlives].append(path)
    with compiled(spark):
        for df in dfs:
            df.write.mode("append").option("compression", CODEC).parquet(path)
    return spark.read.schema(schema).parquet(path)
