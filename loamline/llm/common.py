"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from loamline.sources import workspace

from . import wordhash


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame) -> DataFrame:
    """Writes df once to the shared folder and reads it back: later jobs, and tasks of lost executors, start there."""
    return workspace.stored(df)


def text_slices(column: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about `limit` bytes: first row, row after the last, their UTF-8 bytes, offsets. Null reads as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n, data = len(column), column.buffers()[2]
    o = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    b = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = min(n, max(lo + 1, int(np.searchsorted(o, o[lo] + limit, "right")) - 1))
        yield lo, hi, b[o[lo] : o[hi]], o[lo : hi + 1] - o[lo]
        lo = hi


def row_slices(batch: pa.RecordBatch, size_of: pa.Array, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts take about `limit` bytes."""
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(size_of), 0), dtype=np.int64))
    lo = 0
    while lo < batch.num_rows:
        hi = int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + limit, "right"))
        hi = min(batch.num_rows, max(lo + 1, hi))
        yield batch.slice(lo, hi - lo)
        lo = hi


def _give_back() -> None:
    """Hands memory that Arrow and the C library hold unused back to the system, as workers live on after a task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(run, keep: str = "", every: int = 32):
    """A mapper of Arrow batches that first frees what other operators left in a reused worker, and now and then what is held unused.

    keep: the operator whose memory this mapper uses.
    """

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if wordhash.release(keep):
            _give_back()
        for k, batch in enumerate(run(batches), 1):
            yield batch
            if k % every == 0:
                _give_back()
        _give_back()

    return tidied


def appended(df: DataFrame, fields: str, make, text: str = "text", limit: int = 1 << 20, keep: str = "") -> DataFrame:
    """df with columns computed from its text column by make(Arrow column) -> list of Arrow arrays, in slices of about `limit` bytes. keep: the operator whose memory `make` uses.

    fields: their names and types in SQL; names must not be among df's columns.
    """
    from pyspark.sql.types import StructType

    new = StructType.fromDDL(fields)
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in row_slices(whole, whole.column(at), limit):
                yield pa.RecordBatch.from_arrays([*batch.columns, *make(batch.column(at))], [*batch.schema.names, *new.names])

    return df.mapInArrow(tidy(run, keep), StructType([*df.schema.fields, *new.fields]))
