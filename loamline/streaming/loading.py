"""A stream of growing files into a star schema: each batch is one load, and one commit names the lines that it read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loamline.operators.normalize import RuleBook
from loamline.plans.load import RANGES, Design, Star, load, ranges_of, unread
from loamline.sources import sinks, workspace, xlog

Rules = Callable[[], tuple[int, RuleBook]]


def new_lines(batch: DataFrame, before: DataFrame) -> DataFrame:
    """The batch, read once, without lines of ranges that were read before; a stored table."""
    with workspace.passing(batch.sparkSession):
        return workspace.stored(unread(workspace.stored(batch), before), outlives=True)


def followed_load(spark: SparkSession, path: str, star: Star, checkpoint: str, attribute: Callable[[DataFrame], DataFrame], book: RuleBook | Rules, servers: DataFrame, design: Design, name: str = "stream", once: bool = True, every: str = "250 milliseconds", **options):
    """A query from files under path into the star.

    attribute: from (file, offset, line) to (file, offset, line, src, game). book: rules, or a function that gives a version and the
    rules, which is asked for each batch. once: catch up and stop; else go on every interval.

    A batch that is run again after a failure does nothing if it was committed, else all of it. Each commit names the ranges of lines that
    were read; a stream that begins anew, as with a lost checkpoint or another limit, passes over these and takes what is new, so that
    each line, a rejected one too, counts once. options are those of the source; quietSeconds is for streams that go on.
    """

    def put(batch: DataFrame, number: int) -> None:
        stream = f"{name}-{sinks.checkpoint_id(spark, checkpoint)}"
        seen = star.log.snapshot(spark)
        if seen.has(stream, number):
            return
        with workspace.passing(batch.sparkSession):
            before = star.read(spark, "ranges", RANGES, seen)
            lines = new_lines(batch, before) if seen.folders.get("ranges") else workspace.stored(batch)
            version, rules = book() if callable(book) else (0, book)
            load(attribute(lines.drop("generation")), star, rules, servers, design, name=stream, number=number, ranges=ranges_of(lines, before), rules_version=version)

    if once:
        options = {k: v for k, v in options.items() if k != "quietSeconds"}
    options = sinks.offset_log(spark, checkpoint) | options
    writer = xlog.tail(spark, path, generation="true", **options).writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()
