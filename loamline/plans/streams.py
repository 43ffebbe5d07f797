"""Queries that follow files as streams. Each writes lines of the given tables as files, in two lots, and follows them."""

from __future__ import annotations

import time
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.functions import filename
from loamline.operators import rules
from loamline.plans import fixtures, load, stars
from loamline.plans.fixtures import BOOK
from loamline.plans.registry import query
from loamline.sources import rulebooks, sinks, workspace, xlog
from loamline.streaming import loading, tail

c = F.col
EVENTS = f"select i, line from ({fixtures.in_sql(fixtures.MILESTONE)})"
HASHES = "select md5(text) as hash from documents group by 1"


def put(spark: SparkSession, sf_dir: str, path: str, which: str = "event") -> None:
    """Appends a lot of files with event lines, or with one line for each document's hash."""
    if which in ("hash", "more"):
        docs = fixtures.table(spark, sf_dir, "documents").where("true" if which == "hash" else "doc_id % 2 = 0")
        rows = docs.select(F.md5(F.encode("text", "UTF-8")).alias("value"))
    else:
        rows = fixtures.lines(spark, sf_dir, fixtures.MILESTONE).where(which).select(F.concat(c("i").cast("string"), F.lit("\t"), "line").alias("value"))
    rows.repartition(4).write.mode("append").text(path)


def arrived(spark: SparkSession, lots: list[str], path: str) -> None:
    """The files of folders come into another at once, each whole under a name of its own, however long it took to write them."""
    jvm = spark._jvm
    for k, lot in enumerate(lots):
        fs, folder = sinks._at(spark, lot)
        for name in sinks.names_in(spark, lot):
            if name.startswith("part-"):
                if not fs.rename(jvm.org.apache.hadoop.fs.Path(folder, name), jvm.org.apache.hadoop.fs.Path(path, f"lot{k}-{name}")):
                    raise OSError(f"{lot}/{name} could not be moved")


def followed(spark: SparkSession, out: str, columns: str = "file string, offset bigint, line string") -> DataFrame:
    return tail.stored_rows(spark, out, columns)


def events(spark: SparkSession, out: str) -> DataFrame:
    rows = followed(spark, out)
    return rows.select(F.substring_index("line", "\t", 1).cast("long").alias("i"), F.expr("substr(line, instr(line, '\t') + 1)").alias("line"))


def batch_number():
    return F.regexp_extract(F.input_file_name(), "/batch=([^/]+)/", 1)


def folders(spark: SparkSession) -> tuple[str, str, str]:
    root = workspace.folder(spark)
    return f"{root}/in", f"{root}/out", f"{root}/checkpoint"


@query("stream_tail", EVENTS)
def stream_tail(spark, sf_dir):
    path, out, checkpoint = folders(spark)
    for lot in ("i % 2 = 0", "i % 2 = 1"):
        put(spark, sf_dir, path, lot)
        tail.caught_up(spark, path, out, checkpoint)
    return events(spark, out)


@query("stream_backfill", EVENTS)
def stream_backfill(spark, sf_dir):
    path, out, checkpoint = folders(spark)
    put(spark, sf_dir, path, "i % 2 = 0")
    running = tail.backfilled(spark, path, out, checkpoint)
    try:
        put(spark, sf_dir, path, "i % 2 = 1")
        running.processAllAvailable()
    finally:
        running.stop()
    return events(spark, out)


@query("stream_batch_limit", f"select i, line, true as several, true as bounded from ({EVENTS})")
def stream_batch_limit(spark, sf_dir):
    """The rows, with whether they came in three batches or more, each of at most the limit and a line."""
    path, out, checkpoint = folders(spark)
    put(spark, sf_dir, path, "true")
    limit = sum(xlog.listed(path).values()) // 3 + 1
    running = tail.follow(spark, path, out, checkpoint, once=False, maxBytesPerTrigger=limit)
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    size = F.octet_length("line") + 1
    batches = followed(spark, out).groupBy(batch_number()).agg(F.sum(size).alias("bytes"), F.max(size).alias("longest"))
    several, bounded = batches.agg(F.count(F.lit(1)) >= 3, F.bool_and(c("bytes") <= limit + c("longest"))).first()
    return events(spark, out).select("i", "line", F.lit(several).alias("several"), F.lit(bounded).alias("bounded"))


@query("stream_debounce", f"select i, line, true as fewer from ({EVENTS})")
def stream_debounce(spark, sf_dir):
    """The rows, with whether a burst of three lots within an interval made fewer batches than lots."""
    path, out, checkpoint = folders(spark)
    put(spark, sf_dir, path, "i % 4 = 0")
    tail.caught_up(spark, path, out, checkpoint)
    lots = {f"{path}-{lot}": f"i % 4 = {lot}" for lot in (1, 2, 3)}
    for folder, which in lots.items():  # a large lot takes longer to write than an interval
        put(spark, sf_dir, folder, which)
    running = tail.follow(spark, path, out, checkpoint, once=False, every="6 seconds")
    try:
        arrived(spark, list(lots), path)
        running.processAllAvailable()
    finally:
        running.stop()
    batches = followed(spark, out).select(batch_number().alias("b")).agg(F.count_distinct("b")).first()[0]
    return events(spark, out).select("i", "line", F.lit(batches < 4).alias("fewer"))


def hashed(batch: DataFrame) -> DataFrame:
    return batch.select(c("line").alias("hash"), "file", "offset")


@query("stream_dedup", HASHES)
def stream_dedup(spark, sf_dir):
    path, out, checkpoint = folders(spark)
    for _ in range(2):
        put(spark, sf_dir, path, "hash")
        tail.caught_up(spark, path, out, checkpoint, handle=hashed, dedup="hash")
    return followed(spark, out, "hash string, file string, offset bigint").select("hash")


@query("stream_exactly_once", HASHES)
def stream_exactly_once(spark, sf_dir):
    """The checkpoint is lost after several batches, with new lines between and another limit: nothing is lost or doubled."""
    path, out, checkpoint = folders(spark)
    for point, limit in ((checkpoint, 4096), (checkpoint + "-lost", 16384)):
        put(spark, sf_dir, path, "hash" if point == checkpoint else "more")
        tail.caught_up(spark, path, out, point, handle=hashed, dedup="hash", maxBytesPerTrigger=limit)
        put(spark, sf_dir, path, "hash")
        tail.caught_up(spark, path, out, point, handle=hashed, dedup="hash")
    return followed(spark, out, "hash string, file string, offset bigint").select("hash")


@query("stream_rules_reload", f"select i, case when i % 2 = 0 then replace(line, 'Okawaru', 'Oka') else replace(line, 'Okawaru', 'Wulu') end as line from ({EVENTS})")
def stream_rules_reload(spark, sf_dir):
    path, out, checkpoint = folders(spark)
    table = f"{path}-rules"

    def handle(batch: DataFrame) -> DataFrame:
        pairs = [(r[0], r[1]) for r in spark.read.parquet(table).collect()]  # a rule table
        return batch.withColumn("line", rules.regexp(c("line"), pairs))

    for lot, new in ((0, "Oka"), (1, "Wulu")):
        put(spark, sf_dir, path, f"i % 2 = {lot}")
        spark.createDataFrame([("Okawaru", new)], "pattern string, replacement string").write.mode("overwrite").parquet(table)
        tail.caught_up(spark, path, out, checkpoint, handle=handle)
    return events(spark, out)


@query("stream_reappear", EVENTS)
def stream_reappear(spark, sf_dir):
    path, out, checkpoint = folders(spark)
    jvm = spark._jvm
    put(spark, sf_dir, path, "i % 2 = 0")
    tail.caught_up(spark, path, out, checkpoint)
    here, away = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(path + "-away")
    fs = here.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.rename(here, away)
    put(spark, sf_dir, path, "i % 2 = 1")
    tail.caught_up(spark, path, out, checkpoint)
    for status in fs.listStatus(away):  # the files come back: nothing of them is read twice
        if status.getPath().getName().startswith("part-"):
            fs.rename(status.getPath(), jvm.org.apache.hadoop.fs.Path(path, status.getPath().getName()))
    tail.caught_up(spark, path, out, checkpoint)
    return events(spark, out)


def attributed(batch: DataFrame) -> DataFrame:
    """Server and game by the file's name; the number of the line stands for its offset."""
    name = F.regexp_extract("file", "/name=([^/]+)/", 1)
    number = F.substring_index("line", "\t", 1).cast("long")
    return batch.select(name.alias("file"), number.alias("offset"), F.expr("substr(line, instr(line, '\t') + 1)").alias("line"), F.substring_index(name, "-", 1).alias("src"), filename.game(name, BOOK.games).alias("game"))


@query("stream_load", stars.LOADED)
def stream_load(spark, sf_dir):
    """Two lots of log lines that overlap, followed into a star schema; the second batch fails before it is committed, and then the checkpoint is lost."""
    path, root, checkpoint = folders(spark)
    star, rows = load.Star(root), stars.log_files(spark, sf_dir)
    rows = rows.select(F.concat_ws("-", "src", F.nullif("game", F.lit(""))).alias("name"), F.concat(c("offset").cast("string"), F.lit("\t"), "line").alias("value"), "offset")

    def run() -> None:
        loading.followed_load(spark, path, star, checkpoint, attributed, BOOK, fixtures.servers(spark), stars.LOGS_ONLY).awaitTermination()

    for lot in ("offset % 3 < 2", "offset % 3 > 0"):
        with workspace.passing(spark):  # what the lines were made by doesn't stay beside them
            rows.where(lot).select("name", "value").write.mode("append").partitionBy("name").text(path)
        run()
    # as after a crash just before the last commit: what the load left is not read; and the checkpoint is lost as well
    last = star.log.snapshot(spark).version
    sinks.removed(spark, f"{root}/log/{last:020d}.json")
    checkpoint += "-lost"
    run()
    facts = stars.named(spark, star, star.facts(spark, "logrecord", stars.LOGS_ONLY), stars.LOGS_ONLY, pname="name", cv="cv")
    return facts.select("file_offset", "pname", "cv", "table", "sc")


RELOADED = stars.GOOD.format("""select i as file_offset, 'Cust ' || k as pname, case when i % 4 <> 0 then '' when (i // 4) % 2 = 0 then 'spr_' else 'sprint_' end || 'logrecord' as "table" from t""")


@query("stream_star_rules", RELOADED)
def stream_star_rules(spark, sf_dir):
    """Two lots followed into a star by one query that goes on: files are taken when they are quiet, and a new version of the rules, put
    while the query runs, holds for the second lot."""
    path, root, checkpoint = folders(spark)
    star, books = load.Star(root), rulebooks.RuleBooks(spark, f"{root}-rules")
    rows = stars.log_files(spark, sf_dir)
    rows = workspace.stored(rows.select(F.concat_ws("-", "src", F.nullif("game", F.lit(""))).alias("name"), F.concat(c("offset").cast("string"), F.lit("\t"), "line").alias("value"), "offset"))
    seen, running = 0, None
    for lot, prefix in ((0, "spr_"), (1, "sprint_")):
        books.put(replace(BOOK, prefixes=BOOK.prefixes | {"sprint": prefix}))
        some = rows.where(f"offset div 4 % 2 = {lot}")
        seen += some.count()
        some.repartition("name").select("name", "value").write.mode("append").partitionBy("name").text(path)
        running = running or loading.followed_load(spark, path, star, checkpoint, attributed, books, fixtures.servers(spark), stars.LOGS_ONLY, once=False, quietSeconds=1)
        waited(running, seen)
    running.stop()
    facts = stars.named(spark, star, star.facts(spark, "logrecord", stars.LOGS_ONLY), stars.LOGS_ONLY, pname="name")
    return facts.select("file_offset", "pname", "table")


def waited(running, lines: int, seconds: float = 600) -> None:
    """Returns once batches with so many lines are through. A query that ends before, or takes longer, is stopped and an error."""
    until = time.monotonic() + seconds
    while sum(p["numInputRows"] for p in running.recentProgress) < lines:
        if not running.isActive or time.monotonic() > until:
            running.stop()
            raise running.exception() or TimeoutError(f"not done in {seconds} s")
        time.sleep(0.5)
