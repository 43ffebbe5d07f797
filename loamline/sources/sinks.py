"""Writers of the star schema: fact tables by variant, dimensions, offsets and text exports."""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.sources import paths


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a stored table is there, asked of the file system that the path names."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, in order; none where it is missing."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(x.getPath().getName() for x in fs.listStatus(p)) if fs.exists(p) else []


def times_in(spark: SparkSession, path: str) -> dict[str, float]:
    """Names of what lies in a folder, with the seconds since the epoch at which each was last changed."""
    fs, p = _at(spark, path)
    return {x.getPath().getName(): x.getModificationTime() / 1000 for x in fs.listStatus(p)} if fs.exists(p) else {}


def touch(spark: SparkSession, path: str) -> None:
    """An empty file."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True).close()


def offset_log(spark: SparkSession, checkpoint: str) -> dict[str, str]:
    """The option of a stream's source that keeps its places in its checkpoint, where Python can write there."""
    fs, p = _at(spark, checkpoint)
    path = fs.makeQualified(p).toString()
    return {"offsetLog": f"{path}/places"} if paths.known(path) else {}


def write_facts(rows: DataFrame, path: str) -> None:
    """Appends rows, each to the folder of its table: one write, without a loop over tables."""
    rows.write.mode("append").partitionBy("table").parquet(path)


def write_dimension(values: DataFrame, path: str) -> None:
    values.write.mode("append").parquet(path)


def replaced(df: DataFrame, path: str) -> DataFrame:
    """Overwrites a table that df may itself read: to a new folder, which is then put in its place."""
    spark = df.sparkSession
    fresh = f"{path}.{uuid.uuid4().hex}"
    df.write.parquet(fresh)
    jvm = spark._jvm
    old, new, aside = (jvm.org.apache.hadoop.fs.Path(x) for x in (path, fresh, fresh + ".old"))
    fs = old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(old):
        fs.rename(old, aside)
    fs.rename(new, old)
    if fs.exists(aside):
        fs.delete(aside, True)
    spark.catalog.refreshByPath(path)
    return spark.read.parquet(path)


def tv_lines(facts: DataFrame, keys: DataFrame) -> DataFrame:
    """Lines `table, game key, row time, ntv` of rows with ntv above 0; keys is the dimension of game keys."""
    when = F.when(F.col("table").endswith("milestone"), F.col("rtime")).otherwise(F.col("rend"))
    rows = facts.where("ntv > 0").join(keys.select(F.col("id").alias("game_key_id"), F.col("value").alias("__key")), "game_key_id")
    return rows.select(F.concat_ws("\t", "table", "__key", when, F.col("ntv").cast("string")).alias("value"))


def tv_parsed(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (table, game_key, rowtime, ntv, position) of lines (value, position), and lines without exactly four parts."""
    parts = lines.withColumn("p", F.split("value", "\t", -1))
    good = parts.where("size(p) = 4").select(F.expr("get(p, 0)").alias("table"), F.expr("get(p, 1)").alias("game_key"), F.expr("get(p, 2)").alias("rowtime"), F.expr("try_cast(get(p, 3) as int)").alias("ntv"), "position")
    return good, parts.where("size(p) <> 4").drop("p")


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def text_of(spark: SparkSession, path: str) -> str:
    fs, p = _at(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def removed(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def put_new(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a small file that appears whole, unless there is one of that name: then False, and that one stays.

    The file is written under another name and then given its own: by a link on a local file system, elsewhere by a rename, which
    a file system with atomic names refuses if the name is taken.
    """
    fs, p = _at(spark, path)
    fs.mkdirs(p.getParent())
    if fs.exists(p):
        return False
    temp = spark._jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{uuid.uuid4().hex}")
    stream = fs.create(temp, False)
    stream.write(text.encode())
    stream.close()
    try:
        if fs.getUri().getScheme() == "file":
            name = lambda x: x.toUri().getPath()
            try:
                spark._jvm.java.nio.file.Files.createLink(spark._jvm.java.io.File(name(p)).toPath(), spark._jvm.java.io.File(name(temp)).toPath())
            except Py4JJavaError as e:
                if "FileAlreadyExists" in str(e.java_exception):
                    return False
                raise
            return True
        return fs.rename(temp, p)
    finally:
        if fs.exists(temp):
            fs.delete(temp, False)


def files_in(spark: SparkSession, path: str) -> list[str]:
    """Data files below a folder, as paths from it, without hidden ones."""
    fs, p = _at(spark, path)
    if not fs.exists(p):
        return []
    top, found, out = fs.makeQualified(p).toUri().getPath(), fs.listFiles(p, True), []
    while found.hasNext():
        at = found.next().getPath().toUri().getPath()[len(top) + 1 :]
        if not any(x.startswith((".", "_")) for x in at.split("/")):
            out.append(at)
    return sorted(out)


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gives a stream's checkpoint when it is made: another one, even in the same folder, is another stream."""
    return json.loads(text_of(spark, f"{checkpoint}/metadata"))["id"]
