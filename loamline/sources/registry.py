"""The dimension of source files: what is read from where, derived from servers and their log specs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamline.functions import filename

Games = list[tuple[str, list[str]]]


def expanded(spec: Column, groups: int) -> Column:
    """A spec's brace groups as an array of names, one group `{a,b}` at a time, innermost first; groups: how many a spec has at most."""
    group = r"^(.*)\{([^{}]*)\}(.*)\z"

    def once(names: Column) -> Column:
        def choices(n: Column) -> Column:
            parts = F.split(F.regexp_extract(n, group, 2), ",", -1)
            return F.when(n.rlike(group), F.transform(parts, lambda p: F.concat(F.regexp_extract(n, group, 1), p, F.regexp_extract(n, group, 3)))).otherwise(F.array(n))

        return F.flatten(F.transform(names, choices))

    out = F.array(spec)
    for _ in range(groups):
        out = F.array_distinct(once(out))
    return F.array_sort(F.array_distinct(out))


def source_dim(servers: DataFrame, games: Games) -> DataFrame:
    """One row a file, from servers (name, base, logs: array of (spec, qualifier)), a table of settings; `*` in a spec marks it live."""
    spec = servers.select(F.col("name").alias("server"), "base", F.explode("logs").alias("l")).select("server", "base", "l.spec", "l.qualifier")
    groups = spec.agg(F.max(F.length("spec") - F.length(F.replace("spec", F.lit("{"), F.lit(""))))).first()[0] or 0
    files = spec.select("server", "base", "qualifier", F.col("spec").contains("*").alias("live"), F.explode(expanded(F.replace("spec", F.lit("*"), F.lit("")), groups)).alias("name"))
    url = filename.url_join(F.col("base"), F.col("name"))
    return files.select(
        "server", "name", "live", url.alias("url"), filename.target_path(F.col("server"), url).alias("target"), filename.kind(F.col("name")).alias("kind"), filename.game(F.col("name"), games).alias("game"),
        filename.version(F.col("name")).alias("version"), filename.qualified_name(F.col("server"), filename.kind(F.col("name")), filename.version(F.col("name")), filename.game(F.col("name"), games), F.coalesce("qualifier", F.lit(""))).alias("file"),
    )


def table_name(base: Column, game: Column, prefixes: dict[str, str]) -> Column:
    """A variant's name of a fact table; a game without a prefix of its own gives its name."""
    prefix = F.element_at(F.create_map(*[F.lit(x) for kv in ({"": ""} | prefixes).items() for x in kv]), game)
    return F.concat(F.coalesce(prefix, F.concat(game, F.lit("_"))), base)


def attributed(scanned: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows of a scan with the server, kind, game and version of their file; sources is a dimension, which AQE broadcasts while it is small."""
    return scanned.join(sources.select(F.col("target").alias("file"), "server", "kind", "game", "version"), "file")


def attributed_by_name(files: DataFrame, servers: DataFrame, name: str = "name") -> DataFrame:
    """Files named remote.<server>-<rest> with their server, found by name or alias; other files are left out."""
    known = servers.select(F.col("name").alias("server"), F.explode(F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("__as"))
    out = files.withColumn("__as", filename.forced_server(F.col(name))).withColumn("kind", filename.strict_kind(F.col(name)))
    return out.where("__as <> '' and kind <> 'unknown'").join(known.dropDuplicates(["__as"]), "__as").drop("__as")


def filtered(df: DataFrame, parts: list[str], columns: tuple[str, ...] = ("kind", "url", "target")) -> DataFrame:
    """Rows of which a described column contains any of the parts; all rows if there are none."""
    if not parts:
        return df
    return df.where(reduce(lambda a, b: a | b, [F.col(c).contains(p) for c in columns for p in parts]))
