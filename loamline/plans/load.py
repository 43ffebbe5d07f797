"""The load: scanned lines to a star schema, in batch or as one batch of a stream.

A load writes its rows, dimension values, hashes, ranges, rejected lines and report each to folders of its own and then puts one
commit (sources/commits.py), so that all of it counts together and once. If another load, or a repair, was first, what depends on
stored hashes and ids is done again from there: two loads at once give no id twice and keep no row twice.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.functions import clock
from loamline.functions.text import norm_value
from loamline.operators import dictionary, hashruns, normalize, parse, rules, tables
from loamline.operators.normalize import RuleBook
from loamline.operators.rules import Declared
from loamline.sources import commits, registry, workspace
from loamline.sources.commits import Snapshot

#: Lines below which they are dealt anew over all cores before they are decoded.
SPREAD_BELOW = 2_000_000
#: Rows of a file of facts, about, in loads that have fewer of them than cores.
FILE_ROWS = 50_000
KINDS = ("logrecord", "milestone")


@dataclass(frozen=True)
class Design:
    """Declared fields by kind of record; fields that share a dimension, by its name; and fields of the record that a dimension
    of one field keeps besides its value."""

    fields: Mapping[str, list[str]]
    shared: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    derived: Mapping[str, tuple[str, ...]] = field(default_factory=dict)

    def __post_init__(self):
        if both := set(self.shared) & set(self.derived):
            raise ValueError(f"a shared dimension keeps its value only: {sorted(both)}")

    def declared(self, kind: str) -> list[Declared]:
        return rules.declared(list(self.fields[kind]))

    def dimension_of(self, name: str) -> str:
        return next((d for d, names in self.shared.items() if name in names), name)

    def extra(self) -> list[Declared]:
        return rules.declared([s for specs in self.derived.values() for s in specs])

    def names(self) -> tuple[str, ...]:
        """All fields that records must be asked for."""
        return tuple(dict.fromkeys(f.name for f in [*(x for k in self.fields for x in self.declared(k)), *self.extra()] if not f.primary))


@dataclass(frozen=True)
class Star:
    """Where the tables of one star schema are. Readers see the last commit, or that of a snapshot."""

    root: str

    @property
    def log(self) -> commits.Log:
        return commits.Log(self.root)

    def complete(self, spark: SparkSession) -> list[str]:
        """Names of loads and streams, with the number of the last batch for those that have had several."""
        return [f"{k}-{v}" if v else k for k, v in sorted(self.log.snapshot(spark).done.items())]

    def read(self, spark: SparkSession, table: str, schema: str, seen: Snapshot | None = None, only: str | None = None) -> DataFrame:
        names = [c.split()[0].strip("`") for c in schema.split(", ")]
        return self.log.read(spark, seen or self.log.snapshot(spark), table, schema, only).select(*names)

    def facts(self, spark: SparkSession, kind: str, design: Design, seen: Snapshot | None = None) -> DataFrame:
        return self.read(spark, f"facts/{kind}", fact_schema(design, kind), seen)

    def dimension(self, spark: SparkSession, name: str, design: Design, seen: Snapshot | None = None) -> DataFrame:
        """Rows (id, key, value and what the dimension keeps besides)."""
        kept = [f.column for f in rules.declared(list(design.derived.get(name, ())))]
        return self.read(spark, "dimensions", dimension_schema(design), seen).where(F.col("dimension") == name).select("id", "key", "value", *kept)

    def offsets(self, spark: SparkSession, seen: Snapshot | None = None) -> DataFrame:
        """Each file's last loaded line; a file that was read anew from its begin counts from there."""
        ranges = self.read(spark, "ranges", RANGES, seen)
        last = ranges.groupBy("file").agg(F.max_by("last", F.struct("at", "last")).alias("file_offset"))
        return last.select("file", "file_offset")

    def rejected(self, spark: SparkSession) -> DataFrame:
        return self.read(spark, "rejected", REJECTED)

    def report(self, spark: SparkSession, load: str) -> DataFrame:
        """The report of a load, or of a stream's last batch."""
        seen = self.log.snapshot(spark)
        return self.read(spark, "reports", REPORT, seen, seen.notes.get(f"report {load}", ""))


#: Lines from `first` to `last` of a file were read, whatever came of them, with a version of the rules; generation tells a file that
#: was begun anew from what it was.
RANGES = "file string, generation string, first bigint, last bigint, at timestamp, rules bigint"
REJECTED = "file string, offset bigint, line string, src string, game string, cause string"
REPORT = "table string, rows_in bigint, rows_kept bigint, skipped bigint"


def fact_schema(design: Design, kind: str) -> str:
    columns = ["`table` string, `file` string, `file_offset` bigint, `hash` string"]
    for f in stored_fields(design, kind):
        columns.append(f"`{f.column}_id` bigint" if f.dimension else f"`{f.column}` {'boolean' if f.boolean else rules.TYPES[f.code]}")
    return ", ".join(columns)


def dimension_schema(design: Design) -> str:
    return "dimension string, id bigint, key string, value string" + "".join(f", `{f.column}` {'boolean' if f.boolean else rules.TYPES[f.code]}" for f in design.extra())


def stored_fields(design: Design, kind: str) -> list[Declared]:
    return [f for f in design.declared(kind) if not f.primary and f.name not in ("hash", "offset", "file", "table")]


#: Begins the names of columns that hold times in UTC, while others still read their texts.
UTC = "__utc_"


def prepared(scanned: DataFrame, book: RuleBook, servers: DataFrame, more: tuple[str, ...] = ()) -> tuple[DataFrame, Callable[[DataFrame], DataFrame], DataFrame, DataFrame]:
    """Records with `table`, stored; what makes normalized rows of them or of some of them; rejected lines; and file and offset of
    every line that can be a record.

    scanned: file, offset, line, src, game. Lines are decoded once, into a table of the columns that are asked for. Many rows are not
    stored again when they are normalized: what is dear is in tables by then.
    """
    if scanned.count() < SPREAD_BELOW:  # a few small files are few tasks
        scanned = scanned.repartition(scanned.sparkSession.sparkContext.defaultParallelism)
    own = ("src", "hash", "file", "offset", "game")
    only = tuple(dict.fromkeys(["base_table", *own, *normalize.TIMES, *more])) if more else None  # what nobody asks for isn't worked out
    lines = parse.decoded(scanned, normalize.wanted(own, book, more, only)).withColumnsRenamed({"cause": "__cause", "line": "__line"})
    lines = normalize.timed(normalize.begun(lines, book, (*own, "__line", "__cause"), more, only), servers, UTC)
    cause = F.coalesce("__cause", "cause")
    lines = workspace.stored(lines.withColumns({"cause": cause, "__line": F.when(F.col("__cause").isNotNull(), F.col("__line"))}).drop("__cause"))
    count = lines.count()
    table = registry.table_name(F.col("base_table"), F.col("game"), book.prefixes)
    good = lines.where("cause is null").drop("cause", "__line").withColumn("table", table)
    rejected = lines.where("cause is not null").select("file", "offset", F.col("__line").alias("line"), "src", "game", "cause")
    held = None if only is None else (*only, "table", *(f"{UTC}{n}" for n in normalize.TIMES))
    made = normalize.distinct_tables(good, book, count, held) if count >= normalize.DISTINCT_FROM else []

    def finished(rows: DataFrame) -> DataFrame:
        rows = normalize.ended(rows, book, made, held)
        return rows.withColumns({n: clock.shown(F.col(f"{UTC}{n}")) for n in normalize.TIMES}).drop(*(f"{UTC}{n}" for n in normalize.TIMES))

    if len(made) < len(normalize.groups(held)):  # rules are worked out row by row: once
        good, finished = workspace.stored(finished(good)), lambda rows: rows
    return good, finished, rejected, lines.select("file", "offset")


def _values(rows: DataFrame, design: Design, extra: list[Declared]) -> DataFrame:
    """Rows (dimension, key, value, kept, file, offset) of all fields that are in dimensions."""
    each = []
    for kind in design.fields:
        for f in (f for f in stored_fields(design, kind) if f.dimension):
            name = design.dimension_of(f.name)
            value = norm_value(F.coalesce(_text(rows, f.name), F.lit("")))
            own = {x.column for x in rules.declared(list(design.derived.get(name, ())))}
            kept = [(x.typed(_text(rows, x.name)) if x.column in own else F.lit(None).cast("boolean" if x.boolean else rules.TYPES[x.code])).alias(x.column) for x in extra]
            each.append(F.when(F.col("base_table") == kind, F.struct(F.lit(name).alias("dimension"), f.key(value).alias("key"), value.alias("value"), F.struct(F.lit(None).cast("string").alias("__none"), *kept).alias("kept"))))
    if not each:
        return rows.sparkSession.createDataFrame([], "dimension string, key string, value string, kept struct<__none: string>, file string, offset bigint")
    return rows.select("file", "offset", F.explode(F.array(*each)).alias("e")).where("e is not null").select("e.*", "file", "offset")


def spellings(rows: DataFrame, design: Design) -> DataFrame:
    """The different values of all dimensions (dimension, key, value, kept), a stored table."""
    return workspace.stored(_values(rows, design, design.extra()).drop("file", "offset").distinct())


def dimension_values(rows: DataFrame, design: Design, new: DataFrame | None = None, spelt: DataFrame | None = None) -> DataFrame:
    """All dimensions' values in one table (dimension, key, value and what dimensions keep besides): of equal keys the last spelling.

    new: only these keys (dimension, key). spelt: the rows' spellings. Only rows whose key has several are sorted for the last one.
    """
    spelt = spellings(rows, design) if spelt is None else spelt
    if new is not None:
        spelt = spelt.join(new, ["dimension", "key"], "left_semi")
    given = workspace.stored(spelt.groupBy("dimension", "key").agg(F.count(F.lit(1)).alias("__n"), F.first(F.struct("value", "kept")).alias("e")))
    several, out = given.where("__n > 1").select("dimension", "key"), given.where("__n = 1").drop("__n")
    if n := several.count():
        long = _values(rows, design, design.extra()).join(tables.joinable(several, n), ["dimension", "key"], "left_semi")
        out = out.unionByName(long.groupBy("dimension", "key").agg(F.max_by(F.struct("value", "kept"), F.struct("file", "offset")).alias("e")))
    return out.select("dimension", "key", "e.value", *[F.col(f"e.kept.{x.column}") for x in design.extra()])


def _text(rows: DataFrame, name: str) -> Column:
    kinds = dict(rows.dtypes)
    if name not in kinds:
        return F.lit(None).cast("string")
    return F.when(F.col(name), F.lit("t")).otherwise(F.lit("")) if kinds[name] == "boolean" else F.col(f"`{name}`").cast("string")


def unread(scanned: DataFrame, ranges: DataFrame) -> DataFrame:
    """Lines (file, generation, offset, ...) without those that lie in ranges that were read before.

    Ranges are gathered by file, of which a batch names few; files of no range keep all their lines. Of a file that was once begun
    anew with the first line that it had, places don't tell what was read: its lines stay, and hashes tell.
    """
    files = scanned.select("file").distinct()
    read = ranges.join(files, "file", "left_semi").groupBy("file", F.substring_index("generation", "+", 1).alias("generation"))
    read = read.agg(F.collect_list(F.struct("first", "last")).alias("__r"), F.max(F.col("generation").contains("+")).alias("__again")).where("not __again").drop("__again")
    known = F.exists("__r", lambda r: F.col("offset").between(r["first"], r["last"]))
    return scanned.join(read, ["file", "generation"], "left").where(~F.coalesce(known, F.lit(False))).select(*scanned.columns)


def ranges_of(lines: DataFrame, before: DataFrame) -> DataFrame:
    """Ranges (file, generation, first, last) of lines that a source reads one after another from a file's begin: each goes on where
    those before it ended, so that they can be joined."""
    new = lines.groupBy("file", "generation").agg(F.min("offset").alias("first"), F.max("offset").alias("last"))
    old = before.join(new.select("file"), "file", "left_semi").groupBy("file", "generation").agg(F.max("last").alias("__old"))
    return new.join(old, ["file", "generation"], "left").select("file", "generation", F.coalesce(F.least("first", F.col("__old") + 1), "first").alias("first"), "last")


def known(hashes: DataFrame, spark: SparkSession, star: Star, seen: Snapshot, count: int) -> DataFrame | None:
    """Of hashes (hash), which can be read several times, those that are stored already, to be joined; None if there are none."""
    if not seen.folders.get("hashes"):
        return None
    runs = star.log.read(spark, seen, "hashes", hashruns.RUN)
    gone = star.read(spark, "forgotten", hashruns.GONE, seen)
    found = hashruns.found(runs, gone, hashes, count).select("hash")
    return tables.joinable(found, n) if (n := found.count()) else None


def with_ids(facts: DataFrame, ids: DataFrame, fields: list[Declared], design: Design, counts: Mapping[str, int]) -> DataFrame:
    """facts with ids for the fields' values; ids (dimension, key, id) are those that this load needs, counts how many by dimension.
    Each dimension is broadcast while it is small by itself, so a large one shuffles facts once and the rest don't."""
    for f in fields:
        name = design.dimension_of(f.name)
        own = tables.joinable(ids.where(F.col("dimension") == name).select("id", "key"), counts.get(name, 0))
        facts = tables.resolved(facts, own, f.column, f"{f.column}_id", f.case_sensitive).drop(f.column)
    return facts


def load(scanned: DataFrame, star: Star, book: RuleBook, servers: DataFrame, design: Design | list[str], strict: bool = False, name: str | None = None, number: int = 0, ranges: DataFrame | None = None, rules_version: int = 0) -> DataFrame:
    """Loads lines and returns the report by table: rows in, rows kept, duplicates.

    A record is kept once for its hash, over all tables and loads. Offsets also move over duplicates and rejected lines. A load
    of a name that is complete, or of a number that its name has passed, is not run again. design: a list of fields is that of both
    kinds. strict: rejected lines are an error. ranges: what was read (file, generation, first, last), if lines were told another
    file or place than they have; else each file from its first line here to its last. rules_version is kept with them.
    """
    spark = scanned.sparkSession
    if not isinstance(design, Design):
        design = Design({kind: design for kind in KINDS})
    log, seen = star.log, star.log.snapshot(spark)
    if name and seen.has(name, number):
        return star.report(spark, name)
    folder = commits.fresh_name(name or "lines")

    def put(df: DataFrame, table: str, *by: str, mode: str = "overwrite") -> None:
        with workspace.compiled(spark):
            df.write.mode(mode).option("compression", workspace.CODEC).partitionBy(*by).parquet(f"{star.root}/{table}/{folder}")

    with workspace.passing(spark):
        good, finished, rejected, read = prepared(scanned, book, servers, design.names())
        rows = finished(good)
        if strict and rejected.limit(1).count():
            raise ValueError("lines were rejected")
        put(rejected, "rejected")
        if ranges is None:
            ranges = read.groupBy("file").agg(F.min("offset").alias("first"), F.max("offset").alias("last")).withColumn("generation", F.lit(""))
        put(ranges.select("file", "generation", "first", "last", F.current_timestamp().alias("at"), F.lit(rules_version).cast("long").alias("rules")).coalesce(8), "ranges")
        lines = good.count()
        first, count = tables.first_in_parts(good, workspace.files_dealt(good, workspace.parts(lines)))
        spelt = spellings(rows, design)
        keys = workspace.stored(spelt.select("dimension", "key").distinct())
        counts = {r[0]: r[1] for r in keys.groupBy("dimension").count().collect()}  # a row for each dimension of the design
        n_keys = sum(counts.values())
        files = max(1, -(-count // len(first) // FILE_ROWS))  # so that small loads leave no more files than they need
        rest = ~F.col("base_table").isin(*design.fields)  # records of a kind that has no facts here: their hashes count all the same
        has_rest = bool(good.where(rest).limit(1).count())

        def work(seen: Snapshot) -> commits.Commit | None:
            """What depends on what is stored: new hashes, new keys, and the rows with their ids."""
            if name and seen.has(name, number):
                return None
            with workspace.passing(spark):
                return written(seen)

        def written(seen: Snapshot) -> commits.Commit:
            found = known(good.select("hash"), spark, star, seen, count)
            kept = [some if found is None else tables.not_known(some, found) for some in first]
            held = dictionary.known(star.read(spark, "dimensions", f"{dimension_schema(design)}, {dictionary.SLOT}", seen), keys, n_keys)
            new = keys.join(held, ["dimension", "key"], "left_anti")
            tops = spark.createDataFrame(list(seen.tops.items()), "dimension string, top bigint")
            fresh = workspace.stored(tables.numbered_within(dimension_values(rows, design, new, spelt), "dimension", tops))
            dictionary.written(fresh.select(*[c.split()[0].strip("`") for c in dimension_schema(design).split(", ")]), f"{star.root}/dimensions/{folder}")
            ids = held.unionByName(fresh.select("dimension", "key", "id"))
            saved = []  # read from what was written, so that whole rows are joined once
            for kind in design.fields:
                fields = stored_fields(design, kind)
                for k, part in enumerate(kept):
                    some = finished(part.where(F.col("base_table") == kind)).withColumn("file_offset", F.col("offset").cast("long"))
                    typed = with_ids(rules.typed_select(some, fields, ("table", "file", "file_offset", "hash")), ids, [f for f in fields if f.dimension], design, counts)
                    typed = typed.select(*[c.split()[0].strip("`") for c in fact_schema(design, kind).split(", ")])
                    put(typed.coalesce(files) if files < spark.sparkContext.defaultParallelism else typed, f"facts/{kind}", "table", mode="append" if k else "overwrite")
                saved.append(spark.read.schema(fact_schema(design, kind)).parquet(f"{star.root}/facts/{kind}/{folder}").select("hash", "file", "table"))
            if has_rest:
                saved.append(workspace.stored(*[part.where(rest).select("hash", "file", "table") for part in kept]))
            saved = reduce(lambda a, b: a.unionByName(b), saved)
            hashruns.written(saved, f"{star.root}/hashes/{folder}", count)
            put(tables.load_report(good, saved), "reports")
            top = {r[0]: r[1] for r in fresh.groupBy("dimension").agg(F.max("id")).collect()}  # a row for each dimension of the design
            names = ["rejected", "ranges", "dimensions", "hashes", "reports", *(f"facts/{k}" for k in design.fields)]
            return commits.Commit("load", {t: [folder] for t in names}, tops=top, done=(name, number) if name else None, note={f"report {name}": folder} if name else {})

        after = log.transact(spark, work)
    return star.report(spark, name) if name else star.read(spark, "reports", REPORT, after, folder)


def all_facts(spark: SparkSession, star: Star, design: Design) -> DataFrame:
    """Facts of all kinds; columns that one lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [star.facts(spark, kind, design) for kind in design.fields])
