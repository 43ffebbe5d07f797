"""Whole-record normalization: parsed records become flat columns with canonical values."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamline.functions import clock, killer, version
from loamline.functions.killer import Names
from loamline.functions.text import add_article, first_not_empty, game_key, mapped, norm_bool, norm_char, norm_map, norm_place, present, sanitized_gold
from loamline.operators import parse
from loamline.operators.rules import Rule, names, rule_steps
from loamline.sources.workspace import stored

#: Fields of a record that rules of this module read; promoted() adds those that are declared or that rule tables name.
FIELDS = (
    "v vlong lv vsav vsavrv name race crace cls char title sk god tiles wiz alpha place oplace br xl sklev lvl absdepth hp mhp mmhp str int dex ac ev sh piety "
    "dur turn aut kills gold goldfound goldspent scrollsused potionsused sc dam sdam tdam start end time status ktyp killer ikiller killer_flags kaux map killermap tmsg vmsg "
    "type milestone banisher ntv explbr verb noun"
).split()


@dataclass(frozen=True)
class RuleBook:
    """All rule tables of a normalization.

    branches: names of branches that say nothing, as a pattern; versions never do. games: tag words of file names by game,
    the first that fits holds. prefixes: of table names by game.
    """

    branches: str = ""
    games: list[tuple[str, list[str]]] = field(default_factory=list)
    prefixes: dict[str, str] = field(default_factory=dict)
    fields: list[Rule] = field(default_factory=list)
    places: list[tuple[str, str]] = field(default_factory=list)
    gods: dict[str, str] = field(default_factory=dict)
    species: dict[str, str] = field(default_factory=dict)
    jobs: dict[str, str] = field(default_factory=dict)
    names: Names = field(default_factory=Names)


#: Columns that normalization makes of file and record themselves; a field of that name is left in the line.
OWN = ("base_table", "table", "cause", "__verb")


def wanted(keep: tuple[str, ...], book: RuleBook, more: tuple[str, ...] = (), only: tuple[str, ...] | None = None) -> list[str]:
    """The fields that normalization asks records for; only: those that the columns asked for come of."""
    all_ = [f for f in dict.fromkeys([*FIELDS, *more, *sorted(names(book.fields))]) if f not in keep and f not in OWN]
    if only is None:
        return all_
    read = needed(keep, only)
    read |= {"type", *names(book.fields), *(c for n in read for c in FIRST_READS.get(n, ()))}
    return [f for f in all_ if f in read]


def needed(keep: tuple[str, ...], only: tuple[str, ...]) -> set[str]:
    """What `begun` leaves for the last steps to make the columns asked for."""
    return {*only, *keep, "base_table", *(c for n in only for c in READS.get(n, ())), *(c for i in groups(only) for c in i)}


def promoted(records: DataFrame, keep: tuple[str, ...], book: RuleBook, more: tuple[str, ...] = (), only: tuple[str, ...] | None = None) -> DataFrame:
    """`keep`, then a text column for each of FIELDS, `more` and the fields of rules, null where it is absent; branch names
    that look like versions or that the book leaves out are dropped. Records have `fields`, or `__f` by parse.decoded."""
    found, columns_ = records, wanted(keep, book, more, only)
    kind = parse.record_kind(F.col("fields")) if "fields" in records.columns else F.when(F.col("__f")["type"].isNotNull(), F.lit("milestone")).otherwise(F.lit("logrecord"))
    if "fields" in records.columns:
        # all fields at once by way of JSON: looked up one by one, each would search the map from its start
        found = records.withColumn("__f", F.from_json(F.to_json("fields"), ", ".join(f"`{f}` string" for f in columns_)))
    fields = F.col("__f")

    def branch() -> Column:
        named = fields["explbr"]
        return F.when(~version.like_version(named) & (~named.rlike(book.branches) if book.branches else F.lit(True)), named)

    # names of Python keywords and SQL functions are fine as quoted columns
    columns = [branch().alias("explbr") if f == "explbr" else fields[f].alias(f) for f in columns_]
    return found.select(*keep, kind.alias("base_table"), *columns)


def _col(name: str) -> Column:
    return F.col(f"`{name}`")


#: Columns made for a rule book, by running Spark and book: they name fields only, so all loads and batches share them.
_made: dict[tuple[int, int], tuple[RuleBook, list[dict[str, Column]]]] = {}


def steps(book: RuleBook) -> list[dict[str, Column]]:
    """What normalization adds or replaces, step by step, in the order that the rules need."""
    key = id(SparkContext._active_spark_context), id(book)
    if key not in _made:
        if len(_made) >= 16:
            _made.pop(next(iter(_made)))
        _made[key] = book, _steps(book)
    return _made[key][1]


def _steps(book: RuleBook) -> list[dict[str, Column]]:
    empty = F.lit("")
    first = {
        "alpha": F.when(version.is_alpha(_col("v")), F.lit("t")).otherwise(_col("alpha")),
        "cv": version.canonical(_col("v")),
        "v": version.full(_col("v")),
        "vsavrv": version.strip_vcs(_col("vsavrv")),
        "tiles": norm_bool(_col("tiles")),
        "wiz": norm_bool(_col("wiz")),
        "ntv": first_not_empty(_col("ntv"), F.lit("0")),
        "place": norm_place(_col("place"), book.places),
        "oplace": norm_place(_col("oplace"), book.places),
        "br": norm_place(_col("br"), book.places),
        "god": mapped(_col("god"), book.gods, fold=True),
        "char": norm_char(first_not_empty(_col("crace"), _col("race")), _col("cls"), _col("char"), book.species, book.jobs),
        "rstart": _col("start"),
        "game_key": game_key(_col("name"), _col("src"), _col("start")),
        "banisher": F.when(_col("banisher").isNotNull(), add_article(_col("banisher"), book.names.special)),
    }
    milestone = F.col("base_table") == "milestone"
    blank = F.coalesce(_col("killer"), empty)
    second = {
        "vnum": version.number(_col("v")), "cvnum": version.number(_col("cv")), "vsavnum": version.number(_col("vsav")), "vsavrvnum": version.number(_col("vsavrv")), "vlongnum": version.number(_col("vlong")),
        "oplace": F.when(milestone, first_not_empty(_col("oplace"), _col("place"))).otherwise(_col("oplace")),
        "rtime": F.when(milestone, _col("time")),
        "rend": F.when(~milestone, _col("end")),
        "vmsg": first_not_empty(_col("vmsg"), _col("tmsg")),
        "map": norm_map(_col("map")),
        "killermap": norm_map(_col("killermap")),
        "ikiller": F.when(~milestone, first_not_empty(_col("ikiller"), _col("killer"))),
        "cbanisher": F.when(_col("banisher").isNotNull(), killer.canonical(_col("cv"), _col("banisher"), _col("banisher"), empty, book.names)),
        "kmod": F.when(~milestone, killer.modifier(blank)),
        "ckaux": F.when(~milestone, killer.weapon(F.coalesce(_col("kaux"), empty))),
        "__verb": mapped(_col("type"), book.names.verbs),
    }
    amounts = dict(zip(("gold", "goldfound", "goldspent"), sanitized_gold(*[_col(n) for n in ("gold", "goldfound", "goldspent")]), strict=True))
    third = {
        "ckiller": F.when(~milestone, killer.canonical(_col("cv"), first_not_empty(_col("killer"), _col("ktyp")), _col("killer"), _col("killer_flags"), book.names)),
        "cikiller": F.when(~milestone, killer.canonical(_col("cv"), _col("ikiller"), _col("ikiller"), empty, book.names)),
        "noun": F.when(milestone, killer.milestone_noun(_col("__verb"), _col("milestone"), F.coalesce(_col("place"), empty), F.coalesce(_col("oplace"), empty), F.coalesce(_col("god"), empty))),
        "verb": F.when(milestone, killer.milestone_verb(_col("__verb"), F.coalesce(_col("milestone"), empty))),
        **amounts,
    }
    return [*rule_steps(book.fields), first, second, third]


#: Rows of stored records from which the dear rules are worked out once for each tuple of their inputs, if these are fewer than one in
#: FEWER rows; and tuples up to which their table is broadcast.
DISTINCT_FROM, FEWER, BROADCAST_DISTINCT = 200_000, 4, 100_000
#: Rules by what they read: killers, weapons, banishers and numbers of versions take a value of few different ones through many patterns.
GROUPS = {
    ("base_table", "cv", "killer", "ktyp", "killer_flags", "ikiller"): ("ikiller", "kmod", "ckiller", "cikiller"),
    ("base_table", "kaux"): ("ckaux",),
    ("cv", "banisher"): ("cbanisher",),
    ("v", "cv"): ("vnum", "cvnum"),
    ("vsav", "vsavrv"): ("vsavnum", "vsavrvnum"),
    ("vlong",): ("vlongnum",),
}
#: What the last two steps read for a column, besides base_table and GROUPS.
READS = {
    "oplace": ("place",), "rtime": ("time",), "rend": ("end",), "vmsg": ("tmsg",), "verb": ("type", "milestone"), "noun": ("type", "milestone", "place", "oplace", "god"),
    **{n: ("gold", "goldfound", "goldspent") for n in ("gold", "goldfound", "goldspent")},
}


#: What the first step reads for a column, besides the column itself.
FIRST_READS = {"alpha": ("v",), "cv": ("v",), "char": ("crace", "race", "cls"), "rstart": ("start",), "game_key": ("name", "start")}


#: Outputs by their inputs, the stored table of both and its rows.
Tables = list[tuple[tuple[str, ...], tuple[str, ...], DataFrame, int]]


def distinct_tables(df: DataFrame, book: RuleBook, rows: int, only: tuple[str, ...] | None = None) -> Tables:
    """Of df, which is stored after `begun`, tables of GROUPS: what comes of each tuple of inputs, where these are few."""
    out: Tables = []
    for inputs, outputs in groups(only).items():
        tuples = stored(df.select(*[_col(c) for c in inputs]).distinct())
        n = tuples.count()
        if n * FEWER > rows:
            continue
        table = tuples.select("*", *[F.col(f"`{c}`").alias(f"__in_{k}") for k, c in enumerate(inputs)])
        for step in steps(book)[-2:]:
            table = table.withColumns({k: v for k, v in step.items() if k in outputs})
        out.append((inputs, outputs, stored(table.select(*[f"__in_{k}" for k in range(len(inputs))], *[_col(c).alias(f"__out_{c}") for c in outputs])), n))
    return out


def groups(only: tuple[str, ...] | None) -> dict[tuple[str, ...], tuple[str, ...]]:
    """Those of GROUPS of which something is asked for."""
    return {i: o for i, o in GROUPS.items() if only is None or set(o) & set(only)}


def begun(records: DataFrame, book: RuleBook, keep: tuple[str, ...] = ("src", "hash"), more: tuple[str, ...] = (), only: tuple[str, ...] | None = None) -> DataFrame:
    """The steps of normalization up to those that read many patterns, with the columns that these need."""
    df, before = promoted(records, keep, book, more, only), steps(book)[:-2]
    read = None if only is None else needed(keep, only)
    for step in before[:-1]:
        df = df.withColumns(step)
    df = df.withColumns({k: v for k, v in before[-1].items() if read is None or k in read})
    if read is not None:
        df = df.select(*[_col(c) for c in df.columns if c in read])
    return df


def ended(df: DataFrame, book: RuleBook, made: Tables, only: tuple[str, ...] | None = None) -> DataFrame:
    """The last steps of normalization, of which what the tables hold is looked up."""
    found: dict[str, Column] = {}
    drop: list[str] = []
    for g, (inputs, outputs, table, n) in enumerate(made):
        # all groups read what was stored, not what another has put in its place
        table = table.select(*[F.col(c).alias(f"{c}_{g}") for c in table.columns])
        on = [_col(c).eqNullSafe(F.col(f"__in_{k}_{g}")) for k, c in enumerate(inputs)]
        df = df.join(F.broadcast(table) if n <= BROADCAST_DISTINCT else table, reduce(lambda a, b: a & b, on), "left")
        drop += table.columns
        found |= {c: F.col(f"__out_{c}_{g}") for c in outputs}
    due = None
    if only is not None:
        due = {*only, *(c for o in groups(only).values() for c in o), *(("__verb", "oplace") if {"verb", "noun"} & set(only) else ())}
    for step in steps(book)[-2:]:
        df = df.withColumns({k: v for k, v in step.items() if k not in found and (due is None or k in due)})
    df = df.withColumns(found).drop(*drop, "__verb")
    return df if only is None else df.select(*[_col(c) for c in df.columns if c in only])


def normalized(records: DataFrame, book: RuleBook, keep: tuple[str, ...] = ("src", "hash"), more: tuple[str, ...] = (), rows: int | None = None, only: tuple[str, ...] | None = None) -> DataFrame:
    """Records with `fields` (or `__f`), `src` and `hash` to flat rows. more: further fields to keep. rows: how many there are, if that is known.

    Of many rows the rules of GROUPS are worked out once for each tuple of what they read, which gives the same rows. only: the columns
    that are asked for, as far as there are such; the others are neither stored nor worked out.
    """
    df, made = begun(records, book, keep, more, only), []
    if rows is not None and rows >= DISTINCT_FROM:
        df = stored(df)
        made = distinct_tables(df, book, rows, only)
    return ended(df, book, made, only)


TIMES = ("start", "end", "time")
#: Servers up to which their table is broadcast.
BROADCAST_SERVERS = 10_000


def timed(records: DataFrame, servers: DataFrame, to: str = "") -> DataFrame:
    """start, end and time in UTC by the server of `src`; servers (name, zone_s, zone_d, utc_epoch) are a few rows a site.

    A time that is there but can't be read is named in `cause`. to: begins the names of the columns that take the times, if these
    are not put in place of the texts.
    """
    zones = servers.select(F.col("name").alias("src"), clock.zone_offset(F.col("zone_s")).alias("__s"), clock.zone_offset(F.col("zone_d")).alias("__d"), clock.epoch_moment(F.col("utc_epoch")).alias("__e"))
    if servers.limit(BROADCAST_SERVERS + 1).count() <= BROADCAST_SERVERS:
        zones = F.broadcast(zones)
    # read once in a step of their own, as several expressions use them
    df = records.withColumns({f"__{n}_read": clock.raw_moment(_col(n)) for n in TIMES}).join(zones, "src", "left")
    bad = F.lit(False)
    for name in TIMES:
        bad = bad | (present(_col(name)).isNotNull() & F.col(f"__{name}_read").isNull())
    new = {f"{to}{n}": clock.shifted(F.col(f"__{n}_read"), _col(n), F.col("__e"), F.col("__s"), F.col("__d")) for n in TIMES}
    return df.withColumns({"cause": F.when(bad, F.lit("time")), **new}).drop(*[f"__{n}_read" for n in TIMES], "__s", "__d", "__e")
