"""Version expressions: full and major forms, the alpha mark and an order-preserving number."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from loamline.functions.text import group_or_self, let, parse_int, trim_all

#: The forms of a qualifier.
NAMED = r"^([a-z]+)([0-9]*)(?:-(\d+))?"
COMMITS = r"^(\d+)-"


def full(v: Column) -> Column:
    """X.Y becomes X.Y.0, a suffix stays."""
    return F.regexp_replace(v, r"^(\d+\.\d+)(\z|[^\d.])", "$1.0$2")


def major(v: Column) -> Column:
    return group_or_self(v, r"(\d+\.\d+)")


def is_alpha(v: Column) -> Column:
    return v.rlike("-[a-z]")


def canonical(v: Column) -> Column:
    """The major version, marked if alpha."""
    return F.concat(major(v), F.when(is_alpha(v), F.lit("-a")).otherwise(F.lit("")))


def number(v: Column) -> Column:
    """A number that sorts as versions do; 0 for null counts as no version at all."""
    v = trim_all(F.coalesce(v, F.lit("")))
    dotted = F.substring_index(v, "-", 1)
    qualifier = F.when(v.contains("-"), F.substring(v, F.length(dotted) + 2, F.length(v))).otherwise(F.lit(""))
    parts = F.split(dotted, r"\.")
    # three parts at most are weighed one by one; lambdas, which are slow, are for more
    few = reduce(add, [F.coalesce(parse_int(F.get(parts, F.lit(k))).cast("long"), F.lit(0)) * F.lit(100_000_000 * 1000 ** (2 - k)) for k in range(3)])
    many = F.aggregate(
        F.reverse(parts),
        F.struct(F.lit(0).cast("long").alias("sum"), F.lit(100_000_000).cast("long").alias("unit")),
        lambda a, p: F.struct((a["sum"] + parse_int(p).cast("long") * a["unit"]).alias("sum"), (a["unit"] * 1000).alias("unit")),
        lambda a: a["sum"],
    )
    weighed = F.when(F.size(parts) <= 3, few).otherwise(many)
    return weighed + F.when(qualifier == "", F.lit(99_000_000).cast("long")).otherwise(let(qualifier, _rank))


def _rank(qualifier: Column) -> Column:
    named, commits = qualifier.rlike(NAMED), qualifier.rlike(COMMITS)
    prefix = F.when(named, F.regexp_extract(qualifier, NAMED, 1)).when(commits, F.lit("")).otherwise(qualifier)
    upper = F.when(named, parse_int(F.regexp_extract(qualifier, NAMED, 2))).otherwise(F.lit(0))
    lower = F.when(named, parse_int(F.regexp_extract(qualifier, NAMED, 3))).when(commits, parse_int(F.regexp_extract(qualifier, COMMITS, 1))).otherwise(F.lit(0))
    letter = F.when(prefix == "", F.lit(99)).otherwise(F.pmod(F.ascii(prefix) - 96, F.lit(256)))
    return letter.cast("long") * 1_000_000 + upper.cast("long") * 10_000 + lower.cast("long")


def strip_vcs(v: Column) -> Column:
    return F.regexp_replace(v, "^.*?:+", "")


def expand_key(k: Column) -> Column:
    """01 is 0.1, 10 is 0.10."""
    return F.concat(F.lit("0."), F.regexp_replace(k, "^0+", ""))


def like_version(c: Column) -> Column:
    return c.rlike(r"^\d+\.\d+")
