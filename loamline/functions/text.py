"""Text expressions: every function takes Columns and gives a Column, evaluated in the JVM."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space that the rules know.
SPACE = r"[\t\n\f\r ]"
#: All white space of Unicode.
BLANKS = "\t\n\x0b\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def let(c: Column, use: Callable[[Column], Column]) -> Column:
    """use(c), with c worked out once however often it is used."""
    return F.element_at(F.transform(F.array(c), use), 1)


def trim_all(c: Column) -> Column:
    """Without Unicode white space at either end."""
    return F.btrim(c, F.lit(BLANKS))


def trim_right(c: Column) -> Column:
    return F.rtrim(c, F.lit(BLANKS))


def present(c: Column) -> Column:
    """Null for an empty text: absent and empty read alike."""
    return F.nullif(c, F.lit(""))


def first_not_empty(*choices: Column) -> Column:
    return F.coalesce(*[present(c) for c in choices], F.lit(""))


def parse_int(c: Column, default: int = 0) -> Column:
    """A 32-bit number; the default for any other text, blanks around it included."""
    number = F.when(c.rlike(r"^[+-]?[0-9]+\z"), c.try_cast("int"))
    return F.coalesce(number, F.lit(default)).cast("int")


def norm_bool(c: Column) -> Column:
    return ~F.coalesce(c, F.lit("")).isin("", "0", "f")


def norm_space(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, rf"^{SPACE}+|{SPACE}+\z", ""), rf"{SPACE}+", " ")


def norm_value(c: Column) -> Column:
    """As stored: underscores are spaces."""
    return F.replace(c, F.lit("_"), F.lit(" "))


def lookup_key(c: Column, case_sensitive: bool = False) -> Column:
    """The key by which a dimension knows a value."""
    return norm_value(c) if case_sensitive else F.lower(norm_value(c))


def norm_map(c: Column) -> Column:
    return F.replace(c, F.lit(","), F.lit(";"))


def sanitized_gold(gold: Column, found: Column, spent: Column) -> list[Column]:
    """The three amounts as numbers, all 0 if one is negative."""
    amounts = [parse_int(c) for c in (gold, found, spent)]
    return [F.when(F.least(*amounts) < 0, F.lit(0)).otherwise(a) for a in amounts]


def strip_depth(place: Column) -> Column:
    return F.regexp_replace(place, r":\d+", "")


def add_article(thing: Column, special: tuple[str, ...] = ()) -> Column:
    """With `a` or `an` before it, unless it is a name, is possessive, has an article or holds a special phrase."""
    plain = thing.contains("'") | thing.rlike(r"^(?:an?|the) ") | thing.rlike(r"^\p{Lu}") | (thing == "")
    plain = reduce(lambda a, p: a | thing.contains(p), special, plain)
    return F.when(plain, thing).when(thing.rlike("^[aeiou]"), F.concat(F.lit("an "), thing)).otherwise(F.concat(F.lit("a "), thing))


def replace_all(c: Column, pairs: list[tuple[str, str]]) -> Column:
    """Regex replacements one after another."""
    return reduce(lambda x, p: F.regexp_replace(x, p[0], p[1]), pairs, c)


def group_or_self(c: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match, else the text itself."""
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group)).otherwise(c)


def norm_place(place: Column, fixups: list[tuple[str, str]]) -> Column:
    return replace_all(place, [(f"(?iu){p}", r) for p, r in fixups])


def mapped(c: Column, pairs: dict[str, str], fold: bool = False) -> Column:
    """By a small table, else unchanged."""
    if not pairs:
        return c
    table = F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])
    return F.coalesce(F.element_at(table, F.lower(c) if fold else c), c)


def norm_char(species: Column, job: Column, existing: Column, species_abbr: dict[str, str], job_abbr: dict[str, str]) -> Column:
    """Four letters from full names; as it was unless both are known."""

    def short(c: Column, table: dict[str, str]) -> Column:
        return F.element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), c)

    return F.coalesce(F.concat(short(species, species_abbr), short(job, job_abbr)), existing)


def game_key(name: Column, src: Column, start: Column) -> Column:
    return F.concat_ws(":", name, src, start)
