"""Repair jobs: DataFrames of stored tables in, repaired ones out. Values are repaired in dimensions, then facts are pointed anew."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamline.functions import version
from loamline.functions.text import lookup_key
from loamline.operators import tables
from loamline.operators.rules import Rule


def renumbered(dimension: DataFrame, number: str) -> DataFrame:
    """A version dimension (value, number) with its numbers computed anew."""
    return dimension.withColumn(number, version.number(F.col("value")))


def mismatched(facts: DataFrame, species: DataFrame, jobs: DataFrame) -> DataFrame:
    """Rows whose char (value) disagrees with the abbreviation of their species or job, where that is known; with `right`."""
    s = species.select(F.col("name").alias("crace"), F.col("abbr").alias("__s"))
    j = jobs.select(F.col("name").alias("cls"), F.col("abbr").alias("__j"))
    both = facts.join(s, "crace", "left").join(j, "cls", "left")
    wrong = (F.lower(F.substring("char", 1, 2)) != F.lower("__s")) | (F.lower(F.substring("char", 3, 2)) != F.lower("__j"))
    return both.where(F.coalesce(wrong, F.lit(False))).withColumn("right", F.coalesce(F.concat("__s", "__j"), F.col("char"))).drop("__s", "__j")


def with_values(dimension: DataFrame, values: DataFrame, case_sensitive: bool = False) -> DataFrame:
    """The dimension with rows for values (value) that it lacks, numbered on."""
    keyed = values.where("value is not null").groupBy(lookup_key(F.col("value"), case_sensitive).alias("key")).agg(F.max("value").alias("value"))
    top = dimension.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    fresh = tables.numbered(tables.new_values(keyed, dimension), after=top)
    return dimension.unionByName(fresh.select("id", "key", "value"))


def fixed_char(facts: DataFrame, chars: DataFrame, species: DataFrame, jobs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """facts (id, char_id, crace, cls) pointed to the right char, and the grown dimension of chars."""
    named = facts.join(chars.select(F.col("id").alias("char_id"), F.col("value").alias("char")), "char_id")
    wrong = mismatched(named, species, jobs).select("id", "right")
    grown = with_values(chars, wrong.select(F.col("right").alias("value")).distinct())
    change = tables.resolved(wrong, grown, "right", "char_id").select("id", "char_id")
    return tables.updated(facts, change, ["id"], ["char_id"]), grown


def fixed_field(facts: DataFrame, dimension: DataFrame, rule: Rule, column: str) -> tuple[DataFrame, DataFrame]:
    """A rule applied again to stored values: on the dimension, not the facts; facts' column is pointed to the new ids."""
    hit = dimension.where(rule.changes(F.col("value"))).withColumn("new", rule.transformed(F.col("value"))).where("new <> value")
    grown = with_values(dimension, hit.select(F.col("new").alias("value")).distinct())
    move = tables.resolved(hit.select(F.col("id").alias(column), "new"), grown, "new", "__to").select(column, "__to")
    out = facts.join(move, column, "left").withColumn(column, F.coalesce("__to", column)).drop("__to")
    return out.select(*facts.columns), grown


def fixed_values(facts: DataFrame, rule: Rule) -> DataFrame:
    """The same for a plain column."""
    c = F.col(rule.target)
    return facts.withColumn(rule.target, F.when(rule.changes(c), rule.transformed(c)).otherwise(c))


def god_of_verb(facts: DataFrame, gods: DataFrame, verbs: DataFrame, verb: str) -> DataFrame:
    """Facts of one verb with the god's name."""
    g = gods.select(F.col("id").alias("god_id"), F.col("value").alias("god"))
    v = verbs.where(F.col("value") == verb).select(F.col("id").alias("verb_id"), F.col("value").alias("verb"))
    return facts.join(v, "verb_id").join(g, "god_id")


def fixed_ecumenical(facts: DataFrame, gods: DataFrame, verbs: DataFrame, nouns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The noun of god.ecumenical is the god."""
    rows = god_of_verb(facts, gods, verbs, "god.ecumenical").select("id", "god")
    grown = with_values(nouns, rows.select(F.col("god").alias("value")).distinct())
    change = tables.resolved(rows, grown, "god", "noun_id").select("id", "noun_id")
    return tables.updated(facts, change, ["id"], ["noun_id"]), grown


def merged_by_game(facts: DataFrame, keys: DataFrame, updates: DataFrame, time: str, value: str = "ntv") -> DataFrame:
    """facts with `value` from updates (game_key, rowtime, value), matched through the dimension of game keys and the row's time."""
    known = tables.resolved(updates, keys, "game_key", "game_key_id", True).where("game_key_id is not null")
    change = known.select("game_key_id", F.col("rowtime").alias(time), value)
    return tables.updated(facts, change, ["game_key_id", time], [value])


def without_files(facts: DataFrame, files: DataFrame, offsets: DataFrame, names: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Facts, file dimension and offsets without what the named files brought; hashes go with the facts, so files can be loaded again."""
    gone: Column = F.col("value").isin(names)
    ids = files.where(gone).select(F.col("id").alias("file_id"))
    return tables.without(facts, ids, "file_id"), files.where(~gone), offsets.where(~F.col("file").isin(names))
