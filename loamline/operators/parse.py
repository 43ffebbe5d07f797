"""Lines of `key=value` pairs to records and back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamline.functions.text import BLANKS, let, trim_all, trim_right

#: Fixed value: a key up to `=`, a value up to the first unpaired `:`.
PAIR = r"([^=]*)=([^:]*+(?:::[^:]*+)*+)(?::|\z)"
#: Stands for a doubled colon while a line is cut; lines that hold it go by PAIR.
TWO = "\x01"
#: The same in plain lines, which become JSON by replacing alone: JSON takes this sign as it is.
JSON_TWO = "\x7f"
#: White space beyond ASCII, of which keys are trimmed.
WIDE_BLANKS = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in BLANKS if ord(c) > 127) + "]"
#: Names the text of a line that is no JSON after all; no key of a plain line that is asked for holds a colon.
NOT_JSON = "::"


def potential(line: Column) -> Column:
    """Whether a line can be a record: not blank and not begun by a colon."""
    text = trim_right(F.coalesce(line, F.lit("")))
    return (F.length(text) > 0) & ~text.startswith(":")


def _cut(text: Column, two: str = TWO) -> Column:
    """A trimmed line with TWO for doubled colons and without the colon that ends its last value."""
    text = F.replace(text, F.lit("::"), F.lit(two))
    return F.when(F.endswith(text, F.lit(":")), F.substring(text, F.lit(1), F.length(text) - 1)).otherwise(text)


def malformed(line: Column) -> Column:
    """Whether text is left over that has no `=`."""
    text = trim_all(line)
    return (text != "") & ~F.contains(F.substring_index(_cut(text), ":", -1), F.lit("="))


def line_hash(src: Column, line: Column) -> Column:
    return F.sha2(F.concat(src, F.lit(": "), trim_all(line)), 256)


def fields_of(line: Column) -> Column:
    """A map of the pairs; of a repeated key the last value holds. Lines are cut at colons; only those with a colon in a key go by PAIR."""

    def piece(p: Column) -> Column:
        """A piece at its first `=`."""
        key = F.substring_index(p, "=", 1)
        return F.struct(trim_all(F.replace(key, F.lit(TWO), F.lit("::"))).alias("key"), F.replace(F.substring(p, F.length(key) + 2, F.length(p)), F.lit(TWO), F.lit(":")).alias("value"))

    def by_pattern(text: Column) -> Column:
        keys = F.transform(F.regexp_extract_all(text, F.lit(PAIR), F.lit(1)), trim_all)
        values = F.transform(F.regexp_extract_all(text, F.lit(PAIR), F.lit(2)), lambda v: F.replace(v, F.lit("::"), F.lit(":")))
        return F.arrays_zip(keys.alias("key"), values.alias("value"))

    def latest(entries: Column) -> Column:
        keys = entries["key"]
        last = F.filter(entries, lambda e, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), e["key"]))
        return F.map_from_entries(F.when(F.size(F.array_distinct(keys)) == F.size(keys), entries).otherwise(last))

    def pairs(text: Column) -> Column:
        odd = F.contains(text, F.lit(TWO))
        cut = lambda pieces: F.when(odd | F.exists(pieces, lambda p: ~F.contains(p, F.lit("="))), by_pattern(text)).otherwise(F.transform(pieces, piece))
        return let(F.split(_cut(text), ":", -1), cut)

    return let(let(trim_all(line), pairs), latest)


def parsed(lines: DataFrame, line: str = "line", src: str = "src") -> DataFrame:
    """Adds `fields` and `hash`, which a field of that name overrides; lines must be well-formed."""
    out = lines.withColumn("fields", fields_of(F.col(line)))
    return out.withColumn("hash", F.coalesce(F.col("fields")["hash"], line_hash(F.col(src), F.col(line))))


def record_kind(fields: Column) -> Column:
    return F.when(F.map_contains_key(fields, "type"), F.lit("milestone")).otherwise(F.lit("logrecord"))


def valid(fields: Column) -> Column:
    """Whether the record names a player, a start and an end."""
    there = lambda k: F.coalesce(fields[k], F.lit("")) != ""
    return there("start") & there("name") & (there("end") | there("time"))


def encoded(fields: Column) -> Column:
    """A record as a line: keys in order, colons doubled, hidden keys left out."""
    shown = F.map_filter(fields, lambda k, v: (k != "") & ~k.startswith(":"))
    pairs = F.transform(F.array_sort(F.map_entries(shown)), lambda e: F.concat(e["key"], F.lit("="), F.replace(e["value"], F.lit(":"), F.lit("::"))))
    return F.array_join(pairs, ":")


def marked(lines: DataFrame, line: str = "line", src: str = "src") -> DataFrame:
    """Lines that can be records with `fields`, `hash` and the cause for which they are set aside; a malformed one has no fields."""
    kept = lines.where(potential(F.col(line)))
    out = kept.withColumn("fields", F.when(~malformed(F.col(line)), fields_of(F.col(line))))
    out = out.withColumn("hash", F.coalesce(F.col("fields")["hash"], line_hash(F.col(src), F.col(line))))
    return out.withColumn("cause", F.when(F.col("fields").isNull(), F.lit("malformed")).when(~valid(F.col("fields")), F.lit("invalid")))


def decoded(lines: DataFrame, wanted: list[str], line: str = "line", src: str = "src") -> DataFrame:
    """As marked, with the wanted fields alone, in a struct `__f` in place of the map `fields`; null for a malformed line.

    Lines without signs that JSON escapes become JSON by replacing signs. A piece that has not just one `=`, or a control sign, makes
    them no JSON, which the parser tells; these and others go by fields_of. Of a repeated key the last value holds either way.
    """
    wanted = list(dict.fromkeys([*wanted, "hash", "start", "name", "end", "time"]))
    text, cut, quick = F.col("__t"), F.col("__cut"), F.col("__quick")
    out = lines.where(potential(F.col(line))).withColumn("__t", trim_all(F.col(line)))
    out = out.withColumn("__cut", _cut(text, JSON_TWO))
    odd = reduce(lambda a, b: a | b, [F.contains(text, F.lit(x)) for x in ('"', "\\", JSON_TWO)])
    # keys are trimmed: no space at an end of one
    odd = odd | F.contains(cut, F.lit(" =")) | F.contains(cut, F.lit(": "))
    odd = odd | ((F.octet_length(text) != F.char_length(text)) & text.rlike(WIDE_BLANKS))
    schema = ", ".join(f"`{w}` string" for w in wanted)
    left_over = ~F.contains(F.substring_index(cut, ":", -1), F.lit("="))
    out = out.withColumn("__malformed", left_over)
    if any(":" in w for w in wanted):
        out = out.withColumn("__f", F.when(~F.col("__malformed"), F.from_json(F.to_json(fields_of(F.col(line))), schema)))
    else:
        quoted = F.replace(F.replace(F.replace(cut, F.lit(":"), F.lit('","')), F.lit("="), F.lit('":"')), F.lit(JSON_TWO), F.lit(":"))
        json = F.when(~(F.col("__malformed") | odd), F.concat(F.lit('{"'), quoted, F.lit('"}')))
        out = out.withColumn("__quick", F.from_json(json, f"{schema}, `{NOT_JSON}` string", {"columnNameOfCorruptRecord": NOT_JSON}))
        whole = F.struct(*[quick[w].alias(w) for w in wanted])
        slow = F.from_json(F.to_json(fields_of(F.col(line))), schema)
        out = out.withColumn("__f", F.when(quick.isNotNull() & quick[NOT_JSON].isNull(), whole).when(~F.col("__malformed"), slow)).drop("__quick")
    f = F.col("__f")
    out = out.withColumn("hash", F.coalesce(f["hash"], line_hash(F.col(src), F.col(line))))
    there = lambda k: F.coalesce(f[k], F.lit("")) != ""
    good = there("start") & there("name") & (there("end") | there("time"))
    return out.withColumn("cause", F.when(F.col("__malformed"), F.lit("malformed")).when(~good, F.lit("invalid"))).drop("__t", "__cut", "__malformed")


def malformed_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """Of sorted_out's rejected lines the malformed ones alone, told without decoding any line."""
    return lines.where(potential(F.col(line)) & malformed(F.col(line)))


def sorted_out(lines: DataFrame, line: str = "line", src: str = "src") -> tuple[DataFrame, DataFrame]:
    """Good records, parsed, and rejected lines with their cause; lines that cannot be records are in neither."""
    out = marked(lines, line, src)
    return out.where("cause is null").drop("cause"), out.where("cause is not null").drop("fields", "hash")
