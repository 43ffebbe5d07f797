"""Preference formatting: the longest common turn prefix of a chosen and a rejected conversation becomes the prompt.

Native: DataFrame and SQL functions alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: The ChatML marks around a turn.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
#: Parts into which the conversations of one opening are dealt for numbering, for every PART_ROWS turns of each part as many again.
PARTS, PART_ROWS = 64, 1_000_000


def _prefix(a: str, b: str) -> str:
    """SQL for the number of leading turns that two conversations share."""
    return f"case when least(size({a}), size({b})) = 0 then 0 else aggregate(sequence(1, least(size({a}), size({b}))), 0, (k, i) -> case when k = i - 1 and {a}[i - 1] = {b}[i - 1] then i else k end) end"


def rendered(turns: Column) -> Column:
    """Turns (role, text) as ChatML."""
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(OPEN), F.coalesce(t["role"], F.lit("user")), F.lit("\n"), F.coalesce(t["text"], F.lit("")), F.lit(CLOSE + "\n"))), "")


def mask(turns: str) -> str:
    """SQL for `start:end` runs, in code points of the rendered turns, that count for the loss: text and end mark of assistant turns."""
    head, tail = len(OPEN) + 1, len(CLOSE)
    role = "char_length(coalesce(t.role, 'user'))"
    end = f"a.at + {head} + {role} + char_length(coalesce(t.text, '')) + {tail}"
    span = f"concat(cast(a.at + {head} + {role} as string), ':', cast({end} as string))"
    return f"""aggregate({turns}, struct(0 as at, cast(array() as array<string>) as spans),
        (a, t) -> struct({end} + 1 as at, case when t.role = 'assistant' then concat(a.spans, array({span})) else a.spans end as spans), a -> array_join(a.spans, ','))"""


def formatted(pairs: DataFrame) -> DataFrame:
    """Prompt, completions and masks of pairs with `chosen` and `rejected` arrays of (role, text); other columns stay.

    Equal conversations have the whole as prompt and empty completions; an empty or null one makes the prompt empty. A null text
    counts as empty and a null role as `user`; very long texts stay whole; columns named like the new ones are replaced.
    """
    pairs = pairs.drop("n_prompt_turns", "prompt", "chosen_mask", "rejected_mask")
    none = "cast(array() as array<struct<role: string, text: string>>)"
    keep = [c for c in pairs.columns if c not in ("chosen", "rejected")]
    out = pairs.select(*keep, F.expr(f"coalesce(chosen, {none})").alias("__a"), F.expr(f"coalesce(rejected, {none})").alias("__b"))
    out = out.withColumn("n_prompt_turns", F.expr(f"cast({_prefix('__a', '__b')} as bigint)"))
    cut = lambda c: F.expr(f"slice({c}, cast(n_prompt_turns as int) + 1, greatest(0, size({c})))")
    out = out.select(*keep, "n_prompt_turns", F.expr("slice(__a, 1, cast(n_prompt_turns as int))").alias("__p"), cut("__a").alias("__a"), cut("__b").alias("__b"))
    return out.select(*keep, "n_prompt_turns", rendered(F.col("__p")).alias("prompt"), rendered(F.col("__a")).alias("chosen"), F.expr(mask("__a")).alias("chosen_mask"), rendered(F.col("__b")).alias("rejected"), F.expr(mask("__b")).alias("rejected_mask"))


def paired(conversations: DataFrame) -> DataFrame:
    """Pairs from rows (conv_id, turn, role, text), as the data name no preference.

    Conversations with the same first turn are coupled two by two, in the order of conv_id within parts; the one
    with more turns is chosen, then the lower conv_id. One left over is chosen against itself with its last
    assistant turn cut to the first half. Every conversation is in one pair. A null text is empty, a null role `user`; turns go by number,
    role and text, equal rows count once, null turns come first; rows without conv_id are left out; very long texts stay whole; other
    columns are ignored; no rows give no pairs. Numbering uses counts
    by opening and part, so no task holds all conversations of a common opening.
    """
    parts = PARTS * (1 + conversations.count() // (PARTS * PART_ROWS))
    turns = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("user")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    opening = F.min(F.struct("turn", "role", F.xxhash64("text").alias("h"), F.crc32(F.encode("text", "UTF-8")).alias("c")))
    firsts = turns.groupBy("conv_id").agg(opening.alias("o")).select("conv_id", F.xxhash64("o.role", "o.h", "o.c").alias("__opening"), F.expr(f"pmod(conv_id, {parts})").alias("__part"))
    counts = firsts.groupBy("__opening", "__part").agg(F.count(F.lit(1)).alias("__n"))
    within = Window.partitionBy("__opening").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each part
    counts = counts.select("__opening", "__part", F.coalesce(F.sum("__n").over(within), F.lit(0)).alias("__before"), F.sum("__n").over(Window.partitionBy("__opening")).alias("__all"))
    ranked = firsts.withColumn("__row", F.row_number().over(Window.partitionBy("__opening", "__part").orderBy("conv_id"))).join(counts, ["__opening", "__part"])
    ranked = ranked.select("conv_id", "__opening", "__all", (F.col("__before") + F.col("__row") - 1).alias("__rank"))
    ranked = ranked.select("conv_id", "__opening", F.expr("__rank div 2").alias("__pair"), F.expr("__rank % 2 = 0 and __rank = __all - 1").alias("__alone"))
    rows = turns.join(ranked, "conv_id").groupBy("__opening", "__pair").agg(F.array_sort(F.collect_set(F.struct("conv_id", "turn", "role", "text"))).alias("__t"), F.bool_or("__alone").alias("__alone"))
    turn = "named_struct('role', t.role, 'text', t.text)"
    both = rows.select("__alone", F.expr("array_min(__t).conv_id").alias("__x"), F.expr("array_max(__t).conv_id").alias("__y"), "__t")
    both = both.select("__alone", "__x", "__y", F.expr(f"transform(filter(__t, t -> t.conv_id = __x), t -> {turn})").alias("__a"), F.expr(f"transform(filter(__t, t -> t.conv_id = __y), t -> {turn})").alias("__b"))
    swap = "not __alone and size(__b) > size(__a)"
    last = "aggregate(sequence(1, size(__a)), 0, (k, i) -> case when __a[i - 1].role = 'assistant' then i else k end)"
    cut = f"transform(__a, (t, i) -> named_struct('role', t.role, 'text', case when i + 1 = __last then left(t.text, cast(char_length(t.text) div 2 as int)) else t.text end))"
    both = both.withColumn("__last", F.expr(last))
    return both.select(
        F.expr(f"case when {swap} then __y else __x end").alias("chosen_conv"),
        F.expr(f"case when __alone then null when {swap} then __x else __y end").alias("rejected_conv"),
        F.expr(f"case when {swap} then __b else __a end").alias("chosen"),
        F.expr(f"case when __alone then {cut} when {swap} then __a else __b end").alias("rejected"),
    )
