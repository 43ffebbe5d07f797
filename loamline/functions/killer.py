"""Canonical names of killers, their modifiers and weapons, and nouns of milestones."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from loamline.functions import version
from loamline.functions.text import add_article, first_not_empty, group_or_self, let, norm_space, replace_all, strip_depth


@dataclass(frozen=True)
class Names:
    """Rule tables: who is unique, who is an orc with a name, the generic lord, phrases without an article."""

    uniques: frozenset[str] = frozenset()
    orcs: frozenset[str] = frozenset()
    lord: str = "a pandemonium lord"
    special: tuple[str, ...] = ()
    verbs: dict[str, str] = field(default_factory=dict)


#: Killer patterns, applied in order.
HEADS = [(r"^an? \w+-headed (hydra.*)\z", "a $1"), (r"^the \w+-headed ((?:Lernaean )?hydra.*)\z", "the $1"), (r"^.*'s? ghost\z", "a player ghost"), (r"^.*'s? illusion\z", "a player illusion"), (r"^an? \w+ (draconian.*)", "a $1")]
SHAPES = [(r"^an? .* \(((?:glowing )?shapeshifter)\)\z", "a $1"), (r"^the .* shaped (.*)\z", "the $1"), (r".*\bmiscasting\b.*\z", "miscast"), (r".*\bunwield\b.*", "unwield")]
#: Weapon patterns, applied in order.
WEAPON = [(r"^Hit by (.*) thrown .*\z", "$1"), (r"^Shot with (.*) by .*\z", "$1"), (r"\{.*?\}", ""), (r"\(.*?\)", ""), (r"[+-]\d+,?[\t\n\f\r ]*", ""), ("^an? ", ""), ("(?:elven|orcish|dwarven) ", ""), (r"\b(?:un)?cursed ", "")]
#: Names at the head of a killer, and titles at its end.
PROPER = r"^(\p{Lu}[\p{L}\p{N}']*(?: \p{Lu}[\p{L}\p{N}']+)*)"
TITLE = r" the (.*)\z"


def unique(cv: Column, killer: Column, raw: Column, flags: Column, names: Names) -> Column:
    """Names of uniques without their titles, and the generic lord for names of old versions that nobody else bears."""
    return let(killer, lambda k: let(F.regexp_extract(k, PROPER, 1), lambda proper: _unique(cv, k, proper, raw, flags, names)))


def _unique(cv: Column, killer: Column, proper: Column, raw: Column, flags: Column, names: Names) -> Column:
    title = F.regexp_extract(killer, TITLE, 1)
    known = F.lower(F.coalesce(flags, F.lit(""))).contains("unique") | proper.isin(*names.uniques)
    old = version.number(cv) < version.number(F.lit("0.11"))
    lordly = ~proper.rlike(r"^(?:an?|the) ") & ~known & ~proper.isin(*names.orcs)
    lord = F.when(F.when(old, lordly).otherwise(proper.contains("the pandemonium lord")), F.lit(names.lord)).otherwise(killer)
    titled = F.when(known, proper).otherwise(add_article(title, names.special))
    skip = killer.startswith("a player ") | ~F.coalesce(raw, F.lit("")).rlike(r"^\p{Lu}")
    return F.when(skip, killer).when(killer.rlike(TITLE), titled).otherwise(lord)


def rewritten(killer: Column) -> Column:
    ugly = lambda k: F.when(k.contains("very ugly thing"), F.lit("a very ugly thing")).when(k.contains("ugly thing"), F.lit("an ugly thing")).otherwise(k)
    return replace_all(let(replace_all(killer, HEADS), ugly), SHAPES)


def canonical(cv: Column, killer: Column, raw: Column, flags: Column, names: Names) -> Column:
    return unique(cv, rewritten(killer), raw, flags, names)


#: Patterns of modifiers.
SPECTRAL, UNDEAD = r"spectral (\w+)", r"(?iu)(zombie|skeleton|simulacrum)\z"


def modifier(killer: Column) -> Column:
    is_spectre = killer.rlike(SPECTRAL) & (F.regexp_extract(killer, SPECTRAL, 1) != "warrior")
    return F.when(is_spectre, F.lit("spectre")).when(killer.contains("shapeshifter"), F.lit("shapeshifter")).when(killer.rlike(UNDEAD), F.regexp_extract(killer, UNDEAD, 1)).otherwise(F.lit(""))


def weapon(kaux: Column) -> Column:
    return norm_space(replace_all(kaux, WEAPON))


#: Nouns by verb: pattern and group of the text `milestone`.
NOUNS = {
    "sacrifice": (r"sacrificed (?:an? )?(\w+)", 1), "uniq": (r"(\w+) (.*?)\.?\z", 2), "ghost": (r"(\w+) the ghost of ([^\t\n\f\r ]+)", 2), "ancestor.class": (r".* as a (.+)[.]\z", 1),
    "ancestor.special": (r".*(?:casting|wielding an?) (.+)[.]\z", 1), "rune": (r"found an? (\S+) rune", 1), "gem.found": (r"found an? (\S+) gem", 1), "gem.lost": (r"lost the (\S+) gem", 1),
    "god.mollify": (r"^(?:partially )?mollified (.*)[.]\z", 1), "god.renounce": (r"^abandoned (.*)[.]\z", 1), "god.worship": (r"^became a worshipper of (.*)[.]\z", 1),
    "god.maxpiety": (r"^became the Champion of (.*)[.]\z", 1), "shaft": (r"fell down a shaft to (.*)[.]\z", 1),
}
#: What an action adds to the verb.
SUFFIX = {"banished": ".ban", "pacified": ".pac", "enslaved": ".ens", "slimified": ".slime"}


def milestone_noun(verb: Column, milestone: Column, place: Column, oplace: Column, god: Column) -> Column:
    """By the mapped verb; what a pattern doesn't match stays as it is, an empty noun falls back to the text."""
    start = first_not_empty(milestone, F.lit("?"))
    out = F.when(verb == "abyss.enter", first_not_empty(F.regexp_extract(start, r"\((.*?)\)\z", 1), F.lit("?")))
    for v, (pattern, group) in NOUNS.items():
        out = out.when(verb == v, group_or_self(start, pattern, group))
    out = out.when(verb.isin("br.enter", "br.end", "br.mid"), strip_depth(place)).when(verb == "br.exit", strip_depth(oplace))
    out = out.when(verb == "orb", F.lit("orb")).when(verb == "god.ecumenical", god).when(verb == "monstrous", F.lit("demonspawn"))
    return first_not_empty(out.otherwise(start), start)


def milestone_verb(verb: Column, milestone: Column) -> Column:
    """With the suffix of the action, for uniques and ghosts."""
    word = F.when(verb == "uniq", F.regexp_extract(milestone, NOUNS["uniq"][0], 1)).when(verb == "ghost", F.regexp_extract(milestone, NOUNS["ghost"][0], 1)).otherwise(F.lit(""))
    table = F.create_map(*[F.lit(x) for kv in SUFFIX.items() for x in kv])
    return F.concat(verb, F.coalesce(F.element_at(table, word), F.lit("")))
