"""Field rules and declared fields: what users add without code. Both compile to Columns."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamline.functions.text import lookup_key, norm_bool, norm_value


def matches(conditions: list[tuple[str, str]], value_of=F.col) -> Column:
    """Whether every field has its value; an absent one is empty; no condition holds always."""
    tests = [F.coalesce(value_of(name), F.lit("")) == value for name, value in conditions]
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def exact(c: Column, pairs: list[tuple[str, str]]) -> Column:
    """Whole values, one after another: a to b to c."""
    return reduce(lambda x, p: F.when(x == p[0], F.lit(p[1])).otherwise(x), pairs, c)


def regexp(c: Column, pairs: list[tuple[str, str]]) -> Column:
    """All matches, one pattern after another."""
    return reduce(lambda x, p: F.regexp_replace(x, p[0], p[1]), pairs, c)


def chain(c: Column, steps: list, stop: Column | None = None) -> Column:
    """Steps one after another; where `stop` holds the value is done."""
    out = reduce(lambda x, step: step(x), steps, c)
    return out if stop is None else F.when(stop, c).otherwise(out)


@dataclass(frozen=True)
class Rule:
    target: str
    source: str = ""
    exact: list[tuple[str, str]] = field(default_factory=list)
    regexp: list[tuple[str, str]] = field(default_factory=list)
    conditions: list[tuple[str, str]] = field(default_factory=list)

    def __post_init__(self):
        if not self.exact and not self.regexp:
            raise ValueError(f"the rule of {self.target} changes nothing")

    def transformed(self, c: Column) -> Column:
        return regexp(exact(F.coalesce(c, F.lit("")), self.exact), self.regexp)

    def changes(self, c: Column) -> Column:
        """Whether a stored value is one that the rule would rewrite."""
        tests = [c == b for b, _ in self.exact] + [c.rlike(p) for p, _ in self.regexp]
        return reduce(lambda a, b: a | b, tests)


def names(rules: list[Rule]) -> set[str]:
    """All fields that rules read or write."""
    return {n for r in rules for n in (r.target, r.source or r.target, *(c for c, _ in r.conditions))}


def rule_steps(rules: list[Rule]) -> list[dict[str, Column]]:
    """The rules in order as columns to put in place, for rows that have all of names(rules)."""
    return [{r.target: F.when(matches(r.conditions), r.transformed(F.col(r.source or r.target))).otherwise(F.col(r.target))} for r in rules]


def applied(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Each rule in order, so that it sees what earlier ones made. Missing targets are added."""
    for r in rules:
        source = r.source or r.target
        old = F.col(r.target) if r.target in df.columns else F.lit(None).cast("string")
        new = r.transformed(F.col(source) if source in df.columns else F.lit(""))
        df = df.withColumn(r.target, F.when(matches(r.conditions), new).otherwise(old))
    return df


#: Fixed value: a declared field's name, type code, marks and whether it is unique.
SPEC = re.compile(r"^([a-z_]+)([A-Z]*)([^\w]*?)((?:\[uuid\])?)$")
#: Names that differ in tables, and types by code.
NAMES = {"offset": "file_offset", "name": "pname"}
TYPES = {"PK": "bigint", "IB": "bigint", "I": "int", "REF": "bigint", "S": "string", "": "string", "TEXT": "string", "MAP": "string", "D": "timestamp_ntz"}


@dataclass(frozen=True)
class Declared:
    """A declared field: `nameS?^` is text that counts case, indexed, in a dimension."""

    name: str
    code: str
    sigils: str

    @classmethod
    def of(cls, spec: str) -> Declared:
        m = SPEC.match(spec)
        if not m:
            raise ValueError(f"not a field: {spec}")
        return cls(m[1], m[2], m[3])

    @property
    def column(self) -> str:
        return NAMES.get(self.name, self.name)

    @property
    def boolean(self) -> bool:
        return "!" in self.sigils

    @property
    def dimension(self) -> bool:
        return "^" in self.sigils

    @property
    def primary(self) -> bool:
        return "%" in self.sigils

    @property
    def case_sensitive(self) -> bool:
        return self.code == "S"

    def typed(self, c: Column) -> Column:
        """As stored: spaces for underscores, the type's default for an empty text."""
        c = F.nullif(norm_value(c), F.lit(""))
        kind = TYPES[self.code]
        if self.boolean:
            return norm_bool(F.coalesce(c, F.lit("")))
        if kind in ("bigint", "int"):
            return F.coalesce(c.try_cast(kind), F.lit(0).cast(kind))
        return F.coalesce(c, F.lit("")) if kind == "string" else c.try_cast(kind)

    def key(self, c: Column) -> Column:
        return lookup_key(c, self.case_sensitive)


def declared(specs: list[str]) -> list[Declared]:
    return [Declared.of(s) for s in specs]


def typed_select(df: DataFrame, fields: list[Declared], extra: tuple[str, ...] = ()) -> DataFrame:
    """The declared columns and `extra`; keys that aren't declared are dropped, declared ones that are missing get defaults."""
    have, kinds = set(df.columns), dict(df.dtypes)
    columns = [f.typed((F.when(F.col(f.name), F.lit("t")).otherwise(F.lit("")) if kinds[f.name] == "boolean" else F.col(f.name).cast("string")) if f.name in have else F.lit(None).cast("string")).alias(f.column) for f in fields if not f.primary]
    return df.select(*extra, *columns)
