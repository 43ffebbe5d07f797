"""Versioned rule books: each version is a file that is never changed, so that what was loaded can be told by the rules it was loaded with."""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark.sql import SparkSession

from loamline.functions.killer import Names
from loamline.operators.normalize import RuleBook
from loamline.operators.rules import Rule
from loamline.sources import sinks


def to_json(book: RuleBook) -> str:
    return json.dumps(asdict(book), default=sorted, ensure_ascii=False, sort_keys=True)


def from_json(text: str) -> RuleBook:
    raw = json.loads(text)
    pairs = lambda rows: [tuple(r) for r in rows]
    raw["games"], raw["places"] = [(g, list(w)) for g, w in raw["games"]], pairs(raw["places"])
    raw["fields"] = [Rule(**(r | {k: pairs(r[k]) for k in ("exact", "regexp", "conditions")})) for r in raw["fields"]]
    kinds = {k: type(v) for k, v in asdict(Names()).items()}
    raw["names"] = Names(**{k: kinds[k](v) for k, v in raw["names"].items()})
    return RuleBook(**raw)


class RuleBooks:
    """Books under a folder. A call gives the newest version and its book, which is the same object while it is the newest."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self._held = spark, root, (0, RuleBook())

    def versions(self) -> list[int]:
        return [int(n.split(".")[0]) for n in sinks.names_in(self.spark, self.root) if n.endswith(".json")]

    def put(self, book: RuleBook) -> int:
        """Adds a version, unless it is that of the newest."""
        version, newest = self()
        if version and to_json(newest) == to_json(book):
            return version
        while not sinks.put_new(self.spark, f"{self.root}/{version + 1:010d}.json", to_json(book)):
            version += 1
        return version + 1

    def of(self, version: int) -> RuleBook:
        return from_json(sinks.text_of(self.spark, f"{self.root}/{version:010d}.json"))

    def __call__(self) -> tuple[int, RuleBook]:
        newest = max(self.versions(), default=0)
        if newest != self._held[0]:
            self._held = newest, self.of(newest)
        return self._held
