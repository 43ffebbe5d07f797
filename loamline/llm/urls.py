"""URL rules: a trie over reversed host labels and path segments, with longest-match precedence."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged, tidy

#: Bytes that a trie takes in each Python worker, about, up to which rules are broadcast; more go through joined_verdicts.
TRIE_BYTES = 64 << 20
SCHEMA = "page_id bigint, host string, path string, rule string, verdict string"


def split_url(url: str | None) -> tuple[str, str]:
    """Host, with A-Z in lower case, and path; both empty for null or where `://` is missing."""
    head, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    cut = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    tail = rest[cut:]
    stop = min((i for i in map(tail.find, "?#") if i >= 0), default=len(tail))
    host = rest[:cut]
    return (host.lower() if host.isascii() else "".join(c.lower() if c.isascii() else c for c in host)), tail[:stop]


class Trie:
    """Nodes are dicts by host label from the right; under None, a node's paths by segment, whose rules end with a partial segment."""

    def __init__(self, rules: Iterable[tuple[str, str, str]]):
        self.root: dict = {}
        self.longest = 0  # last, partial segment
        for host, path, verdict in rules:
            node = self.root
            for label in reversed(host.split(".")):
                node = node.setdefault(label, {})
            *whole, last = path.split("/")
            node = node.setdefault(None, ({}, {}))
            for segment in whole:
                node = node[0].setdefault(segment, ({}, {}))
            if node[1].get(last, ("", ""))[1] != "block":  # of two equal rules the blocking one holds
                node[1][last] = (host + path, verdict)
            self.longest = max(self.longest, len(last))

    def _path(self, node: tuple, path: str) -> tuple[str, str] | None:
        """The rule with the longest path that begins `path`."""
        best = None
        segments = path.split("/")
        for k, segment in enumerate(segments):
            for n in range(min(len(segment), self.longest), -1, -1) if node[1] else ():
                if segment[:n] in node[1]:
                    best = node[1][segment[:n]]
                    break
            if segment not in node[0] or k == len(segments) - 1:
                break
            node = node[0][segment]
        return best

    def match(self, host: str, path: str) -> tuple[str, str] | None:
        node, best = self.root, None
        for label in reversed(host.split(".")):
            node = node.get(label)
            if node is None:
                break
            if None in node:
                best = self._path(node[None], path) or best
        return best


def trie_bytes(rules: list[tuple[str, str, str]]) -> int:
    """About what Trie takes: nodes and entries of some 600 bytes a rule, and its text."""
    return sum(600 + 3 * (len(h) + len(p)) for h, p, _ in rules)


def verdicts(pages: DataFrame, rules: list[tuple[str, str, str]], default: str = "allow") -> DataFrame:
    """Host, path, fitting rule and verdict of each row of pages (page_id, url).

    rules: host, path, `allow` or `block`. A rule fits its host and all subdomains where the path begins with the
    rule's; more host labels win, then the longer path; of two equal ones, block. Without a rule the verdict is
    `default`. Null urls have an empty host and path; very long ones are read whole. Repeated rows
    each give a row; other columns are ignored, whatever their names; no pages give no rows. Rules that take more than TRIE_BYTES
    are joined instead.
    """
    if trie_bytes(rules) > TRIE_BYTES:
        return joined_verdicts(pages, pages.sparkSession.createDataFrame(rules, "host string, path string, verdict string"), default)
    trie = pages.sparkSession.sparkContext.broadcast(Trie(rules))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = trie.value.match
        for batch in batches:
            split = [split_url(u) for u in batch.column(1).to_pylist()]
            found = [match(*x) or (None, default) for x in split]
            text = [pa.array(x, pa.string()) for x in ([h for h, _ in split], [p for _, p in split], [r for r, _ in found], [v for _, v in found])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *text], ["page_id", "host", "path", "rule", "verdict"])

    return pages.select(F.col("page_id").cast("long"), "url").mapInArrow(tidy(judge), SCHEMA)


def joined_verdicts(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """As verdicts, for rules (host, path, verdict) of any number: pages meet them by host suffix and whole path segments."""
    page = pages.select(F.col("page_id").cast("long"), "url", F.monotonically_increasing_id().alias("__row"))
    rest = F.expr("case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end")
    page = page.withColumn("__rest", rest)
    page = page.select("page_id", "__row", F.expr(r"translate(regexp_extract(__rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')").alias("host"), F.expr(r"regexp_extract(__rest, '^[^/?#]*([^?#]*)', 1)").alias("path"))
    page = staged(page)
    labels, parts = F.split("host", r"\."), F.split("path", "/")
    r = rules.groupBy(F.col("host").alias("__host"), F.col("path").alias("__path")).agg(F.max("verdict").alias("verdict"))
    r = r.withColumns({"__labels": F.size(F.split("__host", r"\.")), "__parts": F.size(F.split("__path", "/"))})
    r = staged(r.withColumn("__key", F.xxhash64("__host", F.expr("substring_index(__path, '/', __parts - 1)"), "__parts")))
    # only depths that rules have, and a hash for each, not the text
    depths = F.array(*[F.struct(F.lit(a).alias("l"), F.lit(b).alias("p")) for a, b in sorted((x[0], x[1]) for x in r.select("__labels", "__parts").distinct().collect())] or [F.struct(F.lit(0).alias("l"), F.lit(0).alias("p"))])
    keys = page.withColumns({"__labels": labels, "__parts": parts}).withColumn("d", F.explode(depths)).where("d.l <= size(__labels) and d.p <= size(__parts) and d.l > 0")
    suffix, head = F.expr("array_join(slice(__labels, size(__labels) - d.l + 1, d.l), '.')"), F.expr("array_join(slice(__parts, 1, d.p - 1), '/')")
    keys = keys.select("__row", "host", "path", F.xxhash64(suffix, head, F.col("d.p")).alias("__key"))
    best = keys.join(r.drop("__labels", "__parts"), "__key").where("startswith(path, __path) and (host = __host or endswith(host, concat('.', __host)))")
    best = best.groupBy("__row").agg(F.max_by(F.struct(F.concat("__host", "__path").alias("rule"), "verdict"), F.struct(F.size(F.split("__host", r"\.")), F.length("__path"))).alias("best"))
    return page.join(best, "__row", "left").select("page_id", "host", "path", "best.rule", F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
