"""Benchmark decontamination by winnowing (Schleimer, Wilkerson and Aiken, 2003).

Of each run of 13 words the least hash of its 7-word grams is a fingerprint, so two texts that share 13 words
share a fingerprint. Fingerprints of training texts are joined with those of the benchmark; in texts with a hit,
every 13-word window is compared by two hashes, which extends hits to the whole shared span and removes chance ones.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import wordhash as wh
from .common import appended, staged, text_slices, tidy

SPAN, GRAM = 13, 7
#: Words of benchmark items that one broadcast holds; more items are taken in blocks of so many, each read against all texts.
BROADCAST_WORDS = 4_000_000
_PARTS = "doc_id bigint, row_key bigint, n_words bigint, spans array<bigint>, items array<bigint>"


def _least(g: np.ndarray, width: int) -> np.ndarray:
    out = g[: len(g) - width + 1].copy()
    for j in range(1, width):
        np.minimum(out, g[j : len(g) - width + 1 + j], out=out)
    return out


def _fingerprints(w: wh.Words) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of each text and the number of the word where their window begins."""
    g, _ = wh.grams(w, GRAM)
    if len(g) < SPAN:
        return np.zeros(0, wh.U), np.zeros(0, np.int64)
    least = _least(g[: len(g) - GRAM + 1], SPAN - GRAM + 1)
    at = np.flatnonzero((np.arange(len(g)) + SPAN <= np.repeat(w.first[1:], np.diff(w.first)))[: len(least)])
    if not len(at):
        return np.zeros(0, wh.U), at
    new = np.ones(len(at), bool)
    new[1:] = (least[at[1:]] != least[at[:-1]]) | (at[1:] != at[:-1] + 1)
    return least[at[new]], at[new]


class _Index:
    """The windows of a bounded block of items: sorted hashes by window length, with the items that hold each."""

    def __init__(self, items: list[tuple[int | None, str]]):
        self.ids = [i for i, _ in items]
        column = pa.array([t for _, t in items], pa.large_string())
        found: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        prints = [np.zeros(0, wh.U)]
        for lo, hi, b, o in text_slices(column):
            w = wh.words(b, o, wh.ALNUM, True)
            n = np.diff(w.first)
            prints.append(_fingerprints(w)[0])
            for k in {SPAN} | {int(x) for x in n if 0 < x < SPAN}:
                g, whole = wh.grams(w, k)
                at = np.flatnonzero(whole & ((w.text >= 0) if k == SPAN else (n[w.text] == k)))
                found.setdefault(k, []).append((g[at], lo + w.text[at], wh.second_hashes(w, at, k)))
        self.prints = np.unique(np.concatenate(prints))
        self.windows = {}
        for k, parts in found.items():
            h, i, second = (np.concatenate([p[x] for p in parts]) for x in range(3))
            order = np.lexsort((i, h))
            keys, begin = np.unique(h[order], return_index=True)
            if len(keys):
                self.windows[k] = keys, np.append(begin, len(h)), i[order], second[order][begin]

    @staticmethod
    def _in(values: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """For each value its place in keys, or -1."""
        if not len(keys):
            return np.full(len(values), -1)
        low = np.zeros(1 << 16, bool)
        low[(keys & wh.U(0xFFFF)).astype(np.int64)] = True
        out = np.full(len(values), -1, np.int64)
        likely = np.flatnonzero(low[(values & wh.U(0xFFFF)).astype(np.int64)])
        at = np.minimum(np.searchsorted(keys, values[likely]), len(keys) - 1)
        same = keys[at] == values[likely]
        out[likely[same]] = at[same]
        return out

    def hits(self, w: wh.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which words are hit; pairs of text and item number, each once."""
        n, doc = len(w.hash), w.text
        hit, pairs = np.zeros(n, bool), []
        for k, (keys, begin, items, second) in self.windows.items():
            sub, base = w, np.arange(n)
            if k == SPAN:  # the join of fingerprints, before any window is compared
                prints, at = _fingerprints(w)
                docs = np.unique(doc[at[self._in(prints, self.prints) >= 0]])
                if not len(docs):
                    continue
                size = np.diff(w.first)[docs]
                base = np.concatenate([np.arange(w.first[d], w.first[d + 1]) for d in docs])
                sub = wh.Words(w.start[base], w.end[base], w.hash[base], np.append(0, np.cumsum(size)))
            g, whole = wh.grams(sub, k)
            places = np.flatnonzero(whole)
            found = self._in(g[places], keys)
            places, found = places[found >= 0], found[found >= 0]
            same = wh.second_hashes(sub, places, k) == second[found]
            places, found = places[same], found[same]
            if len(places):
                hit[base[wh.covered(places, k, len(g))]] = True
                once = np.unique(np.stack([doc[base[places]], found]), axis=1)
                of = begin[once[1] + 1] - begin[once[1]]
                each = np.repeat(begin[once[1]], of) + np.arange(of.sum()) - np.repeat(np.cumsum(of) - of, of)
                pairs.append(np.stack([np.repeat(once[0], of), items[each]]))
        both = np.unique(np.concatenate(pairs, axis=1), axis=1) if pairs else np.zeros((2, 0), np.int64)
        return hit, both[0], both[1]


def _digest(ids) -> str:
    return hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest()


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int | None, str]]]:
    """Items in blocks of at most BROADCAST_WORDS bytes of six a word; one block after another is in the driver."""
    block, size = [], 0
    rows = benchmark.where("text is not null").select(F.col("item_id").cast("long"), "text")
    for r in rows.toLocalIterator():
        block.append((r[0], r[1]))
        size += len(r[1])
        if size >= 6 * BROADCAST_WORDS:
            yield block
            block, size = [], 0
    yield block


def _items(index: _Index, of: np.ndarray, item: np.ndarray, d: int) -> set[int]:
    """Ids of the items in the d-th text; of holds sorted numbers of texts. An item without id counts its words, but not itself."""
    begin, end = np.searchsorted(of, [d, d + 1])
    return {index.ids[x] for x in item[begin:end].tolist()} - {None}


_FOUND = "n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean"


def _judged(docs: DataFrame, index) -> DataFrame:
    """docs with the verdicts of one block of items."""

    def make(column: pa.Array) -> list[pa.Array]:
        idx, none, parts = index.value, _digest([]), []
        for lo, hi, b, o in text_slices(column):
            w = wh.words(b, o, wh.ALNUM, True)
            hit, of, item = idx.hits(w)
            n, n_hit = np.diff(w.first), wh.per_text(hit, w.first)
            n_items, sums = np.zeros(hi - lo, np.int64), [none] * (hi - lo)
            for d in np.unique(of):
                ids = _items(idx, of, item, d)
                n_items[d], sums[d] = len(ids), _digest(ids)
            parts.append([pa.array(n), pa.array(n_hit), pa.array(n_items), pa.array(sums, pa.string()), pa.array((n_hit > 0) & (20 * n_hit >= n))])
        return [pa.concat_arrays(x) for x in zip(*parts, strict=True)]

    return appended(docs, _FOUND, make)


def _by_blocks(keyed: DataFrame, blocks: Iterator[list]) -> DataFrame:
    """Verdicts by row_key of a stored table (doc_id, text, row_key), one block of items after another."""
    out = None
    for block in blocks:
        shared = keyed.sparkSession.sparkContext.broadcast(_Index(block))
        part = staged(_scan_block(keyed, shared))
        shared.destroy()  # the next block takes its place
        out = part if out is None else out.unionByName(part)

    @F.pandas_udf("long")
    def length(spans: pd.Series) -> pd.Series:
        return spans.map(_union_length)

    @F.pandas_udf("string")
    def digest(items: pd.Series) -> pd.Series:
        return items.map(_digest)

    merged = out.groupBy("row_key").agg(F.first("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
    merged = merged.select("row_key", "doc_id", "n_words", length("spans").alias("n_hit"), F.size("items").cast("long").alias("n_items"), digest("items").alias("items_sha256"))
    return merged.withColumn("contaminated", F.expr("n_hit > 0 and 20 * n_hit >= n_words"))


def _split(benchmark: DataFrame) -> tuple[list, Iterator[list] | None]:
    """The only block, or all blocks where there are several."""
    blocks = _blocks(benchmark)
    first, second = next(blocks), next(blocks, None)
    return first, None if second is None else itertools.chain([first, second], blocks)


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per row of docs (doc_id, text): its words, hit words, items and verdict.

    A text that is null, empty or without words has no words, hits or items; a very long one is taken whole. Repeated items
    count by item_id; an item without item_id hits words, but isn't counted or named; one without text does nothing.
    Repeated or tied documents each give their own row; an empty benchmark gives no hits, empty docs no rows. Other
    columns of either table are ignored. The benchmark is broadcast in blocks of bounded size.
    """
    column = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    first, blocks = _split(benchmark)
    if blocks is None:
        return _judged(column, docs.sparkSession.sparkContext.broadcast(_Index(first))).drop("text")
    keyed = staged(column.withColumn("row_key", F.monotonically_increasing_id()))  # the same key for each block
    return _by_blocks(keyed, blocks).drop("row_key")


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that aren't contaminated, as they are, each judged for itself. Other cases are as in contamination."""
    first, blocks = _split(benchmark)
    names = {c: f"__{k}" for k, c in enumerate(docs.columns) if c != "text"}
    back = [F.col(names.get(c, c)).alias(c) for c in docs.columns]
    rows = docs.withColumnsRenamed(names)
    if blocks is None:
        return _judged(rows, docs.sparkSession.sparkContext.broadcast(_Index(first))).where("not contaminated").select(*back)
    rows = staged(rows.withColumn("row_key", F.monotonically_increasing_id()))
    bad = _by_blocks(rows.select(F.lit(None).cast("long").alias("doc_id"), "text", "row_key"), blocks).where("contaminated")
    return rows.join(bad.select("row_key"), "row_key", "left_anti").select(*back)


def _union_length(flat) -> int:
    total, reach = 0, -1
    for s, e in sorted(zip(flat[::2], flat[1::2], strict=True)):
        total += max(0, e - max(s, reach))
        reach = max(reach, e)
    return int(total)


def _scan_block(keyed: DataFrame, index) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, b, o in text_slices(batch.column(1)):
                w = wh.words(b, o, wh.ALNUM, True)
                hit, of, item = index.value.hits(w)
                spans, items = [], []
                for d in range(hi - lo):
                    h = np.concatenate([[0], hit[w.first[d] : w.first[d + 1]].view(np.int8), [0]])
                    spans.append(np.stack([np.flatnonzero(np.diff(h) == 1), np.flatnonzero(np.diff(h) == -1)], 1).ravel().tolist())
                    items.append(sorted(_items(index.value, of, item, d)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo), pa.array(np.diff(w.first)), pa.array(spans, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.int64()))],
                    ["doc_id", "row_key", "n_words", "spans", "items"],
                )

    return keyed.select("doc_id", "text", "row_key").mapInArrow(tidy(scan), _PARTS)
