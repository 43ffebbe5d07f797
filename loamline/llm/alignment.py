"""Alignment of two tokenizers: which tokens of a byte-level vocabulary (A) and of a piece vocabulary (B) share bytes of a text.

Both tokenizers take white space as the begin of what follows, so a text's units (white space and the run after it) are encoded once
and remembered by hash. Lockstep merging: documents, long ones in lanes of a few dozen units, are merged at once, by one NumPy
vector of A pointers and one of B pointers. Each step links the tokens that all lanes point at, marks the bytes where both end,
moves on whichever ends first, and drops the lanes that are done.

Counts of linked id pairs over the corpus come from Spark: each chunk of texts gives its different pairs once, they are summed up
and joined back by chunk, and each document is looked up in its chunk's pairs.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import wordhash as wh
from .common import row_slices, staged, tidy

#: Bytes of texts that are aligned together, and that share a table of pairs; units of a lane; units that a worker remembers.
SLICE, CHUNK, LANE, MEMO = 1 << 20, 4 << 20, 32, 300_000
#: White space besides that of ASCII, and ASCII's separators: a text that has it is encoded whole.
ODD = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
SPACE = "▁"
COUNTS = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint"


def paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, one after another."""
    ends = np.cumsum(size)
    return np.repeat(start - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


def _firsts(sizes) -> np.ndarray:
    return np.append(0, np.cumsum(np.asarray(sizes, np.int64)))


class Flat:
    """Lists of ids by number, in one array."""

    def __init__(self):
        self.ids, self.start, self.size = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.used = 0

    def keep(self, numbers: np.ndarray) -> None:
        self.ids, self.size = self.of(numbers), self.size[numbers]
        self.start, self.used = _firsts(self.size)[:-1], len(self.ids)

    def of(self, numbers: np.ndarray) -> np.ndarray:
        return self.ids[_ranges(self.start[numbers], self.size[numbers])]

    def add(self, ids: np.ndarray, size: np.ndarray) -> None:
        """Lists that lie one after another in ids."""
        self.start, self.size = np.append(self.start, self.used + _firsts(size)[:-1]), np.append(self.size, size)
        if self.used + len(ids) > len(self.ids):
            self.ids = np.append(self.ids, np.zeros(max(len(ids), len(self.ids) // 4), np.int32))
        self.ids[self.used : self.used + len(ids)] = ids
        self.used += len(ids)


@dataclass
class Aligned:
    """Tokens of many texts, those of each one together, their links and the tokens with which groups end."""

    a: np.ndarray  # ids
    b: np.ndarray
    first_a: np.ndarray  # of each text, its first token; one more entry at the end
    first_b: np.ndarray
    text: np.ndarray  # the row of each text that has tokens
    link_a: np.ndarray  # tokens by number
    link_b: np.ndarray
    cut_a: np.ndarray  # whether a group ends with the token
    cut_b: np.ndarray

    def links_of(self) -> np.ndarray:
        """Of each link, the number of its text."""
        return np.searchsorted(self.first_a, self.link_a, "right") - 1


def merged(end_a: np.ndarray, end_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All pairs of tokens that share bytes, and which tokens end where one of the other side ends.

    end_a, end_b: where tokens end, in bytes; first_a, first_b: each lane's first token, with the end last. Both sides of a lane
    cover the same bytes, all tokens have some.
    """
    cut_a, cut_b = np.zeros(len(end_a), bool), np.zeros(len(end_b), bool)
    a, b, last = first_a[:-1].copy(), first_b[:-1].copy(), first_a[1:]
    go = a < last
    a, b, last = a[go], b[go], last[go]
    links_a, links_b = [a[:0]], [b[:0]]
    while len(a):
        links_a.append(a)
        links_b.append(b)
        ea, eb = end_a[a], end_b[b]
        both = ea == eb
        cut_a[a[both]] = True
        cut_b[b[both]] = True
        a, b = a + (ea <= eb), b + (eb <= ea)
        if not (go := a < last).all():
            a, b, last = a[go], b[go], last[go]
    return np.concatenate(links_a), np.concatenate(links_b), cut_a, cut_b


class Aligner:
    def __init__(self, path_a: str, path_b: str, most: int = MEMO):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the threads
        import sentencepiece
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.a.encode_special_tokens = True
        byte_of = {c: b for b, c in enumerate(_letters())}
        n = self.a.get_vocab_size()
        self.bytes_a = [bytes(byte_of.get(c, 63) for c in self.a.id_to_token(i) or "") for i in range(n)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.size_a, self.size_b = (np.array([len(x) for x in y], np.int64) for y in (self.bytes_a, self.bytes_b))
        self.space = self.b.piece_to_id(SPACE)
        # white space that stands in a piece: there a piece may go over the begin of a unit
        inner = {c for p in pieces if not p.startswith("<0x") for c in p if c in "\t\n\v\f\r"}
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            inner.add(" ")
        self.unsafe = re.compile("[" + "".join(map(re.escape, sorted(inner))) + "]") if inner else None
        self.digits = np.zeros((max(n, len(pieces)), 11), np.uint8)
        text = [str(i).encode() for i in range(len(self.digits))]
        self.width = np.array([len(t) for t in text], np.int64)
        for i, t in enumerate(text):
            self.digits[i, : len(t)] = np.frombuffer(t, np.uint8)
        self.digits = self.digits[:, : int(self.width.max())]
        self.memory, self.known_a, self.known_b, self.good = wh.Memory(most), Flat(), Flat(), np.zeros(0, bool)

    def _encoded(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]], list[bool]]:
        """Ids of texts that begin with white space, by either tokenizer, and whether both give back the text's bytes."""
        a = [e.ids for e in self.a.encode_batch(texts, add_special_tokens=False)]
        b = self.b.encode([t[1:] if t[0] == " " else t for t in texts], num_threads=1)
        good = []
        for k, t in enumerate(texts):
            if t == " ":
                b[k] = [self.space]
            elif t[0] != " ":  # the space that the tokenizer puts before it isn't there
                b[k] = b[k][1:] if b[k][:1] == [self.space] else []
            raw = t.encode()
            good.append(raw == b"".join(map(self.bytes_a.__getitem__, a[k])) and raw == b"".join(map(self.bytes_b.__getitem__, b[k])))
        return a, b, good

    def _learn(self, units: list[str], hashes: np.ndarray, forget: bool) -> None:
        if forget and len(self.good) + len(units) > self.memory.most:
            keep = self.memory.shrunk()
            self.known_a.keep(keep)
            self.known_b.keep(keep)
            self.good = self.good[keep]
        if not self._learn_joined(units):
            a, b, good = self._encoded(units)
            for known, lists in ((self.known_a, a), (self.known_b, b)):
                known.add(np.fromiter((i for x in lists for i in x), np.int32), np.array([len(x) for x in lists], np.int64))
            self.good = np.append(self.good, good)
        self.memory.add(hashes)

    def _learn_joined(self, units: list[str]) -> bool:
        """All units encoded as one text, which their white space parts again; False, and nothing done, if one doesn't come back."""
        if any(u.isspace() for u in units):
            return False
        text = "".join(units)
        raw, ends = text.encode(), np.cumsum([len(u.encode()) for u in units])
        b = self.b.encode(text[1:] if text[0] == " " else text)
        a = self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids
        b = b if text[0] == " " else b[1:]
        new = []
        for ids, known, size in ((a, self.bytes_a, self.size_a), (b, self.bytes_b, self.size_b)):
            if b"".join(map(known.__getitem__, ids)) != raw:
                return False
            ids = np.array(ids, np.int32)
            to = np.cumsum(size[ids])
            last = np.searchsorted(to, ends)
            if not np.array_equal(to[last], ends):
                return False
            new.append((ids, np.diff(np.append(-1, last))))
        self.known_a.add(*new[0])
        self.known_b.add(*new[1])
        self.good = np.append(self.good, np.ones(len(units), bool))
        return True

    def _by_units(self, raw: bytes, o: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Units of texts that lie at o in raw, by their remembered numbers, and each one's text."""
        w = wh.words(np.frombuffer(raw, np.uint8), o, wh.SOLID, False)
        end = np.unique(np.append(w.end, o[1:]))  # a unit ends with a word, or with its text
        start = np.append(0, end[:-1])
        hashes = wh.hashes_of(np.frombuffer(raw, np.uint8), start, end)
        hashes, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        number = self.memory.find(hashes)
        for forget in (True, False):  # a full memory is numbered anew, and what it forgot of these is learnt again
            new = np.flatnonzero(number < 0)
            if len(new):
                at = first[new]
                self._learn([raw[s:e].decode() for s, e in zip(start[at].tolist(), end[at].tolist(), strict=True)], hashes[new], forget)
                number = self.memory.find(hashes)
        return number[which], np.searchsorted(o, start, "right") - 1

    def align(self, texts: list[str | None]) -> Aligned:
        """The texts' tokens and links. A null or empty text, and one that either tokenizer doesn't give back, has none."""
        odd = [k for k, t in enumerate(texts) if t and (ODD.search(t) or self.unsafe and self.unsafe.search(t))]
        skip = set(odd)
        plain = [k for k, t in enumerate(texts) if t and k not in skip]
        raw, o = wh.joined_texts([" " + texts[k] for k in plain])
        number, of = self._by_units(raw, o) if plain else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        bad = np.unique(of[~self.good[number]])
        odd += [plain[k] for k in bad.tolist()]
        stay = ~np.isin(of, bad)
        number, of = number[stay], of[stay]
        whole = [(k, x, y) for k in odd for x, y, good in [[z[0] for z in self._encoded([" " + texts[k]])]] if good]
        # lanes: runs of units of one text, or a whole text
        fresh = np.append(True, of[1:] != of[:-1])[: len(of)]
        begin = np.flatnonzero(fresh)
        place = np.arange(len(of)) - np.repeat(begin, np.diff(np.append(begin, len(of))))
        unit_a, unit_b = _firsts(self.known_a.size[number]), _firsts(self.known_b.size[number])
        lanes = np.append(np.flatnonzero(place % LANE == 0), len(of))
        more_a, more_b = _firsts([len(x) for _, x, _ in whole]), _firsts([len(y) for _, _, y in whole])
        a = np.concatenate([self.known_a.of(number), *(np.array(x, np.int32) for _, x, _ in whole)])
        b = np.concatenate([self.known_b.of(number), *(np.array(y, np.int32) for _, _, y in whole)])
        lane_a, lane_b = (np.append(u[lanes], u[-1] + m[1:]) for u, m in ((unit_a, more_a), (unit_b, more_b)))
        first_a, first_b = (np.append(u[np.append(begin, len(of))], u[-1] + m[1:]) for u, m in ((unit_a, more_a), (unit_b, more_b)))
        text = np.array([plain[k] for k in of[begin].tolist()] + [k for k, _, _ in whole], np.int64)
        return Aligned(a, b, first_a, first_b, text, *merged(np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b]), lane_a, lane_b))

    def groups_text(self, x: Aligned) -> tuple[bytes, np.ndarray]:
        """The groups of all texts as `a1,a2|b1;a3|b2`, and where each text's begin, with the end last."""
        ends_a, ends_b = np.flatnonzero(x.cut_a) + 1, np.flatnonzero(x.cut_b) + 1
        group_a, group_b = np.repeat(np.arange(len(ends_a)), np.diff(np.append(0, ends_a))), np.repeat(np.arange(len(ends_b)), np.diff(np.append(0, ends_b)))
        at_a = np.arange(len(x.a)) + np.append(0, ends_b)[group_a]
        at_b = np.arange(len(x.b)) + ends_a[group_b]
        n = len(x.a) + len(x.b)
        ids, after = np.zeros(n, np.int32), np.full(n, ord(","), np.uint8)
        ids[at_a], ids[at_b] = x.a, x.b
        after[at_a[x.cut_a]], after[at_b[x.cut_b]] = ord("|"), ord(";")
        first = x.first_a + x.first_b
        width = self.width[ids]
        size = width + 1
        size[first[1:] - 1] -= 1  # nothing after the last token
        wide = np.zeros((n, self.digits.shape[1] + 1), np.uint8)
        wide[:, :-1] = self.digits[ids]
        wide[np.arange(n), width] = after
        return wide[np.arange(wide.shape[1]) < size[:, None]].tobytes(), _firsts(size)[first]


def _letters() -> list[str]:
    """The characters that stand for bytes 0 to 255 in a byte-level vocabulary."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def _aligner(key: tuple[str, str]) -> Aligner:
    return wh.holder(("alignment", key), lambda: Aligner(*key))


def alignments(docs: DataFrame, a: str | None = None, b: str | None = None) -> DataFrame:
    """Every row of docs (doc_id, text) with the alignment itself: a_ids, b_ids, and by group the number of its A and B tokens.

    A null or empty text, or one that a tokenizer doesn't give back byte by byte, has empty lists. Whole texts; repeated rows
    give a row each; other columns are ignored; no rows give none.
    """
    key = tuple(x or y for x, y in zip((a, b), paths(), strict=True))
    lists = pa.list_(pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(key)
        for whole in batches:
            for batch in row_slices(whole, whole.column(1), SLICE):
                x = aligner.align(batch.column(1).to_pylist())
                out: list[list] = [[[] for _ in range(batch.num_rows)] for _ in range(4)]
                for k, row in enumerate(x.text.tolist()):
                    for j, (ids, cut, first) in enumerate(((x.a, x.cut_a, x.first_a), (x.b, x.cut_b, x.first_b))):
                        lo, hi = first[k], first[k + 1]
                        out[j][row], out[2 + j][row] = ids[lo:hi], np.diff(np.append(0, np.flatnonzero(cut[lo:hi]) + 1))
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, lists) for c in out)], ["doc_id", "a_ids", "b_ids", "group_a", "group_b"])

    ints = "array<int>"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tidy(run, "alignment"), f"doc_id bigint, a_ids {ints}, b_ids {ints}, group_a {ints}, group_b {ints}")


PARTS = f"chunk bigint, doc_id bigint, {COUNTS}, groups_sha256 string, at binary, times binary, pair bigint, links bigint"


def _chunk_rows(chunk: int, ids: list, counts: np.ndarray, sha: list[str], text: np.ndarray, pair: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of a chunk: one for each document, which names its pairs by their place among the chunk's, and one for each pair."""
    names = [x.split()[0] for x in PARTS.split(", ")]
    kinds = [pa.int64()] * 6 + [pa.string(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
    pairs, which, links = np.unique(pair, return_inverse=True, return_counts=True)
    used, times = np.unique(text * max(len(pairs), 1) + which, return_counts=True)
    of, at = used // max(len(pairs), 1), (used % max(len(pairs), 1)).astype("<u4")
    first = np.searchsorted(of, np.arange(len(ids) + 1)).tolist()
    step = np.diff(at, prepend=np.zeros(1, "<u4"))  # small numbers, that pack well
    begins = np.flatnonzero(np.append(True, of[1:] != of[:-1])[: len(of)])
    step[begins] = at[begins]
    step, times = step.astype("<u4"), times.astype("<u4")
    rows = [pa.array(np.full(len(ids), chunk)), pa.array(ids, pa.int64()), *(pa.array(c) for c in counts), pa.array(sha, pa.string())]
    rows += [pa.array([x[i:j].tobytes() for i, j in zip(first, first[1:], strict=False)], pa.binary()) for x in (step, times)]
    yield pa.RecordBatch.from_arrays([*rows, *(pa.nulls(len(ids), pa.int64()) for _ in range(2))], names)
    none = [pa.nulls(len(pairs), k) for k in kinds[1:9]]
    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pairs), chunk)), *none, pa.array(pairs), pa.array(links)], names)


def parts(docs: DataFrame, key: tuple[str, str], chunk_bytes: int = CHUNK) -> DataFrame:
    """Aligned documents and, by chunk of about chunk_bytes of texts, their different pairs with the number of links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, chunk, held = _aligner(key), TaskContext.get().partitionId() << 32, 0
        ids, counts, sha, text, pair = [], [], [], [], []

        def closed() -> Iterator[pa.RecordBatch]:
            yield from _chunk_rows(chunk, ids, np.concatenate(counts, axis=1), sha, np.concatenate(text), np.concatenate(pair))

        for whole in batches:
            for batch in row_slices(whole, whole.column(1), SLICE):
                texts = batch.column(1).to_pylist()
                x = aligner.align(texts)
                n, link_of = len(texts), x.links_of()
                new = np.zeros((4, n), np.int64)
                new[0, x.text], new[1, x.text] = np.diff(x.first_a), np.diff(x.first_b)
                new[2, x.text] = wh.per_text(x.cut_a, x.first_a)
                new[3, x.text] = np.bincount(link_of, minlength=len(x.text))
                named = [""] * n
                raw, first = aligner.groups_text(x)
                for row, i, j in zip(x.text.tolist(), first.tolist(), first[1:].tolist(), strict=False):
                    named[row] = hashlib.sha256(raw[i:j]).hexdigest()
                text.append(x.text[link_of] + len(ids))
                pair.append((x.a[x.link_a].astype(np.int64) << 32) | x.b[x.link_b])
                ids += batch.column(0).to_pylist()
                sha += named
                counts.append(new)
                held += len(raw)
                if held > 4 * chunk_bytes:  # about four bytes of ids and signs a byte of text
                    yield from closed()
                    ids, counts, sha, text, pair = [], [], [], [], []
                    chunk, held = chunk + 1, 0
        if ids:
            yield from closed()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tidy(run, "alignment"), PARTS)


def pair_counts(pairs: DataFrame) -> DataFrame:
    """(pair, total, best): links of each pair over the corpus, and whether no other pair of its B id has more.

    pairs: (pair, links). A B id has at most one row for each A id, so even that of a bare space is a few tens of thousands.
    """
    counts = staged(pairs.groupBy("pair").agg(F.sum("links").alias("total")))
    b = F.expr("pair & 4294967295")
    tops = counts.groupBy(b.alias("__b")).agg(F.max("total").alias("__top"))
    return counts.join(tops, b == F.col("__b")).select("pair", "total", (F.col("total") == F.col("__top")).alias("best"))


def aligned(docs: DataFrame, a: str | None = None, b: str | None = None, chunk_bytes: int = CHUNK) -> DataFrame:
    """Counts of the alignment of each row of docs (doc_id, text), with how often its links hold over all documents.

    n_best: links whose pair is the commonest of its B id, ties included; count_sum: the pairs' counts, over all links;
    groups_sha256: of the groups' ids. A null or empty text, or one that a tokenizer doesn't give back, has zeros and an empty
    digest. Whole texts; ties, null doc_ids and repeated rows give a row each and count each time; other columns are ignored;
    no rows give none.
    """
    key = tuple(x or y for x, y in zip((a, b), paths(), strict=True))
    both = staged(parts(docs, key, chunk_bytes))
    rows, pairs = both.where("pair is null").drop("pair", "links"), both.where("pair is not null").select("chunk", "pair", "links")
    found = pairs.select(F.col("chunk").alias("of"), "pair").join(pair_counts(pairs.select("pair", "links")), "pair").select("of", "pair", "total", "best")
    names = [c for c in rows.columns if c not in ("chunk", "at", "times")]

    def summed(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(np.asarray(right["pair"]))
        total, best = np.asarray(right["total"])[order], np.asarray(right["best"])[order]
        raw_at, raw_times = (b"".join(x or b"" for x in left[c].to_pylist()) for c in ("at", "times"))
        size = np.array([len(x or b"") // 4 for x in left["at"].to_pylist()], np.int64)
        first = _firsts(size)
        step, times = np.frombuffer(raw_at, "<u4").astype(np.int64), np.frombuffer(raw_times, "<u4").astype(np.int64)
        at = np.cumsum(step)
        at -= np.repeat(np.append(0, at)[first[:-1]], size)
        out = left.select(names).append_column("n_best", pa.array(wh.per_text(times * best[at], first)))
        return out.append_column("count_sum", pa.array(wh.per_text(times * total[at], first)))

    schema = f"doc_id bigint, {COUNTS}, groups_sha256 string, n_best bigint, count_sum bigint"
    return rows.groupBy("chunk").cogroup(found.groupBy("of")).applyInArrow(summed, schema)
