"""Best-fit-decreasing packing of tokenised documents into sequences of a fixed length.

Texts become ids by a public tokenizer and are cut only where longer than a sequence. Full pieces fill a sequence
of their own. The others are dealt at random into groups of bounded size, and each group is packed by
best fit in order of falling length, with a segment tree over the remaining capacities.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import wordhash as wh
from .common import row_slices, staged, tidy

CAPACITY, END_ID = 4096, 1
#: Pieces that one group packs at most, on average: a group leaves at most about one sequence half filled.
GROUP_PIECES = 8192
#: Shuffle parts at most, however many groups there are.
MOST_PARTS = 20_000
#: Runs without white space whose ids a worker remembers at once, about 50 bytes each.
MEMO = 600_000
SPECIAL = ("<|startoftext|>", "<|endoftext|>")
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PACKED = PIECES + ", sequence_id bigint, offset bigint"

#: The splitting pattern of the vocabulary file, its white space spelled out.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\p{L}\p{N}]+"


_SPACE = re.compile(r"[ \t-\r]")


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, one after another."""
    ends = np.cumsum(size)
    return np.repeat(start - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


class Encoder:
    """Ids of whole texts. White space parts the vocabulary's words, so each run without it is encoded once and remembered by
    its hash: its ids lie in one array, so that many texts become ids by a few array operations."""

    def __init__(self, path: str, most: int = MEMO):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.split = self.tokenizer.model, regex.compile(_SPLIT)
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        spare = iter(range(256, 512))
        self.letters = [chr(b) if b in set(plain) else chr(next(spare)) for b in range(256)]
        self.memory = wh.Memory(most)
        self.ids, self.used = np.zeros(0, np.uint32), 0  # ids of remembered runs, and how many there are
        self.start, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _word(self, word: str) -> list[int]:
        mapped = word if word.isascii() and word.isprintable() else "".join(map(self.letters.__getitem__, word.encode()))
        return [t.id for t in self.model.tokenize(mapped)]

    def _learn(self, runs: list[str], hashes: np.ndarray, forget: bool) -> None:
        if forget and len(self.start) + len(runs) > self.memory.most:
            keep = self.memory.shrunk()
            self.ids = self.ids[_ranges(self.start[keep], self.size[keep])]
            self.size = self.size[keep]
            self.start, self.used = np.cumsum(self.size) - self.size, len(self.ids)
        words: dict[str, list[int]] = {}
        flat, sizes = [], []
        for run in runs:
            n = len(flat)
            for word in [run] if run.isalpha() else self.split.findall(run):
                found = words.get(word)
                if found is None:
                    found = words[word] = self._word(word)
                flat += found
            sizes.append(len(flat) - n)
        size = np.array(sizes, np.int64)
        self.start, self.size = np.append(self.start, self.used + np.cumsum(size) - size), np.append(self.size, size)
        if self.used + len(flat) > len(self.ids):
            self.ids = np.append(self.ids, np.zeros(max(len(flat), len(self.ids) // 4), np.uint32))
        self.ids[self.used : self.used + len(flat)] = flat
        self.used += len(flat)
        self.memory.add(hashes)

    def _short(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        raw, o = wh.joined_texts(texts)
        w = wh.words(np.frombuffer(raw, np.uint8), o, wh.SOLID, False)
        hashes, first, which = np.unique(w.hash, return_index=True, return_inverse=True)
        number = self.memory.find(hashes)
        for forget in (True, False):  # a full memory is numbered anew, and what it forgot of these is learnt again
            new = np.flatnonzero(number < 0)
            if len(new):
                at = first[new]
                self._learn([raw[s:e].decode() for s, e in zip(w.start[at].tolist(), w.end[at].tolist(), strict=True)], hashes[new], forget)
                number = self.memory.find(hashes)
        start, size = self.start[number][which], self.size[number][which]
        ends = np.append(0, np.cumsum(size))
        return self.ids[_ranges(start, size)], ends[w.first]

    def encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and where each text's begin, with the end last."""
        plain = []
        for t in texts:
            if not t.isascii():
                t = unicodedata.normalize("NFC", t).replace("Σ", "σ")
            plain.append(t.lower())
        special = [k for k, t in enumerate(texts) if any(s in t for s in SPECIAL)]  # they have ids of their own
        for k in special:
            plain[k] = ""
        cut = [_at_spaces(t) for t in plain]
        segments = [x for c in cut for x in c]
        parts = [self._short(segments[a:z]) for a, z in _runs_of(segments)]
        ids = np.concatenate([np.zeros(0, np.uint32), *(i for i, _ in parts)])
        ends = np.cumsum(np.concatenate([np.zeros(1, np.int64), *(np.diff(f) for _, f in parts)]))
        first = ends[np.cumsum([0, *(len(c) for c in cut)])].astype(np.int64)
        for k in special:
            own = np.array(self.tokenizer.encode(texts[k], add_special_tokens=False).ids, np.uint32)
            ids = np.concatenate([ids[: first[k]], own, ids[first[k] :]])
            first[k + 1 :] += len(own)
        return ids, first

    def __call__(self, text: str) -> bytes:
        return self.encoded([text])[0].astype("<u4").tobytes()


def _at_spaces(text: str, limit: int = 1 << 20) -> list[str]:
    """A very long text in parts of about `limit` characters, cut where white space parts its words anyway."""
    out, at = [], 0
    while len(text) - at > 2 * limit and (m := _SPACE.search(text, at + limit)):
        out.append(text[at : m.start()])
        at = m.start()
    return [*out, text[at:]]


def _runs_of(texts: list[str], limit: int = 1 << 20) -> list[tuple[int, int]]:
    """Runs of texts of about `limit` characters."""
    out, a, held = [], 0, 0
    for k, t in enumerate(texts):
        if held and held + len(t) > limit:
            out.append((a, k))
            a, held = k, 0
        held += len(t)
    return [*out, (a, len(texts))] if texts else []


def _encoder(path: str) -> Encoder:
    return wh.holder(("packing", path), lambda: Encoder(path))


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pieces of every document (doc_id, text), with the ids themselves if asked for. A null or empty text is its end id alone."""
    path = path or vocabulary_path()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = _encoder(path), np.array([END_ID], "<u4")
        for whole in batches:
            for batch in row_slices(whole, whole.column(1)):
                ids, first = encode.encoded([t or "" for t in batch.column(1).to_pylist()])
                ids, bounds = ids.astype("<u4", copy=False), first.tolist()
                rows: list[list] = [[], [], [], [], [], []]
                for doc, lo, hi in zip(batch.column(0).to_pylist(), bounds, bounds[1:], strict=False):
                    for k, at in enumerate(range(lo, hi + 1, capacity)):
                        part = ids[at : min(hi, at + capacity)]
                        last = hi < at + capacity  # the end id belongs here
                        crc = zlib.crc32(end, zlib.crc32(part)) if last else zlib.crc32(part)
                        for r, x in zip(rows, (doc, k, at - lo, len(part) + last, crc, np.append(part, end) if last and with_ids else part), strict=True):
                            r.append(x)
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
                k = 6 if with_ids else 5
                yield pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows[:k], kinds[:k], strict=True)], names[:k])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tidy(cut, "packing"), PIECES + ", ids array<bigint>" * with_ids)


class Bins:
    """Open bins by remaining capacity; a segment tree over the capacities finds the tightest that has room."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _add(self, room: int, by: int) -> None:
        i = room + self.size
        while i:
            self.count[i] += by
            i >>= 1

    def put(self, number: int, room: int) -> None:
        if room:
            self.open[room].append(number)
            self._add(room, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """Removes a bin with the least room of `least` or more: its number and room."""
        i, count = least + self.size, self.count
        if not count[i]:
            while i > 1 and (i & 1 or not count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.size:
                i = 2 * i if count[2 * i] else 2 * i + 1
        room = i - self.size
        self._add(room, -1)
        return self.open[room].pop(), room


def best_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and place for lengths in falling order."""
    bins, used, number, offset = Bins(capacity), 0, [], []
    for n in lengths:
        found = bins.take(n)
        if found is None:
            found, used = (used, capacity), used + 1
        number.append(found[0])
        offset.append(capacity - found[1])
        bins.put(found[0], found[1] - n)
    return number, offset


def pack(parts: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Adds sequence_id and offset to pieces (doc_id, piece, length, ...), which must be stored: they are counted, then dealt.

    Full pieces are sequences of their own, without a shuffle. Others are dealt into groups by the number of their row, so
    repeated rows and null doc_ids are spread like all others. Ties in length are taken by doc_id and piece; repeated
    rows are packed each for itself; no pieces give no rows.
    """
    full, rest = parts.where(F.col("length") >= capacity), parts.where(F.col("length") < capacity)
    groups = max(1, -(-rest.count() // group_pieces))
    names, kinds = parts.columns, parts.dtypes
    alone = full.withColumn("sequence_id", F.lit(1 << 62) + F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
    dealt = rest.withColumn("__group", F.expr(f"pmod(xxhash64(monotonically_increasing_id()), {groups})"))
    # a part packs its groups one after another, each from its longest piece down
    dealt = dealt.repartition(min(groups, MOST_PARTS), "__group").sortWithinPartitions("__group", F.desc("length"), "doc_id", "piece")

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def packed(rows: pa.Table, key: int) -> Iterator[pa.RecordBatch]:
            number, offset = best_fit(rows["length"].to_pylist(), capacity)
            rows = rows.drop_columns(["__group"]).append_column("sequence_id", pa.array([(key << 32) + x for x in number], pa.int64()))
            yield from rows.append_column("offset", pa.array(offset, pa.int64())).to_batches()

        last = None
        for batch in batches:
            keys = np.asarray(batch.column(batch.schema.get_field_index("__group")))
            cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1), len(keys)]
            for a, z in zip(cuts, cuts[1:], strict=False):
                if z > a:
                    if last is not None and keys[a] != last:
                        yield from packed(pa.Table.from_batches(held), last)
                        held = []
                    last = int(keys[a])
                    held.append(batch.slice(a, z - a))
        if held:
            yield from packed(pa.Table.from_batches(held), last)

    schema = ", ".join(f"`{n}` {t}" for n, t in kinds) + ", sequence_id bigint, offset bigint"
    return dealt.mapInArrow(tidy(fill), schema).select(*names, "sequence_id", "offset").unionByName(alone)


def packed_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Every piece of every document with its sequence and place. Tokenised once, into a stored table."""
    return pack(staged(pieces(docs, path, capacity)), capacity)
