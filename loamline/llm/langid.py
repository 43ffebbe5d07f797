"""Language identification by unigrams over pieces, marginalised over segmentations.

Each language has a probability for every piece of a fixed public vocabulary, fitted by expectation-maximisation on a
bounded sample of labelled texts. A forward algorithm sums the probabilities of all ways to cut a word into pieces; a
text's score is the product over its words. Runs of letters are scored once and remembered by their hash, many at a time by numpy.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import wordhash as wh
from .common import appended, text_slices

#: Labelled texts a language is fitted on, about; the bound of the fit.
SAMPLE_TEXTS = 250
#: Languages that one model holds at most.
MAX_LANGUAGES = 500
ROUNDS, PRIOR, FLOOR = 3, 0.01, 1e-7
#: Letters of the longest words that the fit learns from; all words are scored.
TRAIN_WORD = 32
#: Runs of letters that a worker remembers at most, and the bytes that their scores take at most.
MEMO, MEMO_BYTES = 600_000, 1 << 25
#: Letters after which the sums of the forward algorithm are scaled.
RESCALE = 8
#: Languages whose scores are summed at once.
TOGETHER = 16
#: Bytes of texts that are scored together.
SLICE = 1 << 21
START = "▁"
#: Bytes of runs that can hold letters: those of ASCII, and all of other characters.
LETTERS = np.zeros(256, bool)
LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_NOT_ALPHA = re.compile(r"[\W\d_]+")


def letter_words(run: str) -> list[str]:
    """Words of a run: letters alone, in lower case."""
    run = run.lower()
    if run.isalpha():
        return [run]
    return [w for part in _NOT_ALPHA.split(run) if part for w in ([part] if part.isalpha() else "".join(c if c.isalpha() else " " for c in part).split())]


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def vocabulary(path: str) -> dict[str, int]:
    """Pieces of letters, in lower case, numbered from 1; 0 is every letter outside."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {model.id_to_piece(i).lower() for i in range(model.get_piece_size())}
    kept = sorted(p for p in pieces if p.count(START) == p.startswith(START) and (p == START or p.lstrip(START).isalpha()))
    return {p: k for k, p in enumerate(kept, 1)}


class Pieces:
    """The vocabulary by hashes of its pieces: which pieces end where in many words at once."""

    def __init__(self, vocab: dict[str, int]):
        self.size, self.longest = len(vocab), max(map(len, vocab), default=1)
        many = {p: k for p, k in vocab.items() if len(p) > 1}
        hashes, _ = self._sums(_codes(list(many)), np.cumsum([0, *map(len, many)])) if many else (np.zeros(0, wh.U), None)
        order = np.argsort(hashes)
        self.keys, self.ids = hashes[order], np.array(list(many.values()), np.int32)[order]
        self.likely = np.zeros(1 << 20, bool)
        self.likely[self.keys >> wh.U(44)] = True
        one = {ord(p): k for p, k in vocab.items() if len(p) == 1}
        self.letters, self.letter_ids = np.array(sorted(one), np.uint32), np.array([one[c] for c in sorted(one)], np.int32)

    @staticmethod
    def _sums(codes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of whole words that lie one after another, and the running sums they are made of."""
        up, down = wh.powers(len(codes) + 1)
        sums = np.zeros(len(codes) + 1, wh.U)
        np.cumsum(wh.mix(codes.astype(wh.U) + wh.U(1)) * up[: len(codes)], out=sums[1:])
        return wh.mix((sums[first[1:]] - sums[first[:-1]]) * down[first[:-1]]), sums

    def lattice(self, words: list[str]) -> np.ndarray:
        """For words of equal length: the piece that ends at each place with each length, -1 if none; single letters always have one, 0 if unknown."""
        rows, size = len(words), len(words[0])
        codes = _codes(words)
        _, sums = self._sums(codes, np.array([0, len(codes)]))
        _, down = wh.powers(len(codes) + 1)
        grid = np.full((rows, size, self.longest), -1, np.int32)
        if len(self.letters):
            at = np.minimum(np.searchsorted(self.letters, codes), len(self.letters) - 1)
            grid[:, :, 0] = np.where(self.letters[at] == codes, self.letter_ids[at], 0).reshape(rows, size)
        else:
            grid[:, :, 0] = 0
        begin = np.arange(rows)[:, None] * size
        for n in range(2, min(size, self.longest) + 1):
            start = (begin + np.arange(size - n + 1)[None, :]).ravel()
            h = wh.mix((sums[start + n] - sums[start]) * down[start])
            hit = np.flatnonzero(self.likely[h >> wh.U(44)])
            if len(hit):
                at = np.minimum(np.searchsorted(self.keys, h[hit]), len(self.keys) - 1)
                same = self.keys[at] == h[hit]
                row, end = np.divmod(hit[same], size - n + 1)
                grid[row, end + n - 1, n - 1] = self.ids[at[same]]
        return grid


def _codes(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)


def _by_size(words: list[str]) -> list[np.ndarray]:
    """Places of words of equal length."""
    sizes = np.array([len(w) for w in words], np.int64)
    order = np.argsort(sizes, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(sizes[order])) + 1) if len(words) else []


def forward(words: list[str], vocab: dict[str, int] | Pieces, probs: np.ndarray) -> np.ndarray:
    """Log-probability of each word (rows) in each language (columns of probs, whose last row is 0 for no piece)."""
    pieces = vocab if isinstance(vocab, Pieces) else Pieces(vocab)
    out = np.zeros((len(words), probs.shape[1]))
    table = np.ascontiguousarray(probs.T)
    for all_of in _by_size(words):
        size = len(words[all_of[0]])
        step = max(1, 400_000 // (pieces.longest * max(size, probs.shape[1])))
        for a in range(0, len(all_of), step):
            rows = all_of[a : a + step]
            grid = np.ascontiguousarray(pieces.lattice([words[i] for i in rows]).transpose(1, 2, 0))
            sums: list = [np.ones((len(table), len(rows)))]  # over all ways to cut the first letters, by language and word
            total = np.zeros((len(table), len(rows)))
            for j in range(1, size + 1):
                now = sums[j - 1] * table[:, grid[j - 1, 0]]
                for n in range(2, min(j, pieces.longest) + 1):
                    at = np.flatnonzero(grid[j - 1, n - 1] >= 0)
                    if len(at):
                        now[:, at] += sums[j - n][:, at] * table[:, grid[j - 1, n - 1, at]]
                sums.append(now)
                if j % RESCALE == 0:
                    scale = now.copy()
                    total += np.log(scale)
                    for k in range(max(0, j - pieces.longest), j + 1):
                        sums[k] /= scale
            out[rows] = (total + np.log(sums[size])).T
    return out


def fit(counts: Counter, vocab: dict[str, int]) -> np.ndarray:
    """Piece probabilities of one language, row 0 for letters outside, by expectation-maximisation over word counts."""
    pieces, words = Pieces(vocab), sorted(w for w in counts if len(w) <= TRAIN_WORD)
    sets = [(pieces.lattice(ws), np.array([counts[w] for w in ws], float)) for ws in ([words[i] for i in at] for at in _by_size(words))]
    longest = pieces.longest
    p = np.full(len(vocab) + 2, 1 / (len(vocab) + 1))
    p[-1] = 0
    for _ in range(ROUNDS):
        expected = np.zeros(len(p))
        for grid, n in sets:
            rows, size, _ = grid.shape
            prob = p[grid]
            ahead, back = np.zeros((rows, size + 1)), np.zeros((rows, size + 1))
            ahead[:, 0] = back[:, size] = 1
            for j in range(size):
                k = min(j + 1, longest)
                ahead[:, j + 1] = (prob[:, j, :k] * ahead[:, j::-1][:, :k]).sum(1)
            for j in range(size - 1, -1, -1):
                for k in range(min(j + 1, longest)):
                    back[:, j - k] += prob[:, j, k] * back[:, j + 1]
            scale = n / ahead[:, size]
            for j in range(size):
                k = min(j + 1, longest)
                w = prob[:, j, :k] * ahead[:, j::-1][:, :k] * (back[:, j + 1] * scale)[:, None]
                expected += np.bincount(grid[:, j, :k].ravel() % len(p), w.ravel(), len(p))
        p = (expected + PRIOR) / (expected.sum() + PRIOR * len(p))
        p[0] = max(p[0], FLOOR)
        p[-1] = 0
    return np.maximum(p[:-1], FLOOR)


def held_out() -> Column:
    """Whether crc32 of doc_id, as text, leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


class Scores:
    """Scores and numbers of words of the runs that a worker has seen."""

    def __init__(self, model: Model):
        self.probs, self.pieces = model.probs, Pieces(vocabulary(model.path))
        wide = len(model.languages) + 1
        self.memory = wh.Memory(min(MEMO, MEMO_BYTES // (4 * wide)))
        self.rows, self.used = np.zeros((0, wide), np.float32), 0

    def _learn(self, runs: list[str], hashes: np.ndarray, forget: bool) -> None:
        if forget and self.used + len(runs) > self.memory.most:
            self.rows = self.rows[: self.used][self.memory.shrunk()]
            self.used = len(self.rows)
        found = [letter_words(r) for r in runs]
        of = np.repeat(np.arange(len(runs)), np.array([len(ws) for ws in found], np.int64))
        words: dict[str, int] = {}
        which = np.array([words.setdefault(w, len(words)) for ws in found for w in ws], np.int64)
        each = forward([START + w for w in words], self.pieces, self.probs)[which]
        new = np.zeros((len(runs), self.rows.shape[1]))
        for k in range(each.shape[1]):
            new[:, k] = np.bincount(of, each[:, k], len(runs))
        new[:, -1] = np.bincount(of, minlength=len(runs))
        if self.used + len(new) > len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros((max(len(new), len(self.rows) // 4), new.shape[1]), np.float32)])
        self.rows[self.used : self.used + len(new)] = new
        self.used += len(new)
        self.memory.add(hashes)

    def of_texts(self, b: np.ndarray, o: np.ndarray) -> np.ndarray:
        """Log-probabilities of texts by language, and their numbers of words in the last column."""
        w = wh.words(b, o, LETTERS, True)
        hashes, first, which = np.unique(w.hash, return_index=True, return_inverse=True)
        number = self.memory.find(hashes)
        for forget in (True, False):  # a full memory is numbered anew, and what it forgot of these is learnt again
            new = np.flatnonzero(number < 0)
            if len(new):
                at = first[new]
                self._learn([b[s:e].tobytes().decode() for s, e in zip(w.start[at].tolist(), w.end[at].tolist(), strict=True)], hashes[new], forget)
                number = self.memory.find(hashes)
        row = number[which]
        out = np.zeros((len(o) - 1, self.rows.shape[1]))
        full = np.flatnonzero(np.diff(w.first))
        for k in range(0, out.shape[1], TOGETHER):
            if len(full):
                out[full, k : k + TOGETHER] = np.add.reduceat(self.rows[row, k : k + TOGETHER], w.first[full], axis=0, dtype=np.float64)
        return out


class Model:
    """Languages and piece probabilities, at most MAX_LANGUAGES times the vocabulary's size; broadcast."""

    def __init__(self, languages: list[str], probs: np.ndarray, path: str):
        self.languages, self.path, self.key = languages, path, uuid.uuid4().hex
        self.probs = np.vstack([probs, np.zeros((1, probs.shape[1]))])

    def text_scores(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Log-probabilities of whole texts by language, and their numbers of words."""
        scores = wh.holder(("langid", self.key), lambda: Scores(self))
        found = np.concatenate([np.zeros((0, len(self.languages) + 1)), *(scores.of_texts(b, o) for _, _, b, o in text_slices(column, SLICE))])
        return found[:, :-1], found[:, -1]

    def predict(self, column: pa.Array) -> list[pa.Array]:
        if not self.languages:
            return [pa.array(["und"] * len(column), pa.string()), pa.array([0.0] * len(column), pa.float64())]
        total, n = self.text_scores(column)
        best = total.argmax(1) if len(total) else np.zeros(0, np.int64)
        share = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1) if len(total) else np.zeros(0)
        return [
            pa.array(["und" if not k else self.languages[b] for k, b in zip(n, best, strict=True)], pa.string()),
            pa.array(np.where(n > 0, share, 0.0), pa.float64()),
        ]


def fitted(docs: DataFrame, use: Column | Callable[[], Column] | None = None, path: str | None = None, sample: int = SAMPLE_TEXTS) -> Model:
    """A model from text and lang of the rows that `use` picks: of each language about `sample`, chosen by a hash of doc_id and text."""
    path = path or vocabulary_path()
    rows = docs.where("text is not null and lang is not null")
    rows = rows if use is None else rows.where(use)
    counts = {r[0]: r[1] for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES + 1).collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not counts:
        return Model([], np.zeros((1, 0)), path)
    share = F.element_at(F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(int(min(1.0, sample / n) * (1 << 30))))]), F.col("lang"))
    picked = rows.where(F.expr("pmod(xxhash64(doc_id, text), 1073741824)") < share).select("lang", "text")

    def learn(part: pd.DataFrame) -> pd.DataFrame:
        words = Counter()
        for t in part["text"]:
            words.update(letter_words(t))
        p = fit(Counter({START + w: n for w, n in words.items()}), vocabulary(path))
        return pd.DataFrame({"lang": [part["lang"].iloc[0]], "probs": [p]})

    learnt = sorted(picked.groupBy("lang").applyInPandas(learn, "lang string, probs array<double>").collect())
    if not learnt:
        return Model([], np.zeros((1, 0)), path)
    return Model([r[0] for r in learnt], np.array([r[1] for r in learnt]).T, path)


def predicted(docs: DataFrame, model: Model, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """docs with the language and its posterior of each whole text, however long; `und` and 0 where it is null or has no letter.

    Ties go to the language first by name; texts of one letter are scored like others; with no labelled row every
    language is `und`. Repeated rows and other columns stay as they are, but a column named like one of the two new ones
    is replaced; an empty table stays empty.
    """
    docs = docs.drop(*names)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return appended(docs, f"`{names[0]}` string, `{names[1]}` double", lambda column: shared.value.predict(column), limit=SLICE, keep="langid")
