"""Secret scans: fixed patterns, and a linear-chain conditional random field over tokens decoded by Viterbi.

Tokens are runs of letters and digits and single other characters. No secret goes over white space, so each chunk (a
run without white space) is decoded on its own, in the light of two words before it and of traits of its text. A chunk is
passed over without being decoded only where a bound shows that all of it is outside. Features are hashes worked out by
numpy for many tokens at once; what a chunk alone decides is remembered by the chunk's hash.
"""

from __future__ import annotations

import hashlib
import random
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import wordhash as wh
from .common import appended, staged, tidy

#: The base patterns.
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KEYWORDS = ("passw", "secret", "token", "apikey", "api_key")
LONG_HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "crf")

OUT, BEGIN, INSIDE = 0, 1, 2
DIGIT = re.compile(r"[0-9]")
CHUNK = re.compile(r"[^ \t-\r]+")
#: Weights of hashed features; documents from which background chunks for the fit are taken, and chunks at most: with a digit, without, and long ones without.
SLOTS, SAMPLE_DOCS, SAMPLE_CHUNKS, SAMPLE_WORDS, SAMPLE_LONG = 1 << 14, 2000, 1500, 3000, 1500
#: Characters and tokens of a chunk that the fit learns from at most; all are decoded.
FIT_CHARS, FIT_TOKENS = 400, 60
EPOCHS, RATE, L2, SEED = 60, 0.3, 1e-4, 5
#: Tokens and kinds of tokens of chunks whose bounds are worked out, and chunks that a worker remembers at most.
FEW_TOKENS, FEW_KINDS, REMEMBERED = 10, 4, 300_000
#: Bytes of texts that are scanned together.
SLICE = 1 << 20


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """start, kind, end, and where the secret itself begins, by start and kind."""
    out = []
    if ":" in text or "=" in text:
        low = text.lower()
        if any(k in low for k in KEYWORDS):
            out += [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(m.start(), 2, m.end(), m.start()) for m in LONG_HEX.finditer(text)]  # a whole run of 16 or more
    return sorted(out)


def _flags(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


_LOWER, _UPPER, _DIGITS, _HEX = (_flags(x) for x in ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "0123456789abcdef"))
_ALNUM, _STRIP = _LOWER | _UPPER | _DIGITS, _flags("\"'`:=,;()[]{}<>.!?")
_C = wh.seeded(4, 61)
#: Numbers of feature kinds; the first ten are those of _own_slots.
PREVIOUS, SECOND, LENGTH, SIGNS = 11, 12, 13, 14


def _slots(kind: int, *parts: np.ndarray) -> np.ndarray:
    total = np.array([kind], wh.U) * _C[3:]
    for c, x in zip(_C, parts, strict=False):
        total = total + np.asarray(x).astype(wh.U) * c
    return (wh.mix(total) & wh.U(SLOTS - 1)).astype(np.int32)


def _bits(x: np.ndarray, most: int) -> np.ndarray:
    return np.minimum(most, np.frexp(np.asarray(x, float))[1]).astype(np.int64)


@dataclass
class Tokens:
    """Tokens of chunks that lie one after another."""

    chunk: np.ndarray
    start: np.ndarray  # bytes, from the chunk's first
    end: np.ndarray
    first: np.ndarray  # of each chunk, the number of its first token; one more entry at the end
    coarse: np.ndarray  # a rough shape, below 256
    norm: np.ndarray  # of each chunk, its hash as a word before another
    slots: np.ndarray  # features that the chunk alone decides
    used: np.ndarray  # whether the token has them


def _segments(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.add.reduceat(x.astype(np.int64), at) if len(at) else np.zeros(0, np.int64)


def tokens_of(b: np.ndarray, start: np.ndarray, end: np.ndarray) -> Tokens:
    """Tokens of the chunks b[start:end), none of them empty, with their features: shape, neighbours, variety, letters."""
    size = end - start
    co = np.append(0, np.cumsum(size))
    cb = b[np.repeat(start - co[:-1], size) + np.arange(co[-1])]
    later, inside = (cb & 0xC0) == 0x80, _ALNUM[cb]
    joined = np.zeros(len(cb), bool)
    joined[1:] = inside[1:] & inside[:-1]
    joined[co[:-1]] = False
    at = np.flatnonzero(~later & ~joined)
    to = np.append(at[1:], len(cb))[: len(at)]
    first = np.searchsorted(at, co)
    n_tokens = np.diff(first)
    chunk = np.repeat(np.arange(len(size)), n_tokens)
    low, up, dig, hexa = (_segments(f[cb], at) for f in (_LOWER, _UPPER, _DIGITS, _HEX))
    length, alnum, char = to - at, inside[at], np.minimum(cb[at], 128).astype(np.int64)
    alpha = alnum & (dig == 0)
    flags = (low > 0) + 2 * (up > 0) + 4 * (dig > 0) + 8 * ((dig > 0) & (up == 0) & (hexa == length))
    bits = _bits(length, 8)
    shape = np.where(alnum, flags * 16 + bits, 256 + char)
    coarse = np.where(alnum, flags * 4 + np.clip(bits - 2, 0, 3), 64 + char)
    variety, long = np.zeros(len(at), np.int64), np.flatnonzero(alnum & (length > 7))
    if len(long):
        n = length[long]
        each = cb[np.repeat(at[long] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        pairs = np.unique(np.repeat(np.arange(len(long)), n) * 256 + each)
        variety[long] = 10 * np.bincount(pairs >> 8, minlength=len(long)) // n
    turn = np.zeros(len(cb), bool)
    turn[1:] = (_DIGITS[cb[1:]] != _DIGITS[cb[:-1]]) & joined[1:]
    switches = np.where(alnum & ~alpha & (length > 3), np.minimum(6, _segments(turn, at)), 0)
    word = wh.span_hashes(cb, at, to, True)
    place = np.arange(len(at)) - first[chunk]

    def shifted(x: np.ndarray, by: int, none: int) -> np.ndarray:
        out = np.full(len(x), none, x.dtype)
        if by > 0:
            out[by:] = np.where(place[by:] >= by, x[:-by], none)
        elif len(x) > 1:
            out[:-1] = np.where(place[1:] > 0, x[1:], none)
        return out

    before, after, second = shifted(shape, 1, 1000), shifted(shape, -1, 1001), shifted(shape, 2, 1000)
    last = np.maximum.accumulate(np.where(alpha, np.arange(len(at)), -1)) if len(at) else np.zeros(0, np.int64)
    last = shifted(last, 1, -1)
    known = np.where(last >= first[chunk], word[np.maximum(last, 0)], wh.U(0))
    chars = _bits(_segments(~later, co[:-1]), 7)[chunk]
    slots = [
        _slots(1, shape), _slots(2, before, shape), _slots(3, shape, after), _slots(4, second, before, shape), _slots(5, variety, switches, bits), _slots(6, chars, shape), _slots(7, np.minimum(9, n_tokens)[chunk], coarse),
        _slots(8, word), _slots(9, shifted(word, 1, 0)), _slots(10, known, coarse),
    ]
    always = np.ones(len(at), bool)
    used = [*[always] * 7, alpha & (length < 12), shifted(alpha, 1, False), place > 1]
    solid = np.flatnonzero(~_STRIP[cb])
    lo, hi = np.searchsorted(solid, co[:-1]), np.searchsorted(solid, co[1:])
    full = hi > lo
    norm = np.zeros(len(size), wh.U)
    norm[full] = wh.span_hashes(cb, solid[lo[full]], solid[hi[full] - 1] + 1, True)
    return Tokens(chunk, at - co[chunk], to - co[chunk], first, coarse, norm, np.stack(slots, 1), np.stack(used, 1))


def _laid(words: list[str]) -> tuple[np.ndarray, Tokens]:
    raw, o = wh.joined_texts(words)
    b = np.frombuffer(raw, np.uint8)
    return b, tokens_of(b, o[:-1], o[1:])


def features_of(examples: list[tuple[str, list[str], list[int]]]) -> list[tuple[list[int], list[list[int]]]]:
    """For chunks, the words before each and their texts' traits: token ends in characters, and the slots of each token's features."""
    words = sorted({w for _, before, _ in examples for w in before if w})
    norm = dict(zip(words, _laid(words)[1].norm, strict=True)) if words else {}
    b, t = _laid([c for c, _, _ in examples])
    two, one = (np.array([norm.get(before[-k], 0) if len(before) >= k else 0 for _, before, _ in examples], wh.U)[t.chunk] for k in (2, 1))
    around = np.stack([_slots(PREVIOUS, one, t.coarse), _slots(SECOND, two)], 1).tolist()
    points = np.append(0, np.cumsum((b & 0xC0) != 0x80))
    origin = np.append(0, np.cumsum([len(c.encode()) for c, _, _ in examples]))[t.chunk]
    ends = (points[origin + t.end] - points[origin]).tolist()
    slots = [s[u].tolist() + x for s, u, x in zip(t.slots, t.used, around, strict=True)]
    return [(ends[a:z], [x + list(file) for x in slots[a:z]]) for (_, _, file), a, z in zip(examples, t.first, t.first[1:], strict=False)]


def features(chunk: str, before: list[str], file: list[int]) -> tuple[list[int], list[list[int]]]:
    return features_of([(chunk, before, file)])[0]


def _file_slots(points: np.ndarray, equals: np.ndarray, braces: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Slots of texts' traits: length, and whether there are `=`, `{` and `;`."""
    return np.stack([_slots(LENGTH, _bits(points, 12)), _slots(SIGNS, (equals > 0) + 2 * (braces > 0) + 4 * (stops > 0))], 1)


def file_features(text: str) -> list[int]:
    return _file_slots(*(np.array([x]) for x in (len(text), text.count("="), text.count("{"), text.count(";"))))[0].tolist()


def chunks(text: str) -> Iterator[tuple[int, str, list[str]]]:
    """All chunks: place, characters, the two words before."""
    before: list[str] = []
    for m in CHUNK.finditer(text):
        yield m.start(), m[0], before
        before = [*before[-1:], m[0]]


def _summed(table: np.ndarray, t: Tokens) -> np.ndarray:
    """Of each token, the sum of the table's rows for its features."""
    out = np.zeros((len(t.chunk), table.shape[1]))
    for k in range(t.slots.shape[1]):
        out += table[t.slots[:, k]] * t.used[:, k, None]
    return out


class Known:
    """What a worker remembers of chunks: what others must add for a token not to be outside, kinds of tokens, and the chunk as a word before others."""

    def __init__(self, field: Field):
        self.field, self.memory = field, wh.Memory(REMEMBERED)
        self.need, self.kinds, self.norm = np.zeros(0), np.zeros((0, FEW_KINDS), np.uint8), np.zeros(0, wh.U)
        self.gain = np.zeros((0, 2))

    def learn(self, b: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray, forget: bool) -> None:
        if forget and len(self.need) + len(hashes) > self.memory.most:
            keep = self.memory.shrunk()
            self.need, self.kinds, self.norm, self.gain = (x[keep] for x in (self.need, self.kinds, self.norm, self.gain))
        t = tokens_of(b, start, end)
        need, kinds = self.field.needs(t), self._kinds(t)
        need[kinds[:, 0] == 255] = -np.inf  # too many kinds
        new = need, kinds, t.norm, self.field.gains[_slots(SECOND, t.norm)]
        self.need, self.kinds, self.norm, self.gain = (np.concatenate(x) for x in zip((self.need, self.kinds, self.norm, self.gain), new, strict=True))
        self.memory.add(hashes)

    @staticmethod
    def _kinds(t: Tokens) -> np.ndarray:
        """Up to FEW_KINDS different rough shapes of each chunk, the first again where there are fewer; 255 where there are more."""
        pairs = np.unique(t.chunk * 256 + t.coarse)
        of, kind = pairs >> 8, (pairs & 255).astype(np.uint8)
        begin = np.searchsorted(of, np.arange(len(t.first) - 1))
        place = np.arange(len(of)) - begin[of]
        out = np.repeat(kind[begin][:, None], FEW_KINDS, 1)
        some = place < FEW_KINDS
        out[of[some], place[some]] = kind[some]
        out[of[~some]] = 255
        return out


class Field:
    """Weights of features by label and of label pairs; a token inside never follows one outside."""

    def __init__(self, weights: np.ndarray, steps: np.ndarray):
        self.weights, self.steps, self.key = weights, steps, uuid.uuid4().hex
        self.gains = weights[:, 1:] - weights[:, :1]  # of begin and inside over outside

    def decode(self, slots: list[list[int]]) -> list[int]:
        return self._viterbi(np.array([self.weights[s].sum(0) for s in slots])[None])[0].tolist()

    def _viterbi(self, emit: np.ndarray) -> np.ndarray:
        """The best labels of chains of equal length (chain, token, label)."""
        best, back = emit[:, 0] + np.array([0.0, 0.0, -1e9]), []
        for j in range(1, emit.shape[1]):
            all_of = best[:, :, None] + self.steps
            back.append(all_of.argmax(1))
            best = all_of.max(1) + emit[:, j]
        y = [best.argmax(1)]
        for k in reversed(back):
            y.append(np.take_along_axis(k, y[-1][:, None], 1)[:, 0])
        return np.stack(y[::-1], 1)

    def needs(self, t: Tokens) -> np.ndarray:
        """For each chunk what words before and traits of the text must add to begin or inside, at least, for a token not to be outside."""
        n_tokens = np.diff(t.first)
        out = np.full(len(n_tokens), -np.inf)
        each = _summed(self.gains, t)
        d = self.steps - self.steps[OUT, OUT]
        for n in np.unique(n_tokens[n_tokens <= FEW_TOKENS]).tolist():
            rows = np.flatnonzero(n_tokens == n)
            gain = each[t.first[rows][:, None] + np.arange(n)]
            # best sums over those of all outside, by the last label and the number of tokens not outside
            best = {(OUT, 0): np.zeros(len(rows)), (BEGIN, 1): gain[:, 0, 0]}
            for j in range(1, n):
                new: dict[tuple[int, int], np.ndarray] = {}
                for (y, k), v in best.items():
                    for z in (OUT, BEGIN, INSIDE):
                        if y == OUT and z == INSIDE:
                            continue
                        to, sums = (z, k + (z != OUT)), v + d[y, z] + (gain[:, j, z - 1] if z else 0)
                        new[to] = np.maximum(new[to], sums) if to in new else sums
                best = new
            out[rows] = np.min([-v / k for (_, k), v in best.items() if k], axis=0)
        return out

    def _open(self, b: np.ndarray, o: np.ndarray) -> tuple[wh.Words, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Chunks of texts, those that the bound does not show to be outside, hashes of the two words before each of these, slots of texts."""
        w = wh.words(b, o, wh.SOLID, False)
        known: Known = wh.holder(("secrets", self.key), lambda: Known(self))
        hashes, first, which = np.unique(w.hash, return_index=True, return_inverse=True)
        number = known.memory.find(hashes)
        for forget in (True, False):  # a full memory is numbered anew, and what it forgot of these is learnt again
            new = np.flatnonzero(number < 0)
            if len(new):
                known.learn(b, w.start[first[new]], w.end[first[new]], hashes[new], forget)
                number = known.memory.find(hashes)
        counts = [wh.per_text(b == ord(c), o) for c in "={;"]
        files = _file_slots(wh.per_text((b & 0xC0) != 0x80, o), *counts)
        text = w.text
        row, place = number[which], np.arange(len(which)) - w.first[text]
        one, two = (np.where(place >= k, row[np.maximum(np.arange(len(row)) - k, 0)], -1) for k in (1, 2))
        none = self.gains[_slots(SECOND, np.zeros(1, wh.U))]
        add = np.where(two[:, None] >= 0, known.gain[two], none) + self.gains[files].sum(1)[text]
        need = known.need[row] - 1e-6
        most = self.gains.max(0)
        at = np.flatnonzero(need <= (add + most).max(1))
        prev = np.where(one[at] >= 0, known.norm[one[at]], wh.U(0))
        told = np.max([self.gains[_slots(PREVIOUS, prev, known.kinds[row[at], k])] for k in range(FEW_KINDS)], axis=0) if len(at) else np.zeros((0, 2))
        at = at[need[at] <= (add[at] + told).max(1)]
        norms = np.stack([np.where(x[at] >= 0, known.norm[x[at]], wh.U(0)) for x in (one, two)], 1) if len(at) else np.zeros((0, 2), wh.U)
        return w, at, text[at], norms, files

    def open_chunks(self, text: str) -> list[tuple[int, str, list[str]]]:
        """Those of chunks(text) that the bound does not show to be outside."""
        raw, o = wh.joined_texts([text])
        _, at, *_ = self._open(np.frombuffer(raw, np.uint8), o)
        opened = set(at.tolist())
        return [c for k, c in enumerate(chunks(text)) if k in opened]

    def text_spans(self, texts: list[str]) -> list[list[tuple[int, int]]]:
        """Spans of each text, in code points."""
        raw, o = wh.joined_texts(texts)
        b = np.frombuffer(raw, np.uint8)
        w, at, of, norms, files = self._open(b, o)
        out: list[list[tuple[int, int]]] = [[] for _ in texts]
        if not len(at):
            return out
        t = tokens_of(b, w.start[at], w.end[at])
        emit = _summed(self.weights, t)
        emit += self.weights[_slots(PREVIOUS, norms[t.chunk, 0], t.coarse)] + self.weights[_slots(SECOND, norms[:, 1])][t.chunk] + self.weights[files[of]].sum(1)[t.chunk]
        n_tokens, label = np.diff(t.first), np.zeros(len(emit), np.int64)
        for n in np.unique(n_tokens).tolist():
            places = t.first[np.flatnonzero(n_tokens == n)][:, None] + np.arange(n)
            label[places] = self._viterbi(emit[places])
        points = np.append(0, np.cumsum((b & 0xC0) != 0x80))
        goes_on = np.append((label[1:] == INSIDE) & (t.chunk[1:] == t.chunk[:-1]), False)
        ends = np.flatnonzero(~goes_on)
        for i in np.flatnonzero(label == BEGIN).tolist():
            j, c = int(ends[np.searchsorted(ends, i)]), int(t.chunk[i])
            origin, from_ = points[o[of[c]]], int(w.start[at[c]])
            out[of[c]].append((int(points[from_ + t.start[i]] - origin), int(points[from_ + t.end[j]] - origin)))
        return out

    def spans(self, text: str) -> list[tuple[int, int]]:
        return self.text_spans([text])[0]


def trained(examples: list[tuple[list[list[int]], list[int]]], epochs: int = EPOCHS) -> Field:
    """A field by gradient ascent on the conditional log-likelihood, with forward and backward sums over all chains at once."""
    weights, steps = np.zeros((SLOTS, 3)), np.zeros((3, 3))
    if not examples:
        weights[:, OUT] = 1.0
        return Field(weights, steps)
    size, wide = max(len(y) for _, y in examples), max(len(s) for x, _ in examples for s in x)
    n = len(examples)
    slot, gold, real = np.zeros((n, size, wide), np.int64), np.zeros((n, size), np.int64), np.zeros((n, size), bool)
    used = np.zeros((n, size, wide))
    for i, (x, y) in enumerate(examples):
        gold[i, : len(y)], real[i, : len(y)] = y, True
        for j, s in enumerate(x):
            slot[i, j, : len(s)], used[i, j, : len(s)] = s, 1
    allowed = np.zeros((3, 3))
    allowed[OUT, INSIDE] = -1e9
    g_w, g_s = np.full_like(weights, 1e-3), np.full_like(steps, 1e-3)
    rows = np.arange(n)
    for _ in range(epochs):
        emit = np.stack([(weights[:, k][slot] * used).sum(2) for k in range(3)], 2)
        t = steps + allowed
        ahead, back = np.zeros((n, size, 3)), np.zeros((n, size, 3))
        ahead[:, 0] = emit[:, 0] + [0, 0, -1e9]
        for j in range(1, size):
            new = np.logaddexp.reduce(ahead[:, j - 1, :, None] + t, axis=1) + emit[:, j]
            ahead[:, j] = np.where(real[:, j, None], new, ahead[:, j - 1])
        total = np.logaddexp.reduce(ahead[:, -1], axis=1)
        for j in range(size - 2, -1, -1):
            new = np.logaddexp.reduce(t + (emit[:, j + 1] + back[:, j + 1])[:, None, :], axis=2)
            back[:, j] = np.where(real[:, j + 1, None], new, 0)
        belief = np.exp(np.minimum(0, ahead + back - total[:, None, None])) * real[..., None]
        gap = -belief
        np.add.at(gap, (rows[:, None], np.arange(size)[None], gold), real)
        grad = np.stack([np.bincount(slot.ravel(), (gap[:, :, k, None] * used).ravel(), SLOTS) for k in range(3)], 1) / n - L2 * weights
        move = np.zeros((3, 3))
        for j in range(1, size):
            both = np.exp(np.minimum(0, ahead[:, j - 1, :, None] + t + (emit[:, j] + back[:, j])[:, None, :] - total[:, None, None])) * real[:, j, None, None]
            move -= both.sum(0)
            np.add.at(move, (gold[real[:, j], j - 1], gold[real[:, j], j]), 1)
        move /= n
        g_w += grad**2
        g_s += move**2
        weights += RATE * grad / np.sqrt(g_w)
        steps += RATE * move / np.sqrt(g_s)
    return Field(weights, steps + allowed)


def labelled(chunk: str, secret: list[tuple[int, int]], ends: list[int] | None = None) -> list[int]:
    """Labels of a chunk's tokens, given where its secrets lie, and where its tokens end, in characters."""
    out, at, held = [], 0, None
    for end in ends or features(chunk, [], [])[0]:
        inside = next((s for s in secret if s[0] <= at < s[1]), None)
        out.append(OUT if inside is None else INSIDE if inside == held else BEGIN)
        held, at = inside, end
    return out


def made_examples(n: int = 1400, seed: int = SEED) -> list[tuple[str, list[str], list[tuple[int, int]]]]:
    """Made chunks with the words before them and their secrets: keys of public formats, passphrases of letters, and words and numbers that are none."""
    r = random.Random(seed)
    b64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    pick = lambda a, lo, hi: "".join(r.choice(a) for _ in range(r.randint(lo, hi)))
    syllable = lambda: r.choice("bcdfghlmnprstvw") + r.choice("aeiou") + r.choice(["", "n", "r", "s", "t", "l"])
    word = lambda lo, hi: "".join(syllable() for _ in range(r.randint(lo, hi)))
    usual = "required wrong invalid not the a an needed expired missing case-sensitive correct stored here empty too short long reset changed set used given known lost secret hidden safe to and of in for with is are this that your".split()
    prose = ["the", "and", "of", "en", "la", "der", "und", "in", "los", "to", "it", "see", "is"]
    out = []
    for _ in range(n):
        kind = r.randrange(34)
        words = [r.choice(prose), r.choice(prose)]
        secret = [pick("0123456789abcdef", 24, 64), pick(b64, 20, 44), pick(b64 + "+/", 30, 60) + "=" * r.randrange(3), "ghp_" + pick(b64, 36, 36), "sk_live_" + pick(b64, 24, 32), "AKIA" + pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 16, 16), "eyJ" + pick(b64, 16, 30) + "." + pick(b64, 20, 40) + "." + pick(b64 + "_-", 24, 43), "xoxb-" + pick("0123456789", 11, 13) + "-" + pick(b64, 24, 24), "AIza" + pick(b64 + "_-", 35, 35)][r.randrange(9)]
        if kind < 4:
            key = r.choice(["password", "passwd", "secret", "token", "api_key", "apikey", "auth", "client_secret", "access_key", "SECRET_KEY"])
            sep, q = r.choice(["=", ":", '="', "='", ':"']), r.choice(["", ",", ";"])
            head = key + sep
            tail = sep[-1] if sep[-1] in "\"'" else ""
            out.append((head + secret + tail + q, words, [(len(head), len(head) + len(secret))]))
        elif kind < 7:
            words = [r.choice(["password", "secret", "token", "api_key", "key", "bearer", "authorization", "credentials"]), r.choice(["=", ":", "is", "bearer", ""])]
            q = r.choice(["", '"', "'"])
            out.append((q + secret + q, words, [(len(q), len(q) + len(secret))]))
        elif kind < 10:
            out.append((secret + r.choice(["", ".", ","]), words, [(0, len(secret))]))
        elif kind < 15:  # letters alone: after a key or a word that tells, or long and of mixed case
            letters = b64[:52]
            secret = [pick(letters, 20, 44), pick(letters, 10, 20), "-".join(word(1, 3) for _ in range(r.randint(3, 5))), word(5, 10), pick(letters[26:], 10, 24), pick(letters + "+/", 24, 44) + "=" * r.randrange(3)][r.randrange(6)]
            head, tail = "", r.choice(["", "", ".", ","])
            if kind < 13 or not (len(secret) >= 20 and "-" not in secret and secret.lower() != secret):
                words = [r.choice(["password", "passphrase", "secret", "token", "key", "credentials"]), r.choice(["is", "", "was"])] if r.random() < 0.6 else [r.choice(prose), r.choice(["bearer", "password", "token", "secret", "passphrase"])]
                if r.random() < 0.25:
                    head = r.choice(["password", "passwd", "secret", "token", "auth"]) + r.choice(["=", ":"])
            out.append((head + secret + tail, words, [(len(head), len(head) + len(secret))]))
        elif kind < 24:  # words, also after those that tell
            plain = r.choice([r.choice(usual), word(1, 3), word(2, 6), word(1, 4).capitalize(), word(5, 11), word(5, 9).capitalize(), word(1, 5) + r.choice("äöüßéèêñó") + word(1, 5), word(1, 2) + "-" + word(1, 3), word(1, 2).upper()])
            if r.random() < 0.3:
                words, plain = r.choice([[r.choice(["password", "secret", "token", "key"]), r.choice(["is", "was", ""])], [r.choice(prose), r.choice(["bearer", "password", "token", "secret"])]]), r.choice([r.choice(usual), word(1, 2)])
            out.append((r.choice(["", "", "", "(", '"']) + plain + r.choice(["", "", "", ".", ",", ";", ")", ":"]), words, []))
        else:
            plain = [
                f"+{r.randint(1, 99)}", f"({r.randint(200, 999)})", f"555-{r.randint(1000, 9999)}", ".".join(str(r.randint(0, 255)) for _ in range(4)), pick("0123456789", 1, 10), f"{r.randint(1900, 2030)}-{r.randint(1, 12):02}-{r.randint(1, 28):02}",
                f"{r.randint(0, 23)}:{r.randint(0, 59):02}", f"{r.randint(1, 20)}.{r.randint(0, 9)}.{r.randint(0, 30)}", f"${r.randint(1, 9999)}.{r.randint(0, 99):02}", f"https://www.example.com/page/{r.randint(1, 9999)}?id={r.randint(1, 99)}", f"user{r.randint(1, 999)}@example.org", f"{r.randint(1, 99)}%",
                f"covid-{r.randint(10, 30)}", f"h{r.randint(1, 6)}", f"mp{r.randint(2, 4)}", f"word{r.randint(1, 99)}", f"Table{r.randint(1, 30)}.", f"ISBN-{r.randint(100, 999)}-{r.randint(1, 9)}-{r.randint(10, 99)}-{r.randint(100000, 999999)}-{r.randint(0, 9)}", f"({r.randint(1900, 2030)})",
                "-".join(pick("0123456789abcdef", n, n) for n in (8, 4, 4, 4, 12)), f"ORD-{r.randint(2000, 2030)}-{r.randint(1, 999999):06}", f"{r.choice(['INV', 'PO', 'IMG_', 'SKU-'])}{r.randint(10**6, 10**9)}", f"{r.randint(1990, 2030)}-{r.randint(1, 12):02}-{r.randint(1, 28):02}T{r.randint(0, 23):02}:00:00Z", f"v{r.randint(0, 9)}.{r.randint(0, 30)}.{r.randint(0, 9)}-{r.randint(1, 99)}-g{pick('0123456789abcdef', 7, 7)}", f"/usr/lib/{word(1, 2)}{r.randint(1, 99)}/{word(2, 3)}.so.{r.randint(1, 9)}", f"{word(1, 3)}_{r.randint(1, 20240101)}.jpg",
            ]
            out.append((r.choice(plain) + r.choice(["", "", ".", ",", "!!"]), words, []))
    return out


def background(docs: DataFrame, sample: int = SAMPLE_DOCS) -> list[tuple[str, list[str], list[tuple[int, int]], list[int]]]:
    """Different chunks of about `sample` texts picked by a hash of doc_id, SAMPLE_CHUNKS at most with a digit, SAMPLE_WORDS
    without and SAMPLE_LONG long ones without, with the base patterns' secrets in them and their texts' file features."""
    n = docs.count()
    rows = docs.where(F.expr(f"text is not null and pmod(xxhash64(doc_id, text), 1073741824) < {int(min(1.0, sample / max(n, 1)) * (1 << 30))}")).select("text")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for text in batch.column(0).to_pylist():
                base, file, first = base_spans(text), file_features(text), 0
                base.sort(key=lambda x: x[3])
                for at, chunk, before in chunks(text):
                    while first < len(base) and base[first][2] <= at:
                        first += 1
                    inside, k = [], first
                    while k < len(base) and base[k][3] < at + len(chunk):
                        if base[k][2] > at:
                            inside += [max(0, base[k][3] - at), min(len(chunk), base[k][2] - at)]
                        k += 1
                    for c, x in zip(out, (chunk[:FIT_CHARS], before, [x for x in inside if x <= FIT_CHARS], file, DIGIT.search(chunk) is not None), strict=True):
                        c.append(x)
            types = (pa.string(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], ["chunk", "before", "inside", "file", "digit"])

    found = staged(rows.mapInArrow(tidy(find), "chunk string, before array<string>, inside array<int>, file array<int>, digit boolean"))
    order = F.xxhash64("chunk", "before", "file"), "chunk", "before", "file", "inside"
    kinds = ("digit", SAMPLE_CHUNKS), ("not digit", SAMPLE_WORDS), ("not digit and length(chunk) >= 12", SAMPLE_LONG)
    some = reduce(DataFrame.unionAll, [found.where(kind).orderBy(*order).limit(most) for kind, most in kinds])
    return [(c, list(b), list(zip(i[::2], i[1::2], strict=False)), list(f)) for c, b, i, f, _ in some.collect()]


def made_files(made: list[tuple[str, list[str], list[tuple[int, int]]]], seen: list[list[int]], seed: int = SEED) -> list[list[int]]:
    """File features for made examples, whatever their labels: those of texts seen, or of any length and any of the marks."""
    r, out = random.Random(seed), []
    for chunk, _, _ in made:
        if seen and r.random() < 0.5:
            out.append(list(r.choice(seen)))
        else:
            marks = [int(r.random() < 0.5 or c in chunk) for c in "={;"]
            out.append(_file_slots(*(np.array([x]) for x in (max(len(chunk), 2 ** r.randint(2, 12)), *marks)))[0].tolist())
    return out


def fitted(docs: DataFrame, sample: int = SAMPLE_DOCS) -> Field:
    """A field from made examples and a bounded sample of the texts' own chunks, labelled by the base patterns."""
    made, own = made_examples(), background(docs, sample)
    files = made_files(made, [f for *_, f in own])
    given = [(*x, f) for x, f in zip(made, files, strict=True)] + own
    found = features_of([(chunk, before, file) for chunk, before, _, file in given])
    return trained([(slots[:FIT_TOKENS], labelled(chunk, secret, ends)[:FIT_TOKENS]) for (chunk, _, secret, _), (ends, slots) in zip(given, found, strict=True)])


def apart(found: list[tuple[int, int]], base: list[tuple[int, int, int, int]]) -> list[tuple[int, int]]:
    """Those of found (start, end), in order, that overlap none of base, in order of start: both lists are walked once."""
    out, k, reach = [], 0, 0
    for s, e in sorted(found):
        while k < len(base) and base[k][0] < e:
            reach = max(reach, base[k][2])
            k += 1
        if reach <= s:
            out.append((s, e))
    return out


def _scans(texts: list[str], field: Field) -> list[list[tuple[int, int, int, int]]]:
    """All spans of each text: base ones, and those of the field that overlap none of them."""
    out, a, held = [], 0, 0
    for k, t in enumerate([*texts, None]):
        if t is None or held + len(t) > SLICE and k > a:
            for text, found in zip(texts[a:k], field.text_spans(texts[a:k]) if k > a else [], strict=True):
                base = base_spans(text)
                more = [(s, 3, e, s) for s, e in apart(found, base)]
                out.append(sorted(base + more) if more else base)
            a, held = k, 0
        held += len(t or "")
    return out


def _scan(text: str, field: Field) -> list[tuple[int, int, int, int]]:
    return _scans([text], field)[0]


def _join(spans: list[tuple[int, int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e, _ in spans)


def scanned(docs: DataFrame, field: Field) -> DataFrame:
    """Base counts, digest and all spans of each row of docs (doc_id, text), of the whole text however long.

    A null or empty text has no spans: zeros, the digest of nothing and an empty string. Places are code points. Spans of the
    field never overlap base ones. Repeated rows and ties give a row each; other columns are ignored; no rows give none.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def make(column: pa.Array) -> list[pa.Array]:
        rows: list[list] = [[], [], [], [], []]
        for spans in _scans([t or "" for t in column.to_pylist()], shared.value):
            base = [x for x in spans if x[1] < 3]
            values = [*(sum(x[1] == k for x in base) for k in range(3)), hashlib.sha256(_join(base).encode()).hexdigest(), _join(spans)]
            for r, v in zip(rows, values, strict=True):
                r.append(v)
        return [pa.array(r, pa.int64() if k < 3 else pa.string()) for k, r in enumerate(rows)]

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return appended(rows, "n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string", make, limit=SLICE, keep="secrets").drop("text")


def redacted(docs: DataFrame, field: Field, name: str = "__redacted", mark: str = "[SECRET]") -> DataFrame:
    """docs with a column of the text in which every secret is replaced by a mark.

    A null text stays null, an empty one empty; very long texts are taken whole; repeated rows stay; a column of docs that is
    named like the new one is replaced; no rows give none.
    """
    docs = docs.drop(name)
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def hidden(text: str | None, spans: list[tuple[int, int, int, int]]) -> str | None:
        if not spans:
            return text
        parts, at = [], 0
        for begin, end in sorted((s, e) for _, _, e, s in spans):
            if end > at:
                parts += [text[at : max(at, begin)]] + ([mark] if begin >= at else [])
                at = end
        return "".join(parts) + text[at:]

    def make(column: pa.Array) -> list[pa.Array]:
        texts = column.to_pylist()
        return [pa.array([hidden(t, x) for t, x in zip(texts, _scans([t or "" for t in texts], shared.value), strict=True)], pa.string())]

    return appended(docs, f"`{name}` string", make, limit=SLICE, keep="secrets")
