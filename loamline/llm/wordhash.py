"""Words of many texts and 64-bit hashes of words, lines and word windows, by numpy over the texts' bytes.

A byte's random value times a power of an odd base, summed without bound modulo 2**64 and divided by the
power of the word's place, is the same wherever the word stands; a final mix spreads the bits.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_CHUNK = 1 << 18
_powers: dict[str, np.ndarray] = {"n": np.zeros(0, U)}


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def seeded(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit values, the same everywhere."""
    return mix(np.arange(1, n + 1, dtype=U) * U(_BASE) + U(seed)) | U(1)


_VALUES = seeded(256, 7)
_FOLDED = _VALUES.copy()
_FOLDED[65:91] = _VALUES[97:123]
_STEPS = seeded(64, 11)

#: Bytes of words: letters and digits of ASCII and every byte of other characters.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
#: Bytes of words that white space of ASCII parts.
SOLID = np.ones(256, bool)
SOLID[[32, *range(9, 14)]] = False


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, n at least."""
    if len(_powers["n"]) < n:
        size = max(_CHUNK + 2, n)
        for key, base in (("n", _BASE), ("i", _INVERSE)):
            a = np.full(size, base, U)
            a[0] = 1
            _powers[key] = np.multiply.accumulate(a)
    return _powers["n"], _powers["i"]


def span_hashes(b: np.ndarray, start: np.ndarray, end: np.ndarray, fold: bool = False) -> np.ndarray:
    """Hashes of b[start:end) for spans within one chunk of bytes."""
    up, down = powers(len(b) + 1)
    sums = np.zeros(len(b) + 1, U)
    np.cumsum((_FOLDED if fold else _VALUES)[b] * up[: len(b)], out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start])


def hashes_of(b: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of b[start:end) for spans in rising order, by chunks, so that many bytes take no more than their spans."""
    out = np.zeros(len(start), U)
    i = 0
    while i < len(start):
        at = int(start[i])
        j = max(i + 1, int(np.searchsorted(end, at + _CHUNK, "right")))
        out[i:j] = span_hashes(b[at : int(end[j - 1])], start[i:j] - at, end[i:j] - at)
        i = j
    return out


@dataclass
class Words:
    start: np.ndarray  # bytes
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # of each text, the number of its first word; one more entry at the end

    @property
    def text(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words(b: np.ndarray, offsets: np.ndarray, kind: np.ndarray, fold: bool) -> Words:
    """fold: A to Z count as a to z."""
    inside = kind[b] if len(b) else np.zeros(0, bool)
    edge = offsets[:-1][np.diff(offsets) > 0]
    before = np.zeros(len(b), bool)
    before[1:] = inside[:-1]
    before[edge] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(len(b), bool)
    after[:-1] = inside[1:]
    after[edge[1:] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    hashes = np.zeros(len(starts), U)
    i = 0
    while i < len(starts):  # by chunks, so that a very long text takes no more than its words
        at = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, at + _CHUNK, "right")))
        hashes[i:j] = span_hashes(b[at : int(ends[j - 1])], starts[i:j] - at, ends[i:j] - at, fold)
        i = j
    return Words(starts, ends, hashes, np.searchsorted(starts, offsets))


def grams(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For each word the hash of the k words from it on, and whether its text has so many."""
    n = len(w.hash)
    out = np.zeros(n, U)
    whole = np.zeros(n, bool)
    if n >= k:
        acc = w.hash[: n - k + 1] * _STEPS[0]
        for j in range(1, k):
            acc += w.hash[j : n - k + 1 + j] * _STEPS[j]
        out[: n - k + 1] = mix(acc + U(k))
        whole = np.arange(n) + k <= np.repeat(w.first[1:], np.diff(w.first))
    return out, whole


def second_hashes(w: Words, at: np.ndarray, k: int) -> np.ndarray:
    """Another hash of the k words from each of the places on, to hold hits of `grams` against."""
    out = np.zeros(len(at), U)
    for j in range(k):
        out += mix(w.hash[at + j] + U(j)) * _STEPS[63 - j]
    return out


def per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of values between the entries of first."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def covered(at: np.ndarray, k: int, n: int) -> np.ndarray:
    """Which of n places lie in a run of k from one of `at`."""
    step = np.zeros(n + 1, np.int32)
    np.add.at(step, at, 1)
    np.add.at(step, np.minimum(at + k, n), -1)
    return np.cumsum(step[:n]) > 0


def joined_texts(texts: list[str]) -> tuple[bytes, np.ndarray]:
    """The texts' bytes one after another, and where each begins, with the end last."""
    raw = [t.encode() for t in texts]
    o = np.zeros(len(raw) + 1, np.int64)
    np.cumsum([len(r) for r in raw], out=o[1:])
    return b"".join(raw), o


class Memory:
    """Numbers of remembered hashes, 0 and up, in sorted arrays of 8 bytes each; those that never came back go first.

    Hashes are added in sorted order, into a small array that is merged into the large one from time to time.
    """

    def __init__(self, most: int, fresh: int = 1 << 16):
        self.most, self.fresh = most, fresh
        self.clear()

    def clear(self) -> None:
        self.levels = [(np.zeros(0, U), np.zeros(0, np.int64))] * 2
        self.seen = np.zeros(0, np.int32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each of the different hashes, -1 for new ones."""
        out = np.full(len(hashes), -1, np.int64)
        for keys, numbers in self.levels:
            if len(keys):
                at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
                hit = keys[at] == hashes
                out[hit] = numbers[at[hit]]
        self.seen[out[out >= 0]] += 1
        return out

    @staticmethod
    def _merged(a: tuple, b: tuple) -> tuple:
        keys = np.concatenate([a[0], b[0]])
        order = np.argsort(keys, kind="stable")
        return keys[order], np.concatenate([a[1], b[1]])[order]

    def add(self, hashes: np.ndarray) -> None:
        """New hashes, in order, with the next numbers."""
        n = len(self.seen)
        self.seen = np.append(self.seen, np.zeros(len(hashes), np.int32))
        self.levels[1] = self._merged(self.levels[1], (hashes, np.arange(n, n + len(hashes))))
        if len(self.levels[1][0]) > self.fresh:
            self.levels = [self._merged(*self.levels), (np.zeros(0, U), np.zeros(0, np.int64))]

    def shrunk(self) -> np.ndarray:
        """Forgets what never came back, and more if that leaves over half: the old numbers of what stays, which is numbered anew."""
        keep = np.flatnonzero(self.seen)
        if len(keep) > self.most // 2:
            keep = np.sort(keep[np.argsort(-self.seen[keep], kind="stable")[: self.most // 2]])
        new = np.full(len(self.seen), -1, np.int64)
        new[keep] = np.arange(len(keep))
        keys, numbers = self._merged(*self.levels)
        stay = new[numbers] >= 0
        self.levels = [(keys[stay], new[numbers[stay]]), (np.zeros(0, U), np.zeros(0, np.int64))]
        self.seen = np.zeros(len(keep), np.int32)
        return keep


#: The one holder of remembered words in this process: another one's are freed when it is asked for.
_holder: dict = {}


def release(keep: str = "") -> bool:
    """Frees what another operator than `keep` holds in this worker; whether there was anything."""
    if _holder and next(iter(_holder))[0] != keep:
        _holder.clear()
        return True
    return False


def holder(key: tuple, make):
    """make(), kept for this worker until another key is asked for, so that a reused worker holds one memory at a time."""
    if key not in _holder:
        _holder.clear()
        _holder[key] = make()
    return _holder[key]
