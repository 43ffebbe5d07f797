"""Line-first cleaning: rules judge each line, failing lines go, and a document that loses too much text is rejected."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import wordhash as wh
from .common import text_slices, tidy

#: Phrases of notices in English, German, French and Spanish, in lower case.
PHRASES = (
    "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy", "uses cookies", "enable javascript", "subscribe to our", "sign up for our", "click here", "lorem ipsum", "skip to content", "powered by wordpress",
    "alle rechte vorbehalten", "nutzungsbedingungen", "datenschutzerklärung", "verwendet cookies", "newsletter abonnieren", "klicken sie hier", "zum inhalt springen",
    "tous droits réservés", "conditions d'utilisation", "politique de confidentialité", "utilise des cookies", "abonnez-vous", "cliquez ici", "aller au contenu",
    "todos los derechos reservados", "condiciones de uso", "política de privacidad", "utiliza cookies", "suscríbete a", "haz clic aquí", "saltar al contenido",
)
SYMBOLS = b"#*$%&|<>"
BARS = b"|>\t"
MARKS = b".!?:;\"')]}"


@dataclass(frozen=True)
class Rules:
    """min_words and max_repeat: of the whole text. A line without a closing mark fails if shorter than open_words; one with a bar for every bar_words words,
    if it has min_bars; one with symbols in more than max_symbol of its words; one with a phrase of a notice that
    is at least one of phrase_share of its words, in letters of any case and with any apostrophe. A text whose failing lines hold more than max_loss of its words is rejected."""

    min_words: int = 20
    max_repeat: int = 30
    open_words: int = 3
    min_bars: int = 4
    bar_words: float = 2.5
    max_symbol: float = 0.5
    max_loss: float = 0.5
    phrase_share: int = 6
    phrases: tuple[str, ...] = field(default=PHRASES)


def _flags(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_SYMBOL, _BAR, _MARK = _flags(SYMBOLS), _flags(BARS), _flags(MARKS)


def _closed(b: np.ndarray, last: int) -> bool:
    """Whether the character that ends with a byte beyond ASCII is punctuation: a closing quote, an ellipsis or another script's stop."""
    first = last
    while first and b[first] & 0xC0 == 0x80:
        first -= 1
    return unicodedata.category(b[first : last + 1].tobytes().decode())[0] == "P"


def plain(text: str) -> str:
    """In lower case, letters composed, with straight apostrophes."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text).replace("’", "'").replace("ʼ", "'")
    return text.lower()


def _counts(b: np.ndarray, flags: np.ndarray) -> np.ndarray:
    out = np.zeros(len(b) + 1, np.int32)
    np.cumsum(flags[b], out=out[1:])
    return out


def _judge(b: np.ndarray, o: np.ndarray, r: Rules) -> tuple[dict, np.ndarray, np.ndarray, np.ndarray]:
    """Figures by text, and the lines that fail: text, first and last byte."""
    n = len(o) - 1
    w = wh.words(b, o, wh.SOLID, False)
    doc, n_words = w.text, np.diff(w.first)
    points = np.zeros(len(b) + 1, np.int64)
    np.cumsum(wh.SOLID[b] & ((b & 0xC0) != 0x80), out=points[1:])
    symbols = _counts(b, _SYMBOL)
    g, whole = wh.grams(w, 8)
    at = np.flatnonzero(whole)
    key = wh.mix(g[at] ^ wh.mix(doc[at].astype(wh.U) + wh.U(1)))
    _, back, seen = np.unique(key, return_inverse=True, return_counts=True)
    repeat = wh.covered(at[seen[back] > 1], 8, len(g))
    # lines with a word: where they begin, by word and by byte
    nl = np.flatnonzero(b == 10)
    row = np.searchsorted(nl, w.start)
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(row)))
    of, k = doc[first], row[first]
    edges = np.append(nl, len(b))
    start = np.maximum(o[of], np.where(k > 0, edges[np.maximum(k, 1) - 1] + 1, 0))
    end = np.minimum(o[of + 1], edges[k])
    key = wh.mix(wh.span_hashes(b, start, end) ^ wh.mix(of.astype(wh.U) + wh.U(1)))
    _, once = np.unique(key, return_index=True)
    out = {"n_words": n_words, "word_chars": np.diff(points[o]), "n_symbols": np.diff(symbols[o]).astype(np.int64), "n_dup_lines": np.bincount(of, minlength=n) - np.bincount(of[once], minlength=n), "n_repeat_words": wh.per_text(repeat, w.first)}
    out["base_failed"] = (n_words < r.min_words) | (100 * out["n_repeat_words"] > r.max_repeat * n_words)
    # the rules
    lined = np.repeat(np.arange(len(first)), size)
    marked = np.zeros(len(first), np.int64)
    np.add.at(marked, lined[symbols[w.end] > symbols[w.start]], 1)
    bars = _counts(b, _BAR)
    last = w.end[first + size - 1] - 1
    fails = ~_MARK[b[last]] & (size < r.open_words)
    for x in np.flatnonzero(fails & (b[last] >= 128)).tolist():
        fails[x] = not _closed(b, int(last[x]))
    n_bars = bars[end] - bars[start]
    fails |= (n_bars >= r.min_bars) & (size <= r.bar_words * n_bars)
    fails |= marked > r.max_symbol * size
    raw, bounds = b.tobytes(), o.tolist()
    begin = np.searchsorted(of, np.arange(n + 1)).tolist()
    lines_before = np.searchsorted(nl, o[:-1]).tolist()
    for d in range(n):
        if begin[d] == begin[d + 1]:
            continue
        low = plain(raw[bounds[d] : bounds[d + 1]].decode())
        for phrase in r.phrases:
            i = low.find(phrase)
            while i >= 0:
                x = begin[d] + int(np.searchsorted(k[begin[d] : begin[d + 1]], lines_before[d] + low.count("\n", 0, i)))
                fails[x] |= size[x] <= r.phrase_share * (phrase.count(" ") + 1)
                at = low.find("\n", i)  # once a line is enough
                i = low.find(phrase, at) if at >= 0 else -1
    lost = np.bincount(of[fails], size[fails], n).astype(np.int64)
    out["n_lost_words"] = lost
    out["kept"] = ~out["base_failed"] & (lost <= r.max_loss * n_words)
    return out, of[fails], start[fails], end[fails]


def cleaned(docs: DataFrame, rules: Rules = Rules(), with_text: bool = False) -> DataFrame:
    """Figures and verdict of each row of docs (doc_id, text); with_text: the text without its failing lines, as `clean_text`.

    A null or empty text has no words and fails; a very long one is judged whole. Repeated rows and ties are judged each for
    itself, whatever rows stand beside them; other columns are ignored; an empty table gives no rows.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lost_words"]
    kinds = ["boolean" if x in ("base_failed", "kept") else "bigint" for x in names]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, b, o in text_slices(batch.column(1)):
                found, of, start, end = _judge(b, o, rules)
                columns = [batch.column(0).slice(lo, hi - lo), *(pa.array(found[x]) for x in names)]
                if with_text:
                    texts = []
                    for d in range(hi - lo):
                        keep, at = [], int(o[d])
                        for s, e in zip(start[of == d].tolist(), end[of == d].tolist(), strict=True):
                            keep.append(b[at:s].tobytes())
                            at = min(e + 1, int(o[d + 1]))  # with its line end
                        texts.append((b"".join(keep) + b[at : o[d + 1]].tobytes()).decode())
                    columns.append(pa.array(texts, pa.string()))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", *names, *["clean_text"] * with_text])

    schema = "doc_id bigint, " + ", ".join(f"{n} {k}" for n, k in zip(names, kinds, strict=True)) + ", clean_text string" * with_text
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tidy(judge), schema)
