"""Main text of web pages by consensus of a host: each page scores its containers, pages of a host vote on generalised
tag-class paths, and every page is extracted again by the winning path.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import row_slices, staged, tidy
from .urls import split_url

#: Hosts up to which the table of winning paths is broadcast.
BROADCAST_HOSTS = 200_000
#: Parts into which the pages of each host are dealt where that table isn't broadcast.
SALTS = 64

#: Kinds of elements.
INLINE = frozenset("math semantics mrow mi mo mn ms mtext msup msub mfrac msqrt a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr picture source link meta input".split())
LEAF = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote td th caption figcaption summary address center".split())
VOID = frozenset("hr br img input link meta source wbr area base col embed track param".split())
NEVER = frozenset("nav footer aside form button select option menu dialog head title label fieldset legend noscript canvas object video audio figure-ad".split())
#: Words of class and id names that mark what isn't the article, and what is.
OUTSIDE = frozenset("ad ads adv advert advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice alert newsletter subscribe subscription signup share sharing social related recommended comment comments reply replies respond disqus discussion sidebar widget menu nav navbar navigation breadcrumb breadcrumbs footer header masthead topbar toolbar popup modal overlay login search pager pagination tags copyright legal disclaimer paywall toc skip".split())
FIRST = frozenset("ad ads adv advert banner sponsor promo cookie cookies consent comment comments reply replies sidebar widget menu nav navbar footer header masthead topbar popup modal newsletter social share breadcrumb breadcrumbs".split())
MAIN = frozenset("article content post entry story main body text maincontent".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|template|svg|iframe|textarea|noscript)\b.*?(?:</\1\s*>|\Z)|<(/?)([a-z][a-z0-9:-]*)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-z][a-z0-9:-]*)([^<>]*+)>|<[!?][^>]*+>", re.S | re.I)
NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
HIDDEN = re.compile(r"\bhidden\b|display\s*:\s*none", re.I)


def _names(attributes: str) -> tuple[str, list[str], str]:
    """The first class, generalised; names of class and id; the role."""
    if "=" not in attributes:
        return "", [], ""
    first, words, role = "", [], ""
    for m in NAMES.finditer(attributes):
        value = (m[2] or m[3] or m[4] or "").lower()
        if m[1].lower() == "role":
            role = value
        else:
            words += value.split()
            if m[1].lower() == "class" and value.split():
                first = "." + re.sub(r"\d+", "N", value.split()[0])
    return first, words, role


def _outside(found: list[str]) -> bool:
    """Whether names mark what isn't the article: by a whole name, or, on an element that no name calls the article, by a name's first or last word."""
    names = [[w for w in re.split(r"[^a-z]+", n) if w] for n in found]
    if any(len(n) == 1 and n[0] in OUTSIDE for n in names):
        return True
    return not any(len(n) == 1 and n[0] in MAIN for n in names) and any(n and (n[-1] in OUTSIDE or n[0] in FIRST) for n in names)


def blocks(page: str) -> list[tuple[str, bool, str, int]]:
    """Blocks in page order: container's path, whether it is outside any article by its marks, text, characters in links."""
    out: list[tuple[str, bool, str, int]] = []
    stack: list[tuple[str, str, bool, bool]] = [("", "", False, False)]  # tag, path, outside, in an article
    held: list[str] = []
    linked, link = 0, 0

    def flush() -> None:
        nonlocal linked
        if held:
            text = "".join(held)
            held.clear()
            text = " ".join((entities.unescape(text) if "&" in text else text).split())
            if text:
                out.append((stack[-1][1], stack[-1][2], text, min(linked, len(text))))
        linked = 0

    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            part = page[at : m.start()]
            held.append(part)
            if link:
                linked += len(part)
        at = m.end()
        tag = m[3] or m[6]
        if tag is None:
            continue
        tag, closing, attributes = tag.lower(), m[2] or m[5], m[4] or m[7] or ""
        if tag in INLINE:
            if tag == "a":
                link = 0 if closing else 1
            continue
        if tag == "br":
            held.append(" ")
            continue
        flush()
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
            continue
        if tag in VOID:
            continue
        if stack[-1][0] in ("p", "h1", "h2", "h3", "h4", "h5", "h6") or tag == stack[-1][0] and tag in ("li", "dt", "dd", "td", "th", "tr", "option"):
            stack.pop()
        if tag == "body":  # an open head ends
            while len(stack) > 1 and stack[-1][0] != "html":
                stack.pop()
        _, path, outside, within = stack[-1]
        first, words, role = _names(attributes)
        if not outside:
            outside = tag in NEVER or tag == "header" and not within or role in ("navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert") or (tag not in ("body", "html", "article", "main") and bool(words) and _outside(words)) or bool(attributes and HIDDEN.search(attributes))
        within = within or tag in ("article", "main") or role == "main"
        stack.append((tag, path if tag in LEAF else f"{path}/{tag}{first}", outside, within))
        if attributes.endswith("/") and tag not in LEAF:
            stack.pop()
    if at < len(page):
        rest = page[at:]
        cut = re.search(r"<[a-z/!][^>]*\Z", rest, re.I)  # a tag that the page's end cuts
        held.append(rest[: cut.start()] if cut else rest)
    flush()
    return out


def article_path(path: str) -> str:
    """The path up to its first element of an article, else the whole."""
    parts = path.split("/")
    for k, part in enumerate(parts):
        tag, _, name = part.partition(".")
        if tag in ("article", "main") or name and not MAIN.isdisjoint(re.split(r"[^a-z]+", name)):
            return "/".join(parts[: k + 1])
    return path


def scores(found: list[tuple[str, bool, str, int]]) -> dict[str, float]:
    """Of each path that holds blocks: its score, by the length of text outside links."""
    out: dict[str, float] = defaultdict(float)
    for path, outside, text, linked in found:
        out[path] += 0 if outside else max(0, len(text) - 3 * linked)
    return out


def _under(path: str, root: str) -> bool:
    return path == root or path.startswith(root + "/")


def main_text(found: list[tuple[str, bool, str, int]], winner: str | None) -> str:
    """Blocks under the host's winning path, or where the page has none under the page's own best."""
    kept = [x for x in found if winner is not None and not x[1] and _under(x[0], winner)]
    if not kept:
        own = scores(found)
        best = max(own, key=own.__getitem__, default=None)
        if best is None or own[best] <= 0:
            return ""
        kept = [x for x in found if not x[1] and _under(x[0], article_path(best))]
    return "\n".join(x[2] for x in kept)


def extracted(pages: DataFrame) -> DataFrame:
    """Main text of each row of pages (page_id, url, html).

    Null or empty html gives an empty text; a page without a host (null url) votes among such pages. Ties between paths
    go to the first by name. Repeated rows vote and return each; very long pages are read whole; other columns are ignored; no pages give no rows.
    What a page's article holds doesn't depend on how many pages its host has.
    Votes are summed by host and path before they meet, so a host with any share of the pages is a few rows.
    """
    rows = pages.select(F.col("page_id").cast("long"), "url", "html")

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in row_slices(whole, whole.column(1))):
            found: list[list] = [[], [], []]
            for url, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                host = split_url(url)[0]
                for path, score in scores(blocks(page or "")).items():
                    for c, x in zip(found, (host, path, score), strict=True):
                        c.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(found, (pa.string(), pa.string(), pa.float64()), strict=True)], ["host", "path", "score"])

    votes = rows.select("url", "html").mapInArrow(tidy(vote), "host string, path string, score double")
    paths = votes.groupBy("host", "path").agg(F.sum("score").alias("score"))
    positive = F.col("score") > 0
    winner = F.max_by(F.when(positive, F.col("path")), F.when(positive, F.struct("score", "path")))
    hosts = staged(paths.groupBy("host").agg(winner.alias("winner")))
    host = F.expr(r"case when instr(url, '://') > 0 then translate(regexp_extract(substr(url, instr(url, '://') + 3), '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') else '' end")
    named = rows.withColumn("host", F.coalesce(host, F.lit("")))
    if hosts.count() <= BROADCAST_HOSTS:
        joined = named.join(F.broadcast(hosts), "host", "left")
    else:  # a host's pages are dealt over SALTS parts, each of which gets the host's row
        salted = hosts.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = named.withColumn("__salt", F.expr(f"cast(pmod(xxhash64(url, page_id), {SALTS}) as int)")).join(salted, ["host", "__salt"], "left")
    joined = joined.select("page_id", "url", "html", "winner")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in row_slices(whole, whole.column(2)):
                texts = []
                for page, winner in zip(*(batch.column(k).to_pylist() for k in (2, 3)), strict=True):
                    texts.append(main_text(blocks(page or ""), None if winner is None else article_path(winner)))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return joined.mapInArrow(tidy(extract), "page_id bigint, url string, text string, n_chars bigint")
