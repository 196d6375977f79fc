"""Main text of web pages: markup where it speaks, a host suffix array where it does not.

A page becomes a row of blocks, each with its place: inside the article, inside an element that
is no main text (menu, header, footer, sidebar, notice, advert, form, comments), or open, if no
element says what it is.  Open blocks are settled by their host: the token streams of its whole
pages, articles included, are concatenated, and long substrings that repeat across distinct
pages are boilerplate.  A block that repeats cover from its first to its last token is removed;
a block with a unique run stays, as repeats reach over block borders into its common first words.
A repeat that stands inside an article of the host, and nowhere in an element that is no main
text, is a copy of that article: what it covers stays, too.

The suffix array is cut at ``repeat`` tokens: suffixes that share that many first tokens meet,
which is where a full array has an LCP of at least ``repeat``.  It is dealt by host and first
tokens, so no host is one task; whether two distinct pages meet is a minimum and a maximum,
pre-aggregated before the shuffle.  Equal pages count as one page.  Groups of hosts
without an open block have nothing that repeats could settle, and send no suffixes.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textforge.llm import arrays
from textforge.storage import materialize


@dataclass(frozen=True)
class PageSettings:
    repeat: int = 8  # tokens


# Elements by their part in a page.
RAW = {"script", "style", "noscript", "template", "iframe", "svg", "math", "object", "canvas", "textarea", "title", "head"}
ASIDE = {"nav", "footer", "aside", "form", "button", "select", "dialog", "menu", "fieldset", "label"}
MAIN = {"article", "main"}
BLOCKS = {"p", "div", "section", "article", "main", "header", "footer", "nav", "aside", "form", "ul", "ol", "li", "dl", "dt", "dd", "table", "tr", "td", "th",
          "thead", "tbody", "tfoot", "caption", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "hr", "br", "figure", "figcaption", "address", "body", "html",
          "details", "summary", "fieldset", "legend", "dialog", "menu", "option", "select", "button", "label", "center", "hgroup", "search"}
CONTAINERS = {"div", "section", "article", "main", "header", "footer", "nav", "aside", "form", "ul", "ol", "dl", "table", "fieldset", "dialog", "menu", "details",
              "blockquote", "select", "button", "label", "center", "search", "span", "body"}
NOISE = {"ad", "ads", "advert", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner", "cookie", "cookies", "consent", "gdpr", "notice",
         "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "paywall", "sidebar", "menu", "nav", "navbar", "navigation",
         "breadcrumb", "breadcrumbs", "pagination", "pager", "footer", "share", "sharing", "social", "related", "recommended", "widget", "comment", "comments",
         "disqus", "respond", "reply", "replies", "toolbar", "masthead", "disclaimer", "copyright", "skip", "login", "search", "tags"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu", "menubar", "alertdialog"}

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<[!?/][^>]*>""", re.S)
_ATTRIBUTE = re.compile(r"""(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_HIDDEN = re.compile(r"""\shidden(?=[\s=/>]|\Z)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_ENDS = {name: re.compile(rf"</{name}\b[^>]*>", re.I) for name in RAW}
_WORDS = re.compile(r"[\s_:-]+")

DROPPED, OPEN, ARTICLE = 0, 1, 2


def _place(name: str, attributes: str, now: int) -> int:
    """The place of an element's text, from that of its parent."""
    if now == DROPPED or name in ASIDE or (name == "header" and now != ARTICLE):
        return DROPPED
    if "=" in attributes or "hidden" in attributes:
        if _HIDDEN.search(attributes):
            return DROPPED
        for key, value in _ATTRIBUTE.findall(attributes):
            value = value.strip("\"'").lower()
            if key.lower() == "role":
                if value in ROLES:
                    return DROPPED
                if value == "main":
                    now = ARTICLE
            elif name not in MAIN and name != "body" and not NOISE.isdisjoint(_WORDS.split(value)):
                return DROPPED
    return ARTICLE if name in MAIN else now


def blocks_of(html: str) -> tuple[list[tuple[int, str]], bool]:
    """(place, text) of a page's blocks in page order, and whether there is an article.

    Texts are decoded, trimmed and not empty.
    """
    out: list[tuple[int, str]] = []
    has_article = False
    stack: list[tuple[str, int]] = []
    held: list[str] = []
    now, at, size = OPEN, 0, len(html)

    def close():
        if held:
            text = " ".join(unescape("".join(held)).split())
            held.clear()
            if text:
                out.append((now, text))

    while at < size:
        found = _TOKEN.search(html, at)
        if not found:
            held.append(html[at:])
            break
        if found.start() > at:
            held.append(html[at : found.start()])
        at = found.end()
        name = found[2]
        if name is None:
            if found[0].startswith("<![CDATA["):
                held.append(found[0][9:-3])
            continue
        name = name.lower()
        if name in RAW:
            if not found[1] and name != "head" and not found[3].endswith("/"):
                end = _ENDS[name].search(html, at)
                at = end.end() if end else size
            continue
        if name in BLOCKS:
            close()
        if name not in CONTAINERS:
            continue
        if found[1]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    now = stack[k][1]
                    del stack[k:]
                    break
        elif not found[3].endswith("/"):
            place = _place(name, found[3], now)
            if place != now:
                close()
            stack.append((name, now))
            now = place
            has_article |= place == ARTICLE
    close()
    return out, has_article


def _page_blocks(html: str) -> list[tuple[int, str]]:
    """Blocks with places settled: beside an article, open blocks are none of the main text."""
    found, has_article = blocks_of(html)
    if has_article:
        return [(DROPPED if place == OPEN else place, text) for place, text in found]
    return found


def _stream(found: list[tuple[int, str]]) -> tuple[list[str], np.ndarray]:
    """(tokens of the whole page, place of each)."""
    words = [text.split() for _, text in found]
    places = np.repeat(np.array([place for place, _ in found], np.int8), [len(w) for w in words])
    return [word for w in words for word in w], places


def _heads(host: str, words: list[str], width: int) -> np.ndarray:
    """Hashes of a host's suffixes, cut at ``width`` tokens."""
    hashed = arrays.hashes(pa.array([host, *words], pa.string()))
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, np.int64)
    value = np.full(n, hashed[0], np.uint64)
    for k in range(width):
        value = arrays.mix(value * np.uint64(0x2545F4914F6CDD1D) + hashed[1 + k : 1 + k + n])
    return value.view(np.int64)


def _within(places: np.ndarray, place: int, width: int) -> np.ndarray:
    """Whether all tokens of each cut suffix have the place."""
    running = np.concatenate([[0], np.cumsum(places == place)])
    return running[width:] - running[:-width] == width


def _page_key(host: str, words: list[str]) -> int:
    """Equal pages of a host share it."""
    return int(arrays.hashes(pa.array(["\0".join([host, *words])], pa.string())).view(np.int64)[0])


_SUFFIX = ["head", "page", "is_open", "article", "dropped"]


def _suffixes(width: int):
    def run(batches):
        for batch in arrays.chunks(batches, "html"):
            parts, seen = [], set()
            for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                words, places = _stream(_page_blocks(html))
                key = _page_key(host, words), bool((places == OPEN).any())
                if len(words) < width or key in seen:
                    continue
                seen.add(key)
                found, at = np.unique(_heads(host, words, width), return_inverse=True)
                marks = [np.bincount(at, weights=_within(places, place, width)) > 0 for place in (ARTICLE, DROPPED)]
                parts.append((found, np.repeat(np.int64(key[0]), len(found)), np.repeat(key[1], len(found)), *marks))
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts)], names=_SUFFIX)

    return run


def _shared(rows: pa.Table) -> pa.RecordBatch:
    """(page, is_open, head, copy): the cut suffixes, sorted by head, that stand on distinct pages; each once for a page."""
    head, page, is_open, article, dropped = (rows.column(c).to_numpy() for c in _SUFFIX)
    starts = np.flatnonzero(np.concatenate([[True], head[1:] != head[:-1]]))
    met = np.minimum.reduceat(page, starts) != np.maximum.reduceat(page, starts)
    copy = np.logical_or.reduceat(article, starts) & ~np.logical_or.reduceat(dropped, starts)
    group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(head))))
    at = np.flatnonzero(met[group])
    at = at[np.lexsort((is_open[at], page[at], group[at]))]
    fresh = np.ones(len(at), bool)
    fresh[1:] = (group[at][1:] != group[at][:-1]) | (page[at][1:] != page[at][:-1]) | (is_open[at][1:] != is_open[at][:-1])
    at = at[fresh]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (page[at], is_open[at], head[at], copy[group[at]])], names=["page", "is_open", "head", "copy"])


def _repeats(batches):
    """_shared of whole groups of rows that come sorted by head."""
    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        held = rows if held is None else pa.concat_tables([held, rows])
        heads = held.column("head").to_numpy()
        cut = int(np.searchsorted(heads, heads[-1])) if len(heads) else 0
        if cut:
            yield _shared(held.slice(0, cut))
            held = held.slice(cut)
    if held is not None and held.num_rows:
        yield _shared(held)


_SETTLED = ["page_id", "url", "host", "page", "is_open", "text"]


def _settled(batches):
    """The rows of pages; text is final unless open blocks are left, and then the html."""
    for batch in arrays.chunks(batches, "html"):
        keys, opens, texts = [], [], []
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            found = _page_blocks(html)
            words, places = _stream(found)
            keys.append(_page_key(host, words))
            opens.append(bool((places == OPEN).any()))
            texts.append(html if opens[-1] else "\n".join(text for place, text in found if place == ARTICLE))
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in _SETTLED[:3]), pa.array(keys, pa.int64()), pa.array(opens, pa.bool_()), pa.array(texts, pa.string())],
                                         names=_SETTLED)


def _covered(heads: np.ndarray, marked: list[int], width: int) -> np.ndarray:
    """Whether each token of a stream lies in a cut suffix with a marked head."""
    starts = np.flatnonzero(np.isin(heads, np.array(marked, np.int64)))
    change = np.zeros(len(heads) + width, np.int64)
    change[starts] += 1
    change[starts + width] -= 1
    return np.cumsum(change)[:-1] > 0


def _unique_runs(found: list[tuple[int, str]], host: str, repeated: list[int], copied: list[int], width: int) -> str:
    words, _ = _stream(found)
    heads = _heads(host, words, width)
    removed = _covered(heads, repeated, width) & ~_covered(heads, copied, width) if len(heads) else np.zeros(len(words), bool)
    out, at = [], 0
    for place, text in found:
        n = len(text.split())
        if place == OPEN and not removed[at : at + n].all():
            out.append(text)
        at += n
    return "\n".join(out)


def _opened(width: int):
    def run(batches):
        for batch in arrays.chunks(batches, "text"):
            columns = (batch.column(c).to_pylist() for c in ("text", "is_open", "host", "repeated", "copied"))
            texts = [_unique_runs(_page_blocks(text), host, repeated or [], copied or [], width) if is_open else text for text, is_open, host, repeated, copied in zip(*columns)]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), batch.column("n_repeated")],
                                             names=["page_id", "url", "text", "n_repeated"])

    return run


def main_texts(pages: DataFrame, s: PageSettings = PageSettings()) -> DataFrame:
    """(page_id, url, text, n_chars, n_repeated) of every row of pages (page_id, url, html).

    A null html or one without main text gives an empty text.  Rows that repeat a page_id are
    rows of their own; a null url has the empty host.  Open pages whose whole stream is repeated
    on other pages of the host are empty, unless it is a copy of their articles.  n_repeated counts
    a page's distinct runs of ``repeat`` tokens, of all its blocks, that other pages of its host hold.
    """
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), host.alias("host"), html.alias("html"))
    suffixes = rows.select("host", "html").mapInArrow(_suffixes(s.repeat), "head long, page long, is_open boolean, article boolean, dropped boolean")
    shared = suffixes.repartition("head").sortWithinPartitions("head").mapInArrow(_repeats, "page long, is_open boolean, head long, copy boolean")
    # Stored, so that the join below has an exchange on either side and equal pages can be split.
    marks = materialize(shared.groupBy("page", "is_open").agg(
        F.count(F.lit(1)).alias("n_repeated"), F.collect_list(F.expr("IF(is_open AND NOT copy, head, NULL)")).alias("repeated"),
        F.collect_list(F.expr("IF(is_open AND copy, head, NULL)")).alias("copied")))
    settled = rows.mapInArrow(_settled, "page_id long, url string, host string, page long, is_open boolean, text string")
    joined = settled.join(marks, ["page", "is_open"], "left").withColumn("n_repeated", F.coalesce("n_repeated", F.lit(0)))
    texts = joined.mapInArrow(_opened(s.repeat), "page_id long, url string, text string, n_repeated long")
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_repeated")
