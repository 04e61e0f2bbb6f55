"""HTML extraction by the runs of words that a host's pages share.

1. A page is read into blocks of text, each with its place: *main* (in
   ``article`` or ``main``), *chrome* (in an element whose tag or class names
   it as menu, header, footer, sidebar, notice, advert, form or comments) or
   *open* (neither).  All blocks, one after another and each behind a boundary
   token, are the page's token stream.
2. A run of at least ``RUN`` tokens that several pages of a host share is a long
   repeated substring.  Such runs, extended as far as they go, cover exactly the
   windows of ``RUN`` tokens that those pages share.  Windows are compared by
   64-bit hashes with the host in them, in two rounds.  First each page sends
   the anchors of its windows, the smallest hash of ``GRAM`` tokens in each: about
   two in nine places, and equal windows have equal anchors.  Then only windows
   whose anchor several pages have are sent, and Spark counts the distinct pages of
   each; the suffixes themselves are not sorted.  Counts are added up per task
   before the shuffle, so a host with a third of all pages sends a menu once per
   task.
3. A block that is wholly covered by runs of enough pages is boilerplate and
   goes: 1 in ``OUTSIDE`` of the host's pages (two at least), or, inside main, 1
   in ``INSIDE`` (three at least).  Pages of a host with the same blocks count as
   one page for each other, so copies keep their text.  Where such blocks are half
   or more of a page's main text, or all of its open text, the page repeats another
   one and the text stays.
4. Repeats cannot tell an advert shown once, so places decide about the rest:
   chrome goes, main stays, and open text stays on pages without main.

What several pages share goes back to the pages as sorted arrays of hashes and
counts while there are at most ``MAX_REPEATED`` of them (16 bytes each); beyond that
they are joined with the pages' keys and reach each page by a join on its id.

Defined cases: null or empty html gives an empty text, a null url is a host of
its own; unclosed and cut-off tags end with the page; rows that repeat a page id
are one page for the repeats and keep their rows; an empty table gives no rows.
A long page costs time and memory in proportion to its length, also if it nests
very deep; a batch of pages is hashed in parts of about ``PART`` characters or one page.
Columns other than the id, url and html are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import html as entities
import re
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import mix, pinned, ship, trimmed
from tidewater.llm.minhash import word_hashes
from tidewater.llm.url_filter import host_and_path

RUN, GRAM, MAX_REPEATED, PART = 12, 4, 4_000_000, 1 << 19
OUTSIDE, INSIDE = 100, 2
U = np.uint64
FACTORS = np.random.default_rng(41).integers(1, 1 << 63, 4, dtype=np.int64).astype(U) | U(1)
BOUNDARY = U(0x9D39247E33776D41)
MAIN, CHROME, OPEN = "main", "chrome", "open"
#: What a chrome name makes of an element until it is known to hold an article;
#: the last two are for names of comments.
NAMED, ASIDE, REPLY = "named", "aside", "reply"
HEADERS = {"header", "masthead"}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>"
    r"|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*(?:>|\Z)|[^<]+|<", re.S)
#: Fixed values of HTML: elements whose text is not shown as text, and those
#: that begin a block of their own.
HIDDEN = {"script", "style", "template", "noscript", "head", "title", "svg", "iframe", "object",
          "canvas", "select", "textarea", "button"}
RAW = {"script", "style", "textarea", "title", "iframe", "noscript"}
BLOCKS = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details",
          "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3",
          "h4", "h5", "h6", "header", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p",
          "pre", "section", "summary", "table", "tbody", "tfoot", "thead", "tr", "ul", "dialog"}
NESTED = {"address", "article", "aside", "blockquote", "details", "dialog", "div", "fieldset",
          "figure", "footer", "form", "header", "main", "menu", "nav", "ol", "section", "table", "ul",
          *(HIDDEN - RAW)}
CHROME_TAGS = {"nav", "footer", "aside", "form", "menu", "dialog"}
#: Elements whose names are read where they stand in a block: those that a new
#: block ends, and those inside a line.
FLOWING = {"p", "li", "dd", "dt", "h1", "h2", "h3", "h4", "h5", "h6"}
INLINE = {"a", "b", "em", "i", "ins", "label", "small", "span", "strong"}
#: Words that name a part other than the article, as a whole class, id or role
#: or as the last part of one (``site-footer``), before any ``SHAPES``.
CHROME_WORDS = {
    "ad", "ads", "advert", "advertisement", "adverts", "alert", "banner", "breadcrumb", "breadcrumbs",
    "comment", "comments", "consent", "cookie", "cookies", "copyright", "disqus", "footer", "form",
    "header", "masthead", "menu", "menubar", "modal", "nav", "navbar", "navigation", "newsletter",
    "notice", "notification", "popup", "promo", "promotion", "related", "replies", "respond", "share",
    "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget"}
#: Of these, those that name a part also as an earlier part of a name.
ANYWHERE = {"advert", "advertisement", "adverts", "breadcrumb", "breadcrumbs", "comment", "comments", "cookie",
            "cookies", "disqus", "newsletter", "promo", "sharing", "sidebar", "signup", "sponsored", "subscribe"}
#: Of these, those whose elements hold articles that are not the page's own.
REPLIES = {"comment", "comments", "disqus", "related", "replies", "respond"}
#: Parts that say how a part looks, and those that only say whether there is one.
SHAPES = {"area", "bar", "block", "bottom", "box", "buttons", "container", "group", "icons", "inner", "item",
          "items", "left", "links", "list", "panel", "posts", "right", "section", "thread", "top", "wrap", "wrapper"}
STATES = {"and", "free", "has", "hide", "is", "no", "non", "not", "show", "with", "without"}
NAMES = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
PARTS = re.compile(r"[a-z]+")


def _whole(part: str) -> list[str]:
    """The part, cut before a shape that is written with it (``commentlist``)."""
    for shape in SHAPES:
        if part.endswith(shape) and part[:-len(shape)] in CHROME_WORDS:
            return [part[:-len(shape)], shape]
    return [part]


@functools.lru_cache(maxsize=4096)
def _chrome_words(attributes: str) -> frozenset[str]:
    """The chrome words that the class, id and role name the element by."""
    found = set()
    for m in NAMES.finditer(attributes):
        for name in (m[1] or m[2] or m[3] or "").lower().split():
            parts = [x for p in PARTS.findall(name) for x in _whole(p)]
            if STATES & set(parts):
                continue
            found |= ANYWHERE & set(parts)
            while len(parts) > 1 and parts[-1] in SHAPES:
                parts.pop()
            if parts and parts[-1] in CHROME_WORDS:
                found.add(parts[-1])
    return frozenset(found)


class Level(NamedTuple):
    """An open element, and what it and those around it make of its content."""
    tag: str
    kind: str
    chrome: bool = False
    own: str = OPEN  # main or reply, by the innermost article or main
    named: bool = False  # a chrome name inside that; outside, it does not make it chrome
    aside: bool = False  # a name of comments anywhere
    hidden: bool = False

    @property
    def place(self) -> str:
        return CHROME if self.chrome or self.named else self.own

    def inside(self, tag: str, kind: str) -> Level:
        own, named = self.own, self.named or kind in (NAMED, ASIDE)
        if kind in (MAIN, REPLY):
            own, named = REPLY if kind == REPLY or self.aside else MAIN, False
        return Level(tag, kind, self.chrome or kind == CHROME, own, named, self.aside or kind == ASIDE,
                     self.hidden or kind == "hidden")


def blocks_of(page: str) -> list[tuple[str, str]]:
    """(place, text) of the page's blocks, in order."""
    out: list[tuple[str, str]] = []
    stack = [Level("", OPEN)]
    open_tags: Counter[str] = Counter()
    words: list[str] = []
    at = 0

    def flush():
        if not words:
            return
        text = " ".join("".join(words).split())
        if text:
            out.append((stack[-1].place, text))
        words.clear()

    def push(tag: str, kind: str):
        stack.append(stack[-1].inside(tag, kind))
        open_tags[tag] += 1

    def pop() -> str:
        tag = stack.pop().tag
        open_tags[tag] -= 1
        return tag

    def kind_of(tag: str, attributes: str) -> str:
        if tag in HIDDEN:
            return "hidden"
        if tag in CHROME_TAGS - {"form"}:
            return CHROME
        named = _chrome_words(attributes) if attributes else frozenset()
        if tag in ("article", "main"):
            return REPLY if named & REPLIES else MAIN
        if stack[-1].place == MAIN:
            named -= HEADERS
        elif tag == "header":
            return CHROME
        return ASIDE if named & REPLIES else NAMED if named or tag == "form" else OPEN

    while m := TOKEN.match(page, at):
        at = m.end()
        tag = m[2] and m[2].lower()
        if not tag:
            if not stack[-1].hidden and (m[0][0] != "<" or m[0] == "<"):
                words.append(entities.unescape(m[0]))
            continue
        opens = not m[1]
        if opens and tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in BLOCKS:
            flush()
            # a new block ends the line and the named paragraph or item before it
            while stack[-1].tag in INLINE or opens and stack[-1].tag in FLOWING and (
                    tag == stack[-1].tag or stack[-1].tag not in ("li", "dd")):
                pop()
        elif tag in ("br", "td", "th"):
            words.append(" ")
        if m[3].endswith("/"):
            continue
        if not opens:
            if open_tags[tag]:
                while pop() != tag:
                    pass
        elif tag in NESTED:
            push(tag, kind_of(tag, m[3]))
        elif tag in FLOWING:
            if m[3] and (kind := kind_of(tag, m[3])) != OPEN:
                push(tag, kind)
        elif tag in INLINE:
            # a named span is left out of its block; those in it are counted
            if open_tags[tag] or m[3] and kind_of(tag, m[3]) != OPEN:
                push(tag, "hidden")
        elif tag == "body":  # ends an unclosed head
            kept = [x for x in stack[1:] if x.kind != "hidden"]
            del stack[1:]
            open_tags.clear()
            for x in kept:
                push(x.tag, x.kind)
    flush()
    # articles among comments are the page's own only where it has no other
    reply = CHROME if any(p == MAIN for p, _ in out) else MAIN
    return [(reply if p == REPLY else p, t) for p, t in out]


def _sliding(h: np.ndarray, size: int) -> np.ndarray:
    """The smallest of each ``size`` neighbours."""
    done = 1
    while done < size:
        step = min(done, size - done)
        h = np.minimum(h[:-step], h[step:])
        done += step
    return h


class Streams:
    """The token streams of some pages, one after another.

    ``owner``: block (of all pages) of each token, -1 for boundaries; ``ends``:
    end of each page's stream; ``page``, ``anchor`` and ``window``: of each
    place where a window lies within one page, page and keys.
    """

    def __init__(self, hosts: list[str], pages: list[list[tuple[str, str]]]):
        # the words of a block are apart by one space; all are hashed at once
        texts = [t for p in pages for _, t in p]
        sizes = np.array([t.count(" ") + 1 for t in texts], dtype=np.int64)
        self.first = np.cumsum([0] + [len(p) for p in pages])  # block of each page
        of_block = np.repeat(np.arange(len(pages)), np.diff(self.first))
        self.ends = np.append(0, np.cumsum(sizes))[self.first[1:]] + self.first[1:] + np.arange(1, len(pages) + 1)
        place = np.arange(sizes.sum()) + np.repeat(np.arange(len(texts)) + of_block + 1, sizes)
        n = int(self.ends[-1])
        self.owner = np.full(n, -1)
        self.owner[place] = np.repeat(np.arange(len(texts)), sizes)
        words = np.full(n, BOUNDARY, dtype=U)
        words[place] = word_hashes(" ".join(texts).encode())
        self.hosts = mix(word_hashes(" ".join("x" + h.replace(" ", "_") for h in hosts).encode()))
        # pages with the same blocks on one host have the same copy
        self.copies = np.array([int.from_bytes(hashlib.blake2b("\n".join([h, *(t for _, t in p)]).encode(),
                                                               digest_size=8).digest(), "little")
                                for h, p in zip(hosts, pages, strict=True)], dtype=U)
        # polynomials over RUN and GRAM words, by windows of 2, 4 and 8 words
        lengths = np.diff(np.append(0, self.ends))
        if n < RUN:
            self.at = np.zeros(0, np.int64)
            self.anchor = self.window = np.zeros(0, U)
        else:
            two = words[:-1] * FACTORS[0] + words[1:]
            four = two[:-2] * FACTORS[1] + two[2:]
            eight = four[:-4] * FACTORS[2] + four[4:]
            whole = np.maximum(lengths - RUN + 1, 0)
            self.at = np.arange(whole.sum()) + np.repeat(self.ends - lengths - (np.cumsum(whole) - whole), whole)
            start = np.repeat(self.hosts, whole)
            self.window = mix(mix(eight[:-4] * FACTORS[3] + four[8:])[self.at] + start)
            self.anchor = mix(_sliding(mix(four), RUN - GRAM + 1)[self.at] + start)
        self.page = np.repeat(np.arange(len(pages)), np.maximum(lengths - RUN + 1, 0))

    def distinct(self, keys: np.ndarray, page: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(key, page) of some windows, each once."""
        new = np.ones(len(keys), dtype=bool)
        new[1:] = (keys[1:] != keys[:-1]) | (page[1:] != page[:-1])
        keys, page = keys[new], page[new]
        order = np.lexsort((keys, page))
        keys, page = keys[order], page[order]
        new = np.ones(len(keys), dtype=bool)
        new[1:] = (keys[1:] != keys[:-1]) | (page[1:] != page[:-1])
        return keys[new], page[new]


def _parts(columns: list[list]):
    """The batch's rows (host, html, ...) in parts of about ``PART`` characters."""
    rows, size = [], 0
    for row in zip(*columns, strict=True):
        rows.append(row)
        size += len(row[1])
        if size >= PART:
            yield rows
            rows, size = [], 0
    if rows:
        yield rows


def main_text(blocks: list[tuple[str, str]], owner: np.ndarray, pages: np.ndarray,
              of_host: int, copies: int) -> tuple[str, int]:
    """(text, tokens covered by repeats); ``pages`` counts those that share each
    window, of the host's ``of_host``; ``copies`` of them have the same blocks."""
    main = np.array([p == MAIN for p, _ in blocks], dtype=bool)
    wanted = main if main.any() else np.array([p == OPEN for p, _ in blocks], dtype=bool)
    gone, repeated = np.zeros(len(blocks), dtype=bool), 0

    def covered(least: int) -> np.ndarray:
        """Tokens of each block in runs that ``least`` pages share."""
        step = np.zeros(len(owner) + 1, dtype=np.int64)
        at = np.flatnonzero(pages >= least)
        step[at] += 1
        step[at + RUN] -= 1
        return np.bincount(owner[(np.cumsum(step)[:-1] > 0) & (owner >= 0)], minlength=len(blocks))

    if pages.max(initial=1) > 1:
        words = np.bincount(owner[owner >= 0], minlength=len(blocks))
        others = of_host - copies + 1
        outside = covered(max(2, -(-others // OUTSIDE)) + copies - 1)
        inside = covered(max(3, -(-others // INSIDE)) + copies - 1)
        gone = np.where(main, inside, outside) >= np.maximum(1, words)
        if main.any() and 2 * words[main & gone].sum() >= words[main].sum() or gone[wanted].all():
            gone &= ~wanted
        repeated = int(covered(2).sum())
    return "\n".join(t for (_, t), w, g in zip(blocks, wanted, gone, strict=True) if w and not g), repeated


def extract(pages: DataFrame, max_repeated: int = MAX_REPEATED) -> DataFrame:
    """Per row: page_id, url, text, n_chars, n_repeated (tokens that repeat on
    other pages of the host)."""
    spark = pages.sparkSession
    ship(spark)
    kind = dict(pages.dtypes)["page_id"]
    # two pages differ if their ids do; a null id is a page of its own
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"),
                        host_and_path(F.col("url"))[0].alias("host"),
                        F.xxhash64(F.coalesce(F.col("page_id").cast("string"), F.lit("null"))).alias("page"))
    once = rows.groupBy("page").count().filter("count > 1").isEmpty()
    none = F.lit(None).cast("array<struct<key:long,n:long>>").alias("keys")

    def keyed(emit, known: DataFrame):
        """(key, page), each once, of what ``emit`` gives for the pages."""
        def task(batches):
            for b in batches:
                for part in _parts([b.column(c).to_pylist() for c in ("host", "html", "page", "keys")]):
                    s = Streams([r[0] for r in part], [blocks_of(r[1]) for r in part])
                    keys, page = emit(s, part)
                    ids = np.array([r[2] for r in part], dtype=np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(ids[page])],
                                                     names=["key", "page"])

        every = known.select("host", "html", "page", "keys").mapInArrow(trimmed(task), "key long, page long")
        return every if once else every.distinct()

    def shared(every: DataFrame):
        """The keys of several pages: (table for the tasks or None, rows with the
        keys of their page)."""
        repeated = pinned(every.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
        if repeated.count() <= max_repeated:
            found = repeated.toArrow()
            order = np.argsort(found["key"].to_numpy())
            return spark.sparkContext.broadcast(_table(found["key"].to_numpy()[order], found["n"].to_numpy()[order])
                                                ), rows.select("*", none)
        per_page = every.join(repeated, "key").groupBy("page").agg(F.collect_set(F.struct("key", "n")).alias("keys"))
        return None, rows.join(per_page, "page", "left")

    def counts(table, part, s: Streams):
        """A function from keys (of windows, by page) to the pages that have them."""
        if table is not None:
            return lambda keys, page: _pages(keys, *table.value)
        tables = [_table(*np.array(sorted((k["key"], k["n"]) for k in r[3] or []), dtype=np.int64).reshape(-1, 2).T)
                  for r in part]

        def look(keys, page):
            cut = np.searchsorted(page, np.arange(len(part) + 1))
            return np.concatenate([_pages(keys[a:b], *t) for t, a, b in zip(tables, cut, cut[1:], strict=False)])
        return look

    def anchors(s: Streams, part):
        return s.distinct(s.anchor, s.page)

    known, joined = shared(keyed(anchors, rows.select("*", none)))

    def windows(s: Streams, part):
        several = counts(known, part, s)(s.anchor, s.page) > 1
        keys, page = s.distinct(s.window[several], s.page[several])
        each = np.arange(len(part))  # the keys of host and copy count pages
        return np.concatenate([keys, s.hosts, s.copies]), np.concatenate([page, each, each])

    table, rows_with = shared(keyed(windows, joined))

    def run(batches):
        for b in batches:
            texts, covered = [], []
            for part in _parts([b.column(c).to_pylist() for c in ("host", "html", "page", "keys")]):
                blocks = [blocks_of(r[1]) for r in part]
                s = Streams([r[0] for r in part], blocks)
                look = counts(table, part, s)
                each = np.arange(len(part))
                found = np.ones(len(s.owner), dtype=np.int64)
                found[s.at] = look(s.window, s.page)
                start = 0
                for k, (end, of_host, copies) in enumerate(zip(
                        s.ends, look(s.hosts, each), look(s.copies, each), strict=True)):
                    owner = s.owner[start:end]
                    owner = np.where(owner < 0, -1, owner - s.first[k])
                    text, n = main_text(blocks[k], owner, found[start:end], int(of_host), int(copies))
                    texts.append(text)
                    covered.append(n)
                    start = end
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64()), pa.array(covered, pa.int64())],
                names=["page_id", "url", "text", "n_chars", "n_repeated"])

    return rows_with.select("page_id", "url", "html", "host", "page", "keys").mapInArrow(
        trimmed(run), f"page_id {kind}, url string, text string, n_chars long, n_repeated long")


def _table(known: np.ndarray, counts: np.ndarray) -> tuple:
    """The sorted keys above one page, their pages, and which top bits occur."""
    shift = U(64 - len(known).bit_length() - 3)
    present = np.zeros(1 << int(U(64) - shift), dtype=bool)
    present[known.view(U) >> shift] = True
    return known, counts, present, shift


def _pages(keys: np.ndarray, known: np.ndarray, counts: np.ndarray, present: np.ndarray, shift) -> np.ndarray:
    """The pages of each key."""
    pages = np.ones(len(keys), dtype=np.int64)
    maybe = np.flatnonzero(present[keys.view(U) >> shift])
    if len(maybe):
        some = keys[maybe].view(np.int64)
        at = np.minimum(np.searchsorted(known, some), len(known) - 1)
        pages[maybe] = np.where(known[at] == some, counts[at], 1)
    return pages
