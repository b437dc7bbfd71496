"""Main text of web pages: markup first, then repetition on the host.

A page is cut into blocks of text, in time linear in its length and once a
page: the blocks are a staged table. Markup decides what it can: blocks inside
``article`` or ``main`` are the text, and blocks inside menus, headers,
footers, sidebars, notices, adverts, forms and comments (nested articles among
them) are not, unless such an element is what holds the page's text. Blocks of
a page without ``article`` or ``main`` are undecided, as are those of the text
whose class or id only hints in part (``related-posts``, ``has-sidebar``).

Then the host decides. The token streams of its pages, all but the blocks of
the text, are concatenated into a suffix array, and a run of words that stands
on distinct contents of the host is boilerplate; what only this page has is its
text. A whole block is a run too, of any length, and these are counted for the
blocks of the text as well: a notice inside the articles of most of a host's
contents goes, an article that was copied stays (see ``Evidence``).

The suffix array is built in every task over the pages it reads, sorted to
the depth of the shortest run that counts, and one row leaves the task for
each interval of suffixes that share that prefix and each content in it; an
aggregate counts the contents over all tasks, so no host is ever gathered in
one place and a host with a third of all pages costs a row per task, run and
content.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, Words, few, mix, signed, slices, staged

#: words of the shortest repeated run that counts as boilerplate
MIN_RUN = 8


@dataclass(frozen=True)
class Evidence:
    """How many of a host's distinct contents must hold a run.

    A run of undecided words goes where ``some`` contents hold it, or more
    than ``most`` of the host's, if those are two at least; so the text of two
    pages that copied each other stays. An undecided block of fewer than
    MIN_RUN words goes where more than ``most`` and at least ``some`` hold it.
    A block of the text, of MIN_RUN words or more, goes only where more than
    ``most`` and at least ``in_text`` contents hold it as a block, and the page
    has a block of its own beside it, of which that is not true.
    """

    some: int = 3
    in_text: int = 5
    most: float = 0.5


_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_EDGE = re.compile("[>\"']")
#: elements whose content is no markup: what closes them; an unclosed script or style takes the rest of the page
_RAW = {t: re.compile(rf"</{t}\s*>", re.I) for t in ("script", "style", "template", "iframe", "textarea", "select", "title")}
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section summary "
    "table tbody td tfoot th thead tr ul caption".split())
_MAIN = frozenset(("article", "main"))
_CHROME = frozenset("head nav header footer aside form menu dialog button search".split())
_OPEN_ENDED = frozenset("p li dt dd".split())
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_HINT = frozenset(
    "ad ads advert advertisement adverts advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "header footer masthead sidebar aside cookie cookies consent notice notices alert popup modal overlay newsletter "
    "subscribe subscription signup login share sharing social comment comments reply replies disqus breadcrumb "
    "breadcrumbs related recommended widget toolbar pagination pager copyright legal disclaimer search form".split())
_ROLE = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
_ATTR = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")


def _hint(tag: str, attrs: str) -> str:
    """chrome, doubt where only a part of a class or id name hints at it, or nothing."""
    if tag in _CHROME:
        return "chrome"
    found = ""
    if not attrs or tag in ("main", "body", "html"):
        return found
    for m in _ATTR.finditer(attrs):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name in ("class", "id"):
            for token in value.split():
                parts = {x for x in re.split(r"[^a-z0-9]+", token) if x}
                if parts and parts <= _HINT:
                    return "chrome"
                if parts & _HINT and tag != "article":
                    found = "doubt"
        if name == "role" and value in _ROLE or name == "hidden":
            return "chrome"
    return found


def _tokens(page: str) -> list[tuple[str, str, str]]:
    """[(kind, tag or text, attributes)], kind one of text, open, close.

    Each part of the page is looked at a fixed number of times: what a search
    did not find is not looked for again.
    """
    out: list[tuple[str, str, str]] = []
    size, at, quoted = len(page), 0, True
    gone: set[str] = set()                           # raw elements that close nowhere below

    def text(lo: int, hi: int) -> None:
        if hi > lo:
            out.append(("text", html.unescape(page[lo:hi]), ""))

    begin = 0                                        # of the text before ``at``
    while (at := page.find("<", at)) >= 0:
        if page.startswith("<!--", at):
            text(begin, at)
            end = page.find("-->", at + 4)
            begin = at = size if end < 0 else end + 3
            continue
        if page.startswith("<![CDATA[", at):
            text(begin, at)
            end = page.find("]]>", at + 9)
            out.append(("text", page[at + 9:size if end < 0 else end], ""))
            begin = at = size if end < 0 else end + 3
            continue
        m = _TAG.match(page, at)
        if not m and page[at + 1:at + 2] not in ("!", "?"):
            at += 1                                  # a bare "<"
            continue
        end = m.end() if m and quoted else page.find(">", at)
        if m and quoted:                             # ">" inside quotes does not close
            while (edge := _EDGE.search(page, end)) and edge[0] != ">":
                shut = page.find(edge[0], edge.end())
                if shut < 0:
                    edge = None
                    break
                end = shut + 1
            if edge:
                end = edge.start()
            else:
                quoted, end = False, page.find(">", at)        # a quote or tag that never closes: from here on the first ">" closes
        if end < 0:
            break                                    # no ">" below: the rest is text
        text(begin, at)
        if m:
            tag = m[2].lower()
            out.append(("close", tag, "") if m[1] else ("open", tag, page[m.end():end].strip("/")))
            if not m[1] and tag in _RAW and tag not in gone:
                shut = _RAW[tag].search(page, end)
                if shut:
                    end = shut.end() - 1
                    out.append(("close", tag, ""))
                elif tag in ("script", "style"):
                    end = size - 1
                else:
                    gone.add(tag)
        begin = at = end + 1
    text(begin, size)
    return out


def _ends(tokens: list[tuple[str, str, str]]) -> list[int]:
    """For each token the first one behind the element that it opens. An
    element that never closes ends before the next article or main element, or
    with the page; p, li, dt and dd end at the next block."""
    n = len(tokens)
    ends, stacks = [0] * n, {}
    main = block = head = n                          # next token that opens a main element, is of a block, ends the head
    later = [0] * n
    for i in range(n - 1, -1, -1):
        kind, tag, _ = tokens[i]
        later[i] = main
        if kind == "open":
            ends[i] = i + 1 if tag in _VOID else head if tag == "head" else block if tag in _OPEN_ENDED else -1
        if kind == "open" and tag in _MAIN:
            main = i
        if kind != "text" and tag in _BLOCK:
            block = i + (kind == "close" and tag in _OPEN_ENDED)
        if (kind, tag) in (("close", "head"), ("open", "body")):
            head = i + (kind == "close")
    for i, (kind, tag, _) in enumerate(tokens):
        if kind == "open" and ends[i] < 0:
            stacks.setdefault(tag, []).append(i)
        elif kind == "close" and stacks.get(tag):
            ends[stacks[tag].pop()] = i + 1
    return [later[i] if e < 0 else e for i, e in enumerate(ends)]


def blocks_of(page: str) -> list[tuple[str, str]]:
    """[(block, where)] of a page in order: white space inside a block is one
    space; ``where`` is main, chrome, doubt (in main, where a name hints in
    part), or open where markup does not tell. Where chrome holds all of the
    article and main elements' text, what holds one is not chrome."""
    tokens = _tokens(page)
    ends = _ends(tokens)
    out, hidden = _blocks(tokens, ends, False)
    if hidden and not any(where in ("main", "doubt", "aside") for _, where in out):
        out, _ = _blocks(tokens, ends, True)
    found = {where for _, where in out}
    # teasers are no text beside an article outside them; chrome inside the text is, if nothing else is
    told = {"aside": "chrome" if found & {"main", "doubt"} else "main", "inner": "chrome" if found & {"main", "doubt", "aside"} else "main"}
    return [(text, told.get(where, where)) for text, where in out]


def _blocks(tokens: list[tuple[str, str, str]], ends: list[int], bare: bool) -> tuple[list[tuple[str, str]], bool]:
    """The blocks, and whether chrome hides an article or main element; with
    ``bare`` none does. A form that holds one wraps the page and never does."""
    out, held, hidden = [], [], False
    main, articles, chrome_until, doubt_until, aside_until = 0, 0, 0, 0, 0
    mains = [i for i, (kind, name, _) in enumerate(tokens) if kind == "open" and name in _MAIN]

    def flush(where: str) -> None:
        if text := " ".join("".join(held).split()):
            out.append((text, where))
        held.clear()

    def at(i: int) -> str:
        if i < chrome_until:
            return "inner" if main else "chrome"
        return "open" if not main else "aside" if i < aside_until else "doubt" if i < doubt_until else "main"

    for i, (kind, name, attrs) in enumerate(tokens):
        where = at(i)
        if chrome_until and i == chrome_until:
            flush("inner" if main else "chrome")
        if doubt_until and i == doubt_until or aside_until and i == aside_until:
            flush(at(i - 1))
        if kind == "text":
            held.append(name)
        elif name == "br":
            held.append(" ")
        else:
            if name in _BLOCK:
                flush(where)
            hint = _hint(name, attrs) if i >= chrome_until and kind == "open" else ""
            if name == "article" and kind == "open" and articles and not bare:
                hint = "chrome"                      # an article in an article is a comment on it
            end = ends[i] if hint else i
            holds = bisect_left(mains, end) > bisect_right(mains, i) or name in _MAIN
            if hint == "chrome" and not (holds and (bare or name == "form")):
                flush(where)
                chrome_until, hidden = end, hidden or holds
            elif hint == "doubt" and main and not holds:
                flush(where)
                doubt_until = max(doubt_until, end)
            elif hint == "doubt" and holds and not main:
                aside_until = max(aside_until, end)
            elif i >= chrome_until and name in _MAIN:
                step = 1 if kind == "open" else -1
                main = max(0, main + step)
                articles = max(0, articles + step * (name == "article"))
    flush(at(len(tokens) - 1))
    return out, hidden


def main_text(page: str) -> str | None:
    """The text inside article or main elements; None if the page has none."""
    blocks = blocks_of(page)
    return " ".join(b for b, where in blocks if where == "main") if any(where == "main" for _, where in blocks) else None


_PARSED = "page_id long, url string, host long, blocks array<string>, kinds array<int>, content long"
#: how a block is taken: not at all, by the host's word runs, as text unless it is a notice of most of the host
_NOT, _OPEN, _TEXT = 0, 1, 2


def _kinds(blocks: list[tuple[str, str]]) -> list[int]:
    any_main = any(where in ("main", "doubt") for _, where in blocks)
    return [_TEXT if where == "main" else _OPEN if where == "doubt" or where == "open" and not any_main else _NOT for _, where in blocks]


def parse(pages: DataFrame) -> DataFrame:
    """(page_id, url, host, blocks, kinds, content) per row of ``pages``
    (page_id, url, host, html). ``content`` hashes what may be text, so copies
    are one content whatever stands around them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                pages_ = [blocks_of(p) for p in part.column("html").to_pylist()]
                kinds = [_kinds(p) for p in pages_]
                texts = pa.array([" ".join(b for (b, _), k in zip(p, ks) if k) for p, ks in zip(pages_, kinds)], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), part.column("host"), pa.array([[b for b, _ in p] for p in pages_], pa.list_(pa.string())),
                     pa.array(kinds, pa.list_(pa.int32())), pa.array(signed(_whole(Words(texts, lower=False))))],
                    ["page_id", "url", "host", "blocks", "kinds", "content"])

    return pages.select("page_id", "url", "host", "html").mapInArrow(run, _PARSED)


def _whole(w: Words) -> np.ndarray:
    """A hash of each row's words in their order, 0 for none."""
    with np.errstate(over="ignore"):
        place = np.arange(len(w.hash)) - np.repeat(w.first[:-1], np.diff(w.first))
        each = mix(w.hash + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(each)])
        return total[w.first[1:]] - total[w.first[:-1]]


def _streams(batch: pa.RecordBatch) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """Of a batch of parsed pages: the words of all blocks, a row each; the
    blocks' pages, kinds and hashes."""
    blocks = batch.column("blocks")
    w = Words(blocks.flatten(), lower=False)
    page = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(blocks.offsets)))
    kinds = np.asarray(batch.column("kinds").flatten())
    return w, page, kinds, _whole(w)


def _page_runs(w: Words, page: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, page, first word) of the MIN_RUN-word runs of each page's stream:
    its blocks that are not text, one after the other."""
    words = np.repeat(kinds != _TEXT, np.diff(w.first))
    hashes, owner = w.hash[words], np.repeat(page, np.diff(w.first))[words]
    out = np.zeros(len(hashes), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(MIN_RUN):
            out[:max(0, len(out) - j)] = out[:max(0, len(out) - j)] * np.uint64(0x9FB21C651E98DF25) + hashes[j:]
    whole = np.zeros(len(out), bool)
    if len(out) >= MIN_RUN:
        whole[:len(out) - MIN_RUN + 1] = owner[MIN_RUN - 1:] == owner[:len(out) - MIN_RUN + 1]
    at = np.flatnonzero(whole)
    first = np.searchsorted(owner, owner[at])
    return mix(out)[at], owner[at], at - first


def counted_runs(parsed: DataFrame) -> DataFrame:
    """(host, run, contents): on how many distinct contents of its host a run
    stands, for the runs that stand on two at least. Every page takes part. A
    run is MIN_RUN words of a stream or a whole block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            host = np.asarray(batch.column("host"))
            content = np.asarray(batch.column("content"))
            w, page, kinds, block = _streams(batch)
            runs, owner, _ = _page_runs(w, page, kinds)
            size = np.diff(w.first)
            counts = (size > 0) & ((kinds == _OPEN) | (kinds == _TEXT) & (size >= MIN_RUN))
            runs, owner = np.concatenate([runs, block[counts]]), np.concatenate([owner, page[counts]])
            # the suffix array to the depth of a run: suffixes by host and first words, an interval's contents together
            order = np.lexsort((content[owner], runs, host[owner]))
            runs, owner = runs[order], owner[order]
            h, c = host[owner], content[owner]
            first = np.concatenate([[True], (runs[1:] != runs[:-1]) | (h[1:] != h[:-1]) | (c[1:] != c[:-1])])[:len(runs)]
            yield pa.RecordBatch.from_arrays([pa.array(h[first]), pa.array(signed(runs[first])), pa.array(c[first])], ["host", "run", "content"])

    rows = parsed.select("host", "blocks", "kinds", "content").mapInArrow(run, "host long, run long, content long")
    return rows.distinct().groupBy("host", "run").agg(F.count("*").alias("contents")).filter("contents > 1")


def extract_main_text(pages: DataFrame, evidence: Evidence = Evidence()) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars.

    A null or empty html has an empty text, as has a page of boilerplate only;
    a null url is a host of its own; repeated rows are one content on the host
    and one result row each; a very long or malformed page takes time in
    proportion to its length and a few times its bytes in a worker; other
    columns are ignored; an empty table gives an empty table.
    """
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"://([^/?#]*)", 1))
    rows = pages.select(
        pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"),
        F.coalesce(pages["html"].cast("string"), F.lit("")).alias("html")).withColumn("host", F.xxhash64(host))
    parsed = staged(parse(rows).withColumn("row", F.monotonically_increasing_id()), "html-blocks")
    sizes = parsed.groupBy("host").agg(F.count_distinct("content").alias("of"))
    runs = staged(counted_runs(parsed), "html-runs")
    most = F.col("contents") > F.col("of") * evidence.most
    by_words = (F.col("contents") >= evidence.some) | most
    by_block = most & (F.col("contents") >= evidence.some)
    in_text = most & (F.col("contents") >= evidence.in_text)
    told = staged(runs.join(few(staged(sizes, "html-hosts")), "host").filter(by_words).select(
        "host", "run", (by_words.cast("int") + 2 * by_block.cast("int") + 4 * in_text.cast("int")).alias("told")), "html-told")

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(row, host, run, at, matters) of what may go: word runs at their place in the page's stream, blocks below zero."""
        for batch in batches:
            w, page, kinds, block = _streams(batch)
            runs, owner, place = _page_runs(w, page, kinds)
            open_page = np.zeros(batch.num_rows, bool)
            open_page[page[kinds == _OPEN]] = True
            runs, owner, place = runs[open_page[owner]], owner[open_page[owner]], place[open_page[owner]]
            size = np.diff(w.first)
            counts = (size > 0) & ((kinds == _OPEN) | (kinds == _TEXT) & (size >= MIN_RUN))
            nth = np.arange(len(page)) - np.searchsorted(page, page)
            matters = np.concatenate([np.ones(len(runs), np.int32), np.where(kinds[counts] == _TEXT, 4, 2).astype(np.int32)])
            runs, owner = np.concatenate([runs, block[counts]]), np.concatenate([owner, page[counts]])
            place = np.concatenate([place, -1 - nth[counts]])
            yield pa.RecordBatch.from_arrays([pa.array(np.asarray(batch.column("row"))[owner]), pa.array(np.asarray(batch.column("host"))[owner]), pa.array(signed(runs)),
                                              pa.array(place, pa.int64()), pa.array(matters)], ["row", "host", "run", "at", "matters"])

    hits = parsed.select("row", "host", "blocks", "kinds").mapInArrow(asked, "row long, host long, run long, at long, matters int").join(few(told), ["host", "run"])
    hits = hits.where(F.col("told").bitwiseAND(F.col("matters")) > 0).groupBy("row").agg(F.collect_list(F.struct("at", "told")).alias("hits"))
    hits = staged(hits, "html-hits")

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [kept_text(*x) for x in zip(*(batch.column(c).to_pylist() for c in ("blocks", "kinds", "hits")))]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    columns, schema = ("page_id", "url", "blocks", "kinds", "hits"), "page_id long, url string, text string"
    if hits.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:       # only pages that lose something are moved
        rows_hit = F.broadcast(hits.select("row"))
        untouched = parsed.join(rows_hit, "row", "left_anti").withColumn("hits", F.lit(None).cast(hits.schema["hits"].dataType))
        touched = parsed.join(rows_hit, "row", "left_semi").join(hits, "row")
        out = untouched.select(*columns).unionAll(touched.select(*columns)).mapInArrow(final, schema)
    else:
        out = parsed.join(hits, "row", "left").select(*columns).mapInArrow(final, schema)
    return out.withColumn("n_chars", F.length("text").cast("long"))


def kept_text(blocks: list[str], kinds: list[int], hits: list[dict] | None) -> str:
    """The text's blocks but notices, and the words of the open blocks that no
    repeated run covers; a block that loses all its words is gone. ``hits``:
    [(at, told)], a word run's place in the page's stream or minus one less a
    block's number; told: 1 word run, 2 block, 4 block of the text."""
    if not hits:
        return " ".join(b for b, k in zip(blocks, kinds) if k)
    whole = {-1 - h["at"]: h["told"] for h in hits if h["at"] < 0}
    words = [b.split(" ") if k == _OPEN else None for b, k in zip(blocks, kinds)]
    sizes = [0 if k == _TEXT else b.count(" ") + 1 for b, k in zip(blocks, kinds)]
    starts = np.cumsum([0, *sizes])
    mark = np.zeros(int(starts[-1]) + MIN_RUN, bool)
    for h in hits:
        if h["at"] >= 0 and h["told"] & 1:
            mark[h["at"]:h["at"] + MIN_RUN] = True
    notice = [k == _TEXT and whole.get(i, 0) & 4 for i, k in enumerate(kinds)]
    own = any(k == _TEXT and not n and b.count(" ") + 1 >= MIN_RUN for b, k, n in zip(blocks, kinds, notice))
    out = []
    for i, (block, kind) in enumerate(zip(blocks, kinds)):
        if kind == _TEXT and not (notice[i] and own):
            out.append(block)
        elif kind == _OPEN and not whole.get(i, 0) & 2:
            marks = _whole_runs(mark[starts[i]:starts[i + 1]])
            out.append(" ".join(x for x, m in zip(words[i], marks) if not m))
    return " ".join(t for t in out if t)


def _whole_runs(mark: np.ndarray) -> np.ndarray:
    """The marks of a block without stretches shorter than a run, which only
    end a run of the next block; a block that is covered whole stays so."""
    if mark.all():
        return mark
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mark.astype(np.int8), [0]])))
    out = np.zeros(len(mark), bool)
    for a, b in zip(edge[::2], edge[1::2]):
        out[a:b] = b - a >= MIN_RUN
    return out
