"""Quality rules: counts of a text, and repetition from a suffix array.

The words of the texts of a slice are concatenated with each text as its own
alphabet, so one numpy suffix array (prefix doubling, re-ranking only the
suffixes that still share a rank) serves many texts and no suffix runs into
the next text. The longest common prefix of neighbours gives every suffix the
length of the longest repeat that starts there; the union of those spans is
the covered part of the text. Everything about a text is decided from that
text, so the job is one scan without a shuffle; memory is bounded by the
slice, or by the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, mix, slices, span_hashes, text_column

#: shortest repeat that counts, in words
MIN_REPEAT = 8
#: largest share of a text's words inside such repeats
MAX_COVERED = 0.40
#: longest repeat allowed, in words
MAX_REPEAT = 100

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat")
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def suffix_repeats(keys: np.ndarray, last: np.ndarray) -> np.ndarray:
    """For each position the length of the longest run from it that also
    starts at another position of its row. ``keys`` differ between rows;
    ``last[i]`` is the end of the row of position i."""
    n = len(keys)
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    rank = np.unique(keys, return_inverse=True)[1].astype(np.int64) + 1
    count = np.bincount(rank, minlength=n + 2)
    active = np.flatnonzero(count[rank] > 1)
    levels = [(1, rank)]
    step = 1
    while len(active):
        nxt = active + step
        tail = np.where(nxt < last[active], rank[np.minimum(nxt, n - 1)], 0)
        order = np.lexsort((tail, rank[active]))
        a, h, t = active[order], rank[active][order], tail[order]
        fresh = np.ones(len(a), bool)
        fresh[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
        head = np.ones(len(a), bool)
        head[1:] = h[1:] != h[:-1]
        # a group of rank r owns the ranks r .. r + size - 1, unused by others
        where = np.arange(len(a))
        of_head = np.maximum.accumulate(np.where(head, where, 0))
        of_fresh = np.maximum.accumulate(np.where(fresh, where, 0))
        if step == 1:
            rank = _spread(rank, n)
            levels = [(1, rank)]
            h = rank[a]
        new = rank.copy()
        new[a] = h + of_fresh - of_head
        rank = new
        step *= 2
        levels.append((step, rank))
        same = np.zeros(len(a), bool)
        same[1:] |= ~fresh[1:]
        same[:-1] |= ~fresh[1:]
        active = np.sort(a[same])
    if len(levels) == 1:
        return out
    suffixes = np.argsort(rank, kind="stable")
    left, right = suffixes[:-1].copy(), suffixes[1:].copy()
    common = np.zeros(n - 1, np.int64)
    for length, r in reversed(levels):
        inside = (left + common < last[left]) & (right + common < last[right])
        i, j = np.where(inside, left + common, 0), np.where(inside, right + common, 0)
        common += np.where(inside & (r[i] == r[j]), length, 0)
    out[left] = common
    out[right] = np.maximum(out[right], common)
    return out


def _spread(rank: np.ndarray, n: int) -> np.ndarray:
    """Ranks renumbered so that a group of size s is followed by s - 1 unused ranks."""
    count = np.bincount(rank, minlength=n + 2)
    first = np.cumsum(count) - count + 1
    return first[rank]


def _by_row(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[at[1:]] - total[at[:-1]]


def text_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """The figures of COUNTS for each text of an array without nulls."""
    w = Words(texts, lower=False)
    data, at, first = w.data, w.at, w.first
    rows, n = len(at) - 1, len(w.start)
    row = np.repeat(np.arange(rows), np.diff(first))
    last = np.repeat(first[1:], np.diff(first))
    space = np.isin(data, np.array([0x20, *range(0x09, 0x0E)], np.uint8))
    out = {"n_words": np.diff(first), "word_chars": _by_row(~space & ((data & 0xC0) != 0x80), at),
           "n_symbols": _by_row(_SYMBOL[data], at)}
    with np.errstate(over="ignore"):
        salt = mix(np.arange(1, rows + 1, dtype=np.uint64))
        out["n_dup_lines"] = _dup_lines(data, at, w.start, salt)
        # words inside 3-word windows found twice or more in the text
        grams, whole = w.grams(3)
        window = np.flatnonzero(whole)
        keys = mix(grams[window] ^ salt[row[window]])
        _, inverse, count = np.unique(keys, return_inverse=True, return_counts=True)
        hit = window[count[inverse] > 1]
        mark = np.zeros(n + 3, bool)
        for j in range(3):
            mark[hit + j] = True
        out["n_repeat_words"] = _by_row(mark[:n], first)
        reach = suffix_repeats(mix(w.hash ^ salt[row]), last)
    edge = np.zeros(n + 1, np.int64)
    long = np.flatnonzero(reach >= MIN_REPEAT)
    np.add.at(edge, long, 1)
    np.add.at(edge, long + reach[long], -1)
    out["covered_words"] = _by_row(np.cumsum(edge)[:n] > 0, first)
    longest = np.zeros(rows, np.int64)
    np.maximum.at(longest, row, reach)
    out["longest_repeat"] = longest
    return out


def _dup_lines(data: np.ndarray, at: np.ndarray, word_start: np.ndarray, salt: np.ndarray) -> np.ndarray:
    cut = np.flatnonzero(data == 0x0A)
    start = np.unique(np.concatenate([at[:-1], cut + 1]))
    start = start[start < len(data)]
    if not len(start):                          # empty texts only
        return np.zeros(len(at) - 1, np.int64)
    end = np.append(start[1:], len(data))
    end = end - (data[end - 1] == 0x0A)
    has = np.searchsorted(word_start, end) > np.searchsorted(word_start, start)
    start, end = start[has], end[has]
    row = np.searchsorted(at, start, "right") - 1
    keys = mix(span_hashes(data, start, end) ^ salt[row])
    _, kept = np.unique(keys, return_index=True)
    again = np.ones(len(keys), bool)
    again[kept] = False
    return np.bincount(row[again], minlength=len(at) - 1)


def verdict(c: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(base_failed, kept) of each text."""
    n = c["n_words"]
    failed = (n < 50) | (100 * c["n_repeat_words"] > 50 * n)
    kept = ~failed & (c["covered_words"] <= MAX_COVERED * n) & (c["longest_repeat"] <= MAX_REPEAT)
    return failed, kept


def quality_report(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): the counts, ``base_failed``
    and ``kept``. A null text counts as empty; an empty text has no words and
    fails; repeated rows and ids are judged row by row; other columns are
    ignored; an empty table gives an empty table."""
    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, kept boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                c = text_counts(part.column("text"))
                failed, kept = verdict(c)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(c[k], pa.int64()) for k in COUNTS), pa.array(failed), pa.array(kept)],
                    ["doc_id", *COUNTS, "base_failed", "kept"])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_column(docs).alias("text")).mapInArrow(run, schema)


def quality_filter(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``quality_report`` keeps, with all columns."""
    names = docs.columns
    place = [c.lower() for c in names].index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place).cast(pa.string()).fill_null("")
            for part in slices(pa.RecordBatch.from_arrays([texts, *batch.columns], ["", *names]), 0):
                _, kept = verdict(text_counts(part.column(0)))
                yield pa.RecordBatch.from_arrays(part.columns[1:], names).filter(pa.array(kept))

    return docs.mapInArrow(run, docs.schema)
