"""Helpers shared by the operators: staged tables, batches, word hashes.

Words are ``[^\\x20\\x09-\\x0D]+`` throughout. In UTF-8 those separators are
single bytes that never occur inside another character, so a word can be cut
and hashed on the Arrow buffer itself, without a Python object per word.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: bytes of text that a task turns into numpy arrays at a time
CHUNK_BYTES = 1 << 20

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back: cuts the
    lineage, survives lost executors, and is computed once."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_column(df: DataFrame, name: str = "text") -> F.Column:
    """The text column with null as the empty text."""
    return F.coalesce(df[name].cast("string"), F.lit(""))


#: most rows and bytes of a table that is broadcast
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 << 20


def _bytes(rows: DataFrame) -> F.Column:
    """About how many bytes a row takes; what an array holds counts by its length."""
    total = F.lit(16)
    for f in rows.schema.fields:
        kind = f.dataType.typeName()
        size = F.octet_length(f.name) if kind in ("string", "binary") else F.size(f.name) * 24 if kind in ("array", "map") else F.lit(8)
        total = total + 8 + F.greatest(F.coalesce(size, F.lit(0)), F.lit(0))
    return total.cast("long")


def few(rows: DataFrame) -> DataFrame:
    """``rows`` marked for broadcast if a look at them shows that they are few
    and small; beyond that the join shuffles. Meant for staged tables."""
    n, size = rows.limit(BROADCAST_ROWS + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(_bytes(rows)), F.lit(0))).first()
    return F.broadcast(rows) if n <= BROADCAST_ROWS and size <= BROADCAST_BYTES else rows


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores before it one that ``df`` has no column of."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def once(df: DataFrame, name: str, value: F.Column) -> DataFrame:
    """``df`` with the column ``value``, computed once a row however often it
    is used above: the optimizer copies a projected expression into each of
    its uses, but not one that a generator yields."""
    return df.select("*", F.explode(F.array(value)).alias(name))


#: glibc's; None elsewhere
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Freed memory goes back to the system. Workers are reused, and idle ones
    would keep it while others of the same executor need it."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def slices(batch: pa.RecordBatch, column: str | int = "text", most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``most`` bytes of text each; a longer text
    is a part of its own. No row is left out. After the last part, what the
    parts took and freed is given back."""
    if not batch.num_rows:
        return
    at = np.frombuffer(batch.column(column).buffers()[1], np.int32, batch.num_rows + 1 + batch.column(column).offset)
    at = at[batch.column(column).offset:].astype(np.int64)
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + most, "right")) - 1)
        hi = min(hi, batch.num_rows)
        yield batch.slice(lo, hi - lo)
        lo = hi
    give_back()


def utf8(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string array without nulls."""
    n, off = len(arr), arr.offset
    bufs = arr.buffers()
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(bufs[1], np.int32, off + n + 1)[off:].astype(np.int64)
    size = int(at[-1] - at[0])
    data = np.frombuffer(bufs[2], np.uint8, size, int(at[0])) if size else np.zeros(0, np.uint8)
    return data, at - at[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
with np.errstate(over="ignore"):
    _BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _POWER = np.cumprod(np.full(1 << 12, 0xD1342543DE82EF97, np.uint64))


def _powers(n: int) -> np.ndarray:
    global _POWER
    if n > len(_POWER):
        _POWER = np.cumprod(np.full(n, 0xD1342543DE82EF97, np.uint64))
    return _POWER


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hashes of the non-empty byte spans [start, end), given in order."""
    out = np.zeros(len(start), np.uint64)
    lo = 0
    with np.errstate(over="ignore"):
        while lo < len(out):
            hi = max(lo + 1, int(np.searchsorted(start, start[lo] + (1 << 20))))
            size = end[lo:hi] - start[lo:hi]
            first = np.cumsum(size) - size
            inside = np.arange(int(size.sum())) - np.repeat(first, size)
            b = data[np.repeat(start[lo:hi], size) + inside]
            if lower:
                b = _LOWER[b]
            out[lo:hi] = mix(np.add.reduceat(_BYTE[b] * _powers(int(size.max()))[inside], first) + size.astype(np.uint64))
            lo = hi
    return out


class Words:
    """The words of a string array: ``start``/``end`` byte positions, 64-bit
    ``hash`` of each, and ``first``: row r has words first[r]:first[r+1]."""

    def __init__(self, arr: pa.Array, lower: bool, hashed: bool = True):
        self.data, self.at = utf8(arr)
        space = _SPACE[self.data]
        edge = np.zeros(len(space) + 1, bool)
        edge[self.at] = True
        word = ~space
        before = np.concatenate([[False], word[:-1]]) if len(word) else word
        after = np.concatenate([word[1:], [False]]) if len(word) else word
        self.start = np.flatnonzero(word & (~before | edge[:-1]))
        self.end = np.flatnonzero(word & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.start, self.at)
        if hashed:
            self.hash = span_hashes(self.data, self.start, self.end, lower)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash of the n words from each word on, whether they lie in one row)."""
        m = len(self.hash)
        out = np.zeros(m, np.uint64)
        with np.errstate(over="ignore"):
            for j in range(n):
                out[: max(0, m - j)] = out[: max(0, m - j)] * np.uint64(0x9FB21C651E98DF25) + self.hash[j:]
        last = np.repeat(self.first[1:], np.diff(self.first))
        return mix(out), np.arange(m) + n <= last


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
