"""Fill-in-the-middle: a text's segments change places inside one bytearray.

A text is cut at two line ends into prefix, middle and suffix. The sentinels
are inserted at the cuts, which gives ``<P>prefix<M>middle<S>suffix``, and two
neighbouring blocks are exchanged by a rotation: both are reversed, then the
two together, which leaves either block readable and the blocks exchanged. One
rotation gives the psm form ``<P>prefix<S>suffix<M>middle``, a second one of
the first two blocks the spm form ``<S>suffix<P>prefix<M>middle``. To restore
a text the sentinels are found, the rotations undone in reverse order and the
sentinels cut out. Reversals swap bounded parts from both ends, so a text takes
its own size once, whatever its length.

Each row depends on its id and text only: one scan, nothing is shuffled, and a
lost task is simply run again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import slices, text_column

PLAIN, PSM, SPM = "plain", "psm", "spm"
#: bytes that a reversal swaps at a time
_SWAP = 1 << 16


@dataclass(frozen=True)
class Recipe:
    """``rate`` of 100 texts are transformed, ``spm`` of 100 of those to the
    spm form; ``seed`` and the document's id decide which, and where to cut."""

    seed: int = 7
    rate: int = 100
    spm: int = 50
    prefix: bytes = b"<P>"
    suffix: bytes = b"<S>"
    middle: bytes = b"<M>"

    def __post_init__(self):
        if len({self.prefix, self.suffix, self.middle}) < 3 or not all((self.prefix, self.suffix, self.middle)):
            raise ValueError("the sentinels must be three different strings")
        for mark in (self.prefix, self.suffix, self.middle):
            # a sentinel that overlaps another could be found across a cut
            for other in (self.prefix, self.suffix, self.middle):
                if any(mark[-k:] == other[:k] for k in range(1, min(len(mark), len(other)) + (mark != other))):
                    raise ValueError("no sentinel may end as another begins")

    def draws(self, doc_id: int | None) -> tuple[int, int, int, int]:
        digest = hashlib.sha256(f"{self.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
        return tuple(int(digest[8 * i:8 * i + 8], 16) for i in range(4))


def reverse(buf: np.ndarray, lo: int, hi: int) -> None:
    """buf[lo:hi] backwards, in place."""
    while hi - lo > 1:
        k = min(_SWAP, (hi - lo) // 2)
        head = buf[lo:lo + k].copy()
        buf[lo:lo + k] = buf[hi - k:hi][::-1]
        buf[hi - k:hi] = head[::-1]
        lo, hi = lo + k, hi - k


def exchange(buf: bytearray, lo: int, mid: int, hi: int) -> int:
    """Exchanges the blocks [lo, mid) and [mid, hi) by three reversals, in
    place; returns where the second block then begins."""
    view = np.frombuffer(buf, np.uint8)
    reverse(view, lo, mid)
    reverse(view, mid, hi)
    reverse(view, lo, hi)
    return lo + hi - mid


def line_ends(data: bytes) -> np.ndarray:
    """End of each unit ``[^\\n]*\\n|[^\\n]+``."""
    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 0x0A) + 1
    return np.append(ends, len(data)) if data and data[-1] != 0x0A else ends


def code_points(data: bytes | bytearray | memoryview) -> int:
    """Characters of UTF-8 bytes: all but the continuation bytes count."""
    return int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80))


def transform(doc_id: int | None, data: bytes, recipe: Recipe) -> tuple[bytes, str, int, int | None, int | None]:
    """(output, form, units, code points of prefix and of middle)."""
    ends = line_ends(data)
    n = len(ends)
    h1, h2, h3, h4 = recipe.draws(doc_id)
    if not data or h3 % 100 >= recipe.rate or any(m in data for m in (recipe.prefix, recipe.suffix, recipe.middle)):
        return data, PLAIN, n, None, None
    one, two = sorted((h1 % (n + 1), h2 % (n + 1)))
    a = int(ends[one - 1]) if one else 0
    b = int(ends[two - 1]) if two else 0
    buf = bytearray(data)
    buf[b:b] = recipe.suffix
    buf[a:a] = recipe.middle
    buf[0:0] = recipe.prefix
    first = len(recipe.prefix) + a                                   # begin of the middle's block
    second = first + len(recipe.middle) + b - a                      # begin of the suffix's block
    third = exchange(buf, first, second, len(buf))
    form = PSM
    if h4 % 100 < recipe.spm:
        exchange(buf, 0, first, third)
        form = SPM
    view = memoryview(data)
    return bytes(buf), form, n, code_points(view[:a]), code_points(view[a:b])


def restore(output: bytes, form: str, recipe: Recipe) -> bytes:
    """The text of an output and its form."""
    if form == PLAIN:
        return output
    buf = bytearray(output)
    last = output.index(recipe.middle)
    if form == SPM:                                                  # the rotations in reverse order
        first = exchange(buf, 0, output.index(recipe.prefix), last)
    else:
        first = output.index(recipe.suffix)
    second = exchange(buf, first, last, len(buf))
    del buf[second:second + len(recipe.suffix)]
    del buf[first:first + len(recipe.middle)]
    del buf[:len(recipe.prefix)]
    return bytes(buf)


def _mapped(batches: Iterator[pa.RecordBatch], text: str, row: Callable, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, text):
            cols = list(zip(*(row(*x) for x in zip(*(_values(c) for c in part.columns)))))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


def _values(column: pa.Array) -> list:
    """Python values; strings as their UTF-8 bytes."""
    return column.cast(pa.binary()).to_pylist() if pa.types.is_string(column.type) else column.to_pylist()


def fill_in_middle(docs: DataFrame, recipe: Recipe = Recipe()) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) per row of
    ``docs`` (doc_id, text): its number of lines, the form, and the output.

    A null text is empty, and an empty text is plain; a null id stays null and
    draws as the empty string; rows that share an id are cut alike, each on its
    own; a text without a line end is one unit; a very long text takes three
    times its bytes in a worker (input, buffer, output); other columns are
    ignored, whatever their names; no rows give no rows. In the plain form
    prefix_chars and middle_chars are null.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()),
                        ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())])

    def row(doc_id: int | None, data: bytes) -> tuple:
        output, form, n, prefix, middle = transform(doc_id, data, recipe)
        return doc_id, n, form, prefix, middle, output.decode()

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_column(docs).alias("text")).mapInArrow(
        lambda batches: _mapped(batches, "text", row, schema),
        "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restore_texts(outputs: DataFrame, recipe: Recipe = Recipe()) -> DataFrame:
    """``outputs`` with the column ``restored``: the text rebuilt from the
    columns ``output`` and ``form`` alone. All columns of ``outputs`` are kept
    but one named ``restored``, which is replaced; a null form or output gives
    a null text."""
    outputs = outputs.drop("restored")
    from pyspark.sql.types import StringType, StructField, StructType
    schema = StructType([*outputs.schema.fields, StructField("restored", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "output"):
                texts = [None if o is None or f is None else restore(o, f.decode(), recipe).decode()
                         for o, f in zip(_values(part.column("output")), _values(part.column("form")))]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, "restored"])

    return outputs.mapInArrow(run, schema)
