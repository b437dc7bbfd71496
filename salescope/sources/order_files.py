"""Order files read by column name, with read errors as rows.

Every store sends its own files: some with a title above the header, some with
columns in another order or with more of them. A file is read by the labels in
its own header line; what else it holds is ignored. A file that cannot be read
to its end, is no UTF-8, lacks a required label or has a line of another width
than its header yields one row that says so and none of its lines; all other
files are read whole.

The listing is Spark's; a file is a task, or part of one. A task reads a file twice,
both times a bounded part at a time: first to its end, to know that it is
whole, then again for its rows. So nothing is checkpointed or joined back, a
large file takes no more memory than a small one, and a lost task is run again.
"""

from __future__ import annotations

import codecs
import csv
import io
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import csv as pacsv
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import RAW_ORDER_COLS
from .storage import file_system

#: lines of a file among which its header is looked for
HEADER_WITHIN = 2
#: tasks that files are dealt to, at most
MOST_TASKS = 10_000
#: bytes parsed at a time; a file with a longer line is read by the larger blocks, in which a line must fit
_BLOCK, _MOST_BLOCK = 2 << 20, 8 << 20
#: bytes in which the header must lie
_HEAD = 1 << 20


class Rejected(Exception):
    """Why a file is not taken; ``bad_lines`` of another width than the header."""

    def __init__(self, reason: str, bad_lines: int = 0):
        super().__init__(reason)
        self.reason, self.bad_lines = reason, bad_lines


def _open(path: str):
    fs, at = file_system(path)
    return fs.open_input_stream(at, compression="gzip" if at.endswith(".gz") else "bz2" if at.endswith(".bz2") else None)


def header_of(head: bytes, labels: list[str], within: int = HEADER_WITHIN) -> tuple[int, int, list[int]]:
    """(lines above the header, width, position of each label) of a file that
    begins with ``head``: the first of its lines that holds all labels. Of
    labels that occur twice the first counts."""
    text = codecs.getincrementaldecoder("utf-8-sig")().decode(head)
    lines = [[c.strip() for c in row] for _, row in zip(range(within), csv.reader(io.StringIO(text)))]
    for i, cells in enumerate(lines):
        if all(x in cells for x in labels):
            return i, len(cells), [cells.index(x) for x in labels]
    best = max(lines, key=lambda cells: sum(x in cells for x in labels), default=[])
    raise Rejected("lacks " + ", ".join(x for x in labels if x not in best))


class _LongLine(Exception):
    """A line is longer than a block."""


def read_file(path: str, labels: list[str], emit: bool, within: int = HEADER_WITHIN, block: int = _BLOCK) -> Iterator[pa.RecordBatch]:
    """The cells under ``labels`` of one file, as text; an empty cell is null,
    a quoted empty one is empty. Raises ``Rejected``; without ``emit`` only
    the whole file is checked and batches without columns are counted. The
    reader holds some tens of blocks ahead of the one that it gives; a line
    longer than ``block`` raises ``_LongLine``."""
    try:
        with _open(path) as f:
            above, width, at = header_of(f.read(_HEAD), labels, within)
        bad = []
        names = [f"c{i}" for i in range(width)]
        wanted = [names[i] for i in at]
        f = _open(path)
        try:
            reader = pacsv.open_csv(
                f, pacsv.ReadOptions(use_threads=False, block_size=block, skip_rows=above + 1, column_names=names),
                pacsv.ParseOptions(newlines_in_values=True, invalid_row_handler=lambda row: bad.append(row.number) or "skip"),
                pacsv.ConvertOptions(column_types=dict.fromkeys(names, pa.string()), include_columns=wanted if emit else names[:1] if not wanted else wanted,
                                     strings_can_be_null=True, null_values=[""], quoted_strings_can_be_null=False))
        except pa.ArrowInvalid as e:
            if "Empty CSV" in str(e):
                return
            raise
        with f, reader:
            for batch in reader:
                yield batch
        if bad:
            raise Rejected(f"{len(bad)} lines are not as wide as the header", len(bad))
    except UnicodeDecodeError:
        raise Rejected("no UTF-8") from None
    except (pa.ArrowException, OSError, EOFError) as e:
        text = str(e)
        if "straddling object" in text and block < _MOST_BLOCK:
            raise _LongLine from None
        raise Rejected("no UTF-8" if "UTF8" in text or "utf-8" in text.lower() else f"cannot be read: {text.splitlines()[0][:200] if text else type(e).__name__}") from None


@dataclass
class OrderFiles:
    """``rows`` of the files that were taken, and ``files``: one row for each
    file (source_file, rows, bad_lines, reason; no reason: taken)."""

    rows: DataFrame
    files: DataFrame

    def rejected(self) -> DataFrame:
        return self.files.where(F.col("reason").isNotNull())


def read_named_orders(spark: SparkSession, path: str, *, columns: list[str] = RAW_ORDER_COLS, labels: dict[str, str] | None = None,
                      glob: str | None = None, recursive: bool = False, within: int = HEADER_WITHIN) -> OrderFiles:
    """Every file under ``path`` by its own header. ``labels`` maps a column's
    name to the label that the files give it, where that is another."""
    wanted = [(labels or {}).get(c, c) for c in columns]
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    # the names that Spark's own listing of the folder holds; no file is opened for it
    names = sorted(unquote(f) for f in reader.load(path).inputFiles())
    listing = spark.createDataFrame([(f,) for f in names], "source_file string").repartition(max(1, min(len(names), MOST_TASKS)))
    cells = pa.schema([("source_file", pa.string()), *[(c, pa.string()) for c in columns]])

    def whole(file: str) -> tuple[int, Rejected | None, int]:
        block = _BLOCK
        while True:
            n = 0
            try:
                for batch in read_file(file, wanted, False, within, block):
                    n += batch.num_rows
            except Rejected as e:
                return 0, e, block
            except _LongLine:
                block = _MOST_BLOCK
                continue
            return n, None, block

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0).to_pylist():
                n, why, block = whole(file)
                if n and not why:
                    for part in read_file(file, wanted, True, within, block):
                        yield pa.RecordBatch.from_arrays([pa.array([file] * part.num_rows, pa.string()), *part.columns], schema=cells)

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0).to_pylist():
                n, why, _ = whole(file)
                yield pa.RecordBatch.from_pylist([{"source_file": file, "rows": n, "bad_lines": why.bad_lines if why else 0, "reason": why and why.reason}],
                                                 schema=pa.schema([("source_file", pa.string()), ("rows", pa.int64()), ("bad_lines", pa.int64()), ("reason", pa.string())]))

    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("source_file", *columns)])
    return OrderFiles(listing.mapInArrow(rows, schema), listing.mapInArrow(files, "source_file string, rows long, bad_lines long, reason string"))
