"""Packing: documents into sequences of at most 4096 tokens, by minimum bin slack.

Whole windows of a document become sequences of their own. What remains of
each document is shorter than a window, so the corpus's remainders are a
multiset over fewer than 4096 lengths, whatever its size. The longest length
left is fixed and a bitset subset-sum over the other lengths finds the
multiset that comes closest to a full window; backtracking gives its counts,
and the same filling is repeated as often as the counts allow. Where the best
filling would leave slack, nothing is padded: those remainders are laid end
to end and cut at the windows, and the last window at powers of two.

A filling is a few numbers (length, first rank, count, first sequence,
offset), and each remainder finds its place from its rank among those of its
length, which is its rank in its task plus the count of the tasks before.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import few, staged
from .token_output import encode_documents, id_type, vocabulary_size

#: tokens of a sequence
WINDOW = 4096
#: id appended to each document
END_ID = 2
#: tasks whose whole windows are summed together; one row a run is summed at last
PARTS_RUN = 1024


def best_filling(counts: dict[int, int], capacity: int) -> tuple[dict[int, int], int]:
    """The multiset with the longest length of ``counts`` whose sum comes
    closest to ``capacity`` from below: ({length: count}, slack)."""
    lengths = sorted(counts, reverse=True)
    longest = lengths[0]
    goal = capacity - longest
    reach, steps = 1, []
    full = (1 << goal + 1) - 1
    for length in lengths:
        have = min(counts[length] - (length == longest), goal // length)
        if have <= 0:
            continue
        steps.append((length, have, reach))
        some = 1
        while have:
            take = min(some, have)
            reach |= reach << take * length & full
            have -= take
            some *= 2
        if reach >> goal & 1:
            break
    at = reach.bit_length() - 1
    slack = goal - at
    used = {longest: 1}
    for length, have, before in reversed(steps):
        n = 0
        while not before >> at & 1:
            at -= length
            n += 1
        if n:
            used[length] = used.get(length, 0) + n
    return used, slack


class Plan:
    """Where the remainder of rank r among those of its length goes."""

    def __init__(self, counts: dict[int, int], window: int = WINDOW):
        left = {k: v for k, v in counts.items() if v}
        taken = dict.fromkeys(left, 0)
        rows, tail, sequence = [], [], 0
        while left:
            used, slack = best_filling(left, window)
            if slack:
                longest = max(left)
                tail.append((longest, taken[longest], left.pop(longest)))
                continue
            times = min(left[k] // n for k, n in used.items())
            offset = 0
            for k in sorted(used, reverse=True):
                n = used[k]
                rows.append((k, taken[k], n, sequence, offset))
                offset += n * k
                taken[k] += n * times
                left[k] -= n * times
                if not left[k]:
                    del left[k]
            sequence += times
        # rows of a length ascend by first rank; the tail's rows come last, with count 0
        position = 0
        for k, rank, n in tail:
            rows.append((k, rank, 0, 0, position))
            position += k * n
        rows.sort()
        self.window, self.filled, self.tail_tokens = window, sequence, position
        self.length, self.rank, self.count, self.sequence, self.offset = (np.array(x, np.int64) for x in (zip(*rows) if rows else [[]] * 5))
        self.key = self.length << 48 | self.rank
        # ends of the tail's sequences after its last whole window
        rest, end = position % window, position // window * window
        self.ends = [end]
        while rest:
            size = 1 << rest.bit_length() - 1
            end, rest = end + size, rest - size
            self.ends.append(end)

    def places(self, length: int, rank: int) -> list[tuple[int, int, int]]:
        """[(size, sequence, offset)] of a remainder, in the order of its ids."""
        i = int(np.searchsorted(self.key, length << 48 | rank, "right")) - 1
        ahead = rank - int(self.rank[i])
        if n := int(self.count[i]):
            return [(length, int(self.sequence[i]) + ahead // n, int(self.offset[i]) + ahead % n * length)]
        at, end, out = int(self.offset[i]) + ahead * length, int(self.offset[i]) + (ahead + 1) * length, []
        whole = self.ends[0]
        while at < end:
            if at < whole:
                k, begin = at // self.window, at // self.window * self.window
                stop = begin + self.window
            else:
                j = int(np.searchsorted(self.ends, at, "right"))
                k, begin, stop = whole // self.window + j - 1, self.ends[j - 1], self.ends[j]
            size = min(end, stop) - at
            out.append((size, self.filled + k, at - begin))
            at += size
        return out


def _wholes_before(groups: DataFrame) -> DataFrame:
    """(part, wholes_before): the whole windows of the tasks before each one.
    Sums run inside runs of PARTS_RUN tasks, and then over the runs' totals."""
    parts = groups.groupBy("part").agg(F.sum("wholes").alias("wholes")).withColumn("run", F.floor(F.col("part") / PARTS_RUN))
    runs = parts.groupBy("run").agg(F.sum("wholes").alias("of_run"))
    runs = runs.select("run", (F.sum("of_run").over(Window.orderBy("run")) - F.col("of_run")).alias("runs_before"))
    inside = F.sum("wholes").over(Window.partitionBy("run").orderBy("part")) - F.col("wholes")
    return parts.withColumn("inside", inside).join(runs, "run").select("part", (F.col("runs_before") + F.col("inside")).cast("long").alias("wholes_before"))


def pack_documents(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset.

    Every row of ``docs`` (doc_id, text) is packed, rows with the same id each
    on their own; a null text is empty, and an empty one is the end id alone;
    a null id stays null; other columns are ignored; a very long text is many
    whole windows of its own; no rows give no pieces.
    """
    kind = id_type(vocabulary_size(tokenizer))
    width = int(kind[-1])

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, whole, seen = TaskContext.get().partitionId(), 0, {}
        for batch in batches:
            ranks, wholes = [], []
            for n in batch.column("n_tokens").to_pylist():
                wholes.append(whole)
                whole += n // window
                ranks.append(k := seen.get(n % window, 0))
                seen[n % window] = k + 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([part] * batch.num_rows, pa.int32()), pa.array(wholes, pa.int64()), pa.array(ranks, pa.int64())],
                [*batch.schema.names, "part", "whole_before", "rank"])

    encoded = staged(encode_documents(docs, tokenizer, end_id, numbered, ", part int, whole_before long, rank long"), "pack-ids")
    rest = (F.col("n_tokens") % window).cast("int").alias("rest")
    # at most a row per length and task; the totals per length stay under `window` rows
    groups = staged(encoded.groupBy("part", rest).agg(F.count("*").alias("n"), F.sum(F.floor(F.col("n_tokens") / window)).cast("long").alias("wholes")), "pack-counts")
    counts = {r["rest"]: r["n"] for r in groups.filter("rest > 0").groupBy("rest").agg(F.sum("n").alias("n")).collect()}
    plan = Plan(counts, window)
    before = F.sum("n").over(Window.partitionBy("rest").orderBy("part")) - F.col("n")
    # at most a window's length of entries a task
    maps = groups.select("part", "rest", before.alias("ranks_before")).groupBy("part").agg(
        F.map_from_entries(F.collect_list(F.struct("rest", "ranks_before"))).alias("ranks_before"))
    starts = few(staged(_wholes_before(groups).join(maps, "part"), "pack-starts"))
    total = groups.agg(F.coalesce(F.sum("wholes"), F.lit(0))).first()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            col = {n: batch.column(n).to_pylist() for n in batch.schema.names}
            for doc_id, n, raw, whole, rank, before, first in zip(*(col[c] for c in (
                    "doc_id", "n_tokens", "ids", "whole_before", "rank", "rank_before", "wholes_before"))):
                ids = np.frombuffer(raw, kind).astype("<u4").tobytes()
                places = [(window, first + whole + j, 0) for j in range(n // window)]
                if n % window:
                    places += [(size, total + s, o) for size, s, o in plan.places(n % window, before + rank)]
                at = 0
                for size, sequence, offset in places:
                    rows.append((doc_id, at, size, zlib.crc32(ids[4 * at:4 * (at + size)]), n, sequence, offset))
                    at += size
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            cols = list(zip(*rows)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names)

    placed = encoded.join(starts, "part").withColumn("rank_before", F.coalesce(F.col("ranks_before")[rest], F.lit(0))).drop("ranks_before", "part")
    return placed.mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
