"""Token-id output: frequency-ranked ids in byte-aligned variable-length code.

File format: a table of blocks in ascending document order. A block holds
whole documents: their ids, their numbers of tokens, and the ranks of all
their tokens as one stream of control bytes (two bits a value: its bytes less
one; four values a byte) and one of data bytes. Rank 0 is the corpus's most
frequent id, so frequent ids take one byte and all others of a 16-bit
vocabulary two. Decoding looks the control bytes up in a 256-row table and
gathers the data bytes with numpy. The table of ranks is bounded by the
vocabulary and is written beside the blocks.

Jobs: one pass encodes into a staged table, one counts ids (a row per id and
task), one sorts by range of document id and writes blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import slices, staged, text_column
from .tokens import Encoder

#: id appended to each document
END_ID = 0
#: tokens that close a block
BLOCK_TOKENS = 1 << 18

# lengths of the four values that a control byte stands for
_LENGTHS = np.stack([(np.arange(256) >> s & 3) + 1 for s in (0, 2, 4, 6)], axis=1)


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 32-bit values."""
    v = np.ascontiguousarray(values, "<u4")
    more = (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    quad = np.zeros((len(v) + 3) // 4 * 4, np.uint8)
    quad[:len(v)] = more
    quad = quad.reshape(-1, 4)
    control = quad[:, 0] | quad[:, 1] << 2 | quad[:, 2] << 4 | quad[:, 3] << 6
    used = np.arange(4)[None, :] <= more[:, None]
    return control.astype(np.uint8).tobytes(), v.view(np.uint8).reshape(-1, 4)[used].tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The n values of ``pack``."""
    size = _LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    at = np.cumsum(size) - size
    raw = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(4, np.uint8)]).astype(np.uint32)
    out = np.zeros(n, np.uint32)
    for k in range(4):
        out |= np.where(size > k, raw[at + k], 0).astype(np.uint32) << np.uint32(8 * k)
    return out


def binary(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())


def encode_documents(docs: DataFrame, tokenizer: str, end_id: int, then: Callable | None = None, more: str = "") -> DataFrame:
    """(doc_id, n_tokens, ids): little-endian ids with the end id appended,
    two bytes each where the vocabulary allows it, else four. ``then`` takes a
    task's batches further in the same worker and adds the columns ``more``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(tokenizer)
        kind = id_type(len(encoder.size))
        for batch in batches:
            for part in slices(batch):
                ids, at = encoder.encode(part.column("text"))
                ids = np.insert(ids, at[1:], end_id).astype(kind)
                at = at + np.arange(len(at))
                raw, width = ids.tobytes(), ids.itemsize
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(at), pa.int64()),
                     binary([raw[a * width:b * width] for a, b in zip(at[:-1], at[1:])])],
                    ["doc_id", "n_tokens", "ids"])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_column(docs).alias("text")) \
        .mapInArrow((lambda batches: then(run(batches))) if then else run, "doc_id long, n_tokens long, ids binary" + more)


def id_type(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def vocabulary_size(tokenizer: str) -> int:
    return len(Encoder.of(tokenizer).size)


def id_ranks(encoded: DataFrame, vocabulary: int) -> np.ndarray:
    """rank of each id by its count in the whole corpus, ties by id. The result
    has one entry per id of the vocabulary, whatever the corpus."""
    kind = id_type(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            raw = batch.column("ids")
            at = np.frombuffer(raw.buffers()[1], np.int32, raw.offset + len(raw) + 1)[[raw.offset, -1]]
            total += np.bincount(np.frombuffer(raw.buffers()[2][int(at[0]):int(at[1])], kind), minlength=vocabulary)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], ["id", "n"])

    counts = np.zeros(vocabulary, np.int64)
    rows = encoded.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    for r in rows.collect():                      # at most one row per id of the vocabulary
        counts[r["id"]] = r["n"]
    rank = np.zeros(vocabulary, np.uint32)
    rank[np.lexsort((np.arange(vocabulary), -counts))] = np.arange(vocabulary)
    return rank


def write_token_ids(docs: DataFrame, tokenizer: str, path: str) -> None:
    """Writes the token ids of every row of ``docs`` (doc_id, text) to
    ``path``/blocks and the ranks to ``path``/ranks.

    A null text is an empty text: its document is the end id alone. Null
    document ids come first; rows that share an id are all kept, ordered by a
    hash of their ids and dealt over as many tasks as they need, copies too;
    other columns are ignored; a very long text is one document of a block of
    its own size; no rows make no blocks.
    """
    spark = docs.sparkSession
    vocabulary = vocabulary_size(tokenizer)
    kind = id_type(vocabulary)
    encoded = staged(encode_documents(docs, tokenizer, END_ID), "token-ids")
    rank = id_ranks(encoded, vocabulary)
    order = np.argsort(rank)
    spark.createDataFrame([(order.astype("<u4").tobytes(),)], "ids_by_rank binary").write.parquet(f"{path}/ranks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, before = TaskContext.get().partitionId(), 0, 0
        ids, sizes, held = [], [], []

        def close() -> pa.RecordBatch:
            nonlocal block, before, ids, sizes, held
            values = np.concatenate(held)
            control, data = pack(rank[values])
            out = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([block], pa.int64()), pa.array([before], pa.int64()),
                 pa.array([len(values)], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                 pa.array([sizes], pa.list_(pa.int64())), binary([control]), binary([data])], names)
            block, before, ids, sizes, held = block + 1, before + len(values), [], [], []
            return out

        room = 0
        for batch in batches:
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), batch.column("ids")):
                values = np.frombuffer(raw.as_buffer(), kind)
                ids.append(doc_id)
                sizes.append(len(values))
                held.append(values)
                room += len(values)
                if room >= BLOCK_TOKENS:
                    yield close()
                    room = 0
        if ids:
            yield close()

    names = ["part", "block", "tokens_before", "n_tokens", "doc_ids", "sizes", "control", "data"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # rows alike in id and hash are cut by their place in the staged table, the same in each attempt
    ranged = encoded.withColumn("hash", F.xxhash64("ids")).withColumn("place", F.monotonically_increasing_id()) \
        .repartitionByRange(parts, "doc_id", "hash", "place").sortWithinPartitions("doc_id", "hash", "place")
    ranged.select("doc_id", "ids").mapInArrow(
        run, "part int, block long, tokens_before long, n_tokens long, doc_ids array<long>, sizes array<long>, control binary, data binary"
    ).write.option("compression", "zstd").parquet(f"{path}/blocks")


def read_token_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) per document of ``path``, ids as
    little-endian unsigned 32-bit integers; ``start`` counts the ids of all
    documents before it in the order of the files."""
    blocks = spark.read.parquet(f"{path}/blocks")
    by_rank = np.frombuffer(spark.read.parquet(f"{path}/ranks").first()["ids_by_rank"], "<u4")
    # one row per part file: bounded by the number of write tasks
    totals = blocks.groupBy("part").agg(F.sum("n_tokens").alias("part_tokens"))
    offsets = totals.select("part", (F.sum("part_tokens").over(Window.orderBy("part")) - F.col("part_tokens")).alias("part_start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in range(batch.num_rows):
                row = {n: batch.column(n)[b] for n in batch.schema.names}
                sizes = np.array(row["sizes"].as_py(), np.int64)
                n = int(sizes.sum())
                ids = by_rank[unpack(row["control"].as_py(), row["data"].as_py(), n)].astype("<u4")
                at = np.concatenate([[0], np.cumsum(sizes)])
                raw = ids.tobytes()
                first = row["part_start"].as_py() + row["tokens_before"].as_py()
                yield pa.RecordBatch.from_arrays(
                    [row["doc_ids"].values, pa.array(first + at[:-1], pa.int64()), pa.array(sizes, pa.int64()),
                     binary([raw[4 * x:4 * y] for x, y in zip(at[:-1], at[1:])])], ["doc_id", "start", "n_tokens", "ids"])

    return blocks.join(F.broadcast(offsets), "part").mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def token_output(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Writes, reads back, and returns (doc_id, start, n_tokens, ids_crc32)."""
    path = scratch_path(docs.sparkSession, "token-output")
    write_token_ids(docs, tokenizer, path)
    return read_token_ids(docs.sparkSession, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))

