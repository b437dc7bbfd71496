"""Deterministic sharded WARC archives.

Records are sorted by page id and dealt to shards by exact bounds, so a shard
holds the same records in the same order however the input is split and
however many machines take part; a shard rolls its files by their compressed
size; headers, record ids and digests are made anew from the records. The
bytes of an archive therefore depend on its records and parameters alone.

Of the records with equal payloads the one with the least page id is written
whole, the others as ``revisit`` records that name it.

Bounds come from a narrow table (page id, payload digest, size): equal rows are
summed, sorted by range, and a running sum of bytes over the tasks gives each
shard its first record. There are at most ``MOST_SHARDS`` of them, whatever the
input. Which payloads repeat is an aggregate over digests, and ``mark`` rows
that name the first page of such a group are shuffled to the records' shards
and sort directly before them, so payloads move once and meet no join. Pages
that are alike in id and payload beyond a shard's size share several shards.

Commit: a task writes files under temporary names of its own and returns a row
for each. Spark commits those rows as the table ``written``, which so names the
files of one successful attempt of each task. A second job renames them and
commits the table ``manifest`` with name, size and SHA-256 of every file. Both
jobs may be repeated after a failure; readers take the manifest's files only,
so what a lost task left behind is never read, and is removed at the end.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import few, slices, staged

#: shards of an archive, at most; their size grows with the input beyond that
MOST_SHARDS = 16_384
#: what a shard's records hold, at least (but the last one's)
SHARD_BYTES = 4 << 20
#: compressed bytes that close a file
FILE_BYTES = 1 << 30
#: rows alike in id and payload that may share several shards
DEALT_ROWS = 65_536
#: bytes of a record's headers, for the size of shards
_HEAD = 512
#: bytes read from a file at a time
_READ = 1 << 20
_CRLF = b"\r\n"
#: the date of every record, unless another is given: a clock would change the bytes
DATE = "2020-01-01T00:00:00Z"


@dataclass(frozen=True)
class Layout:
    """How an archive is written. Payloads of fewer than ``revisit_bytes``
    bytes are always written whole."""

    shard_bytes: int = SHARD_BYTES
    file_bytes: int = FILE_BYTES
    revisit_bytes: int = 0
    level: int = 6
    date: str = DATE
    software: str = "salescope"


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """Arrow's file system of a path or URI: local, or an object store or HDFS
    where the scheme names one."""
    scheme = urlsplit(uri).scheme
    if not scheme:
        return pafs.LocalFileSystem(), uri
    if scheme == "file":
        return pafs.LocalFileSystem(), urlsplit(uri).path
    return pafs.FileSystem.from_uri({"s3a": "s3", "s3n": "s3"}.get(scheme, scheme) + uri[len(scheme):])


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: object) -> str:
    """A URN that depends on the parts alone."""
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256('|'.join(map(str, parts)).encode()).digest()[:16], version=5)}>"


def one_line(value: str) -> str:
    """A header's value: control characters, which would end it, percent-encoded."""
    return "".join(c if c >= " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def record(fields: list[tuple[str, str | int | None]], block: bytes) -> bytes:
    """A record's bytes; fields without a value are left out."""
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return b"".join([b"WARC/1.1\r\n", head.encode(), b"Content-Length: %d\r\n\r\n" % len(block), block, _CRLF, _CRLF])


def http_head(size: int) -> bytes:
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size


def page_record(page_id: int | None, url: str | None, payload: bytes, first: int | None, revisit: bool, own: str, layout: Layout) -> bytes:
    """A page as a response, or as a revisit of page ``first``. ``own`` tells
    apart records that are alike; a response that others name has none."""
    sha1 = sha1_base32(payload)
    head = http_head(len(payload))
    block = head if revisit else head + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id, sha1, len(payload), own)),
        ("WARC-Date", layout.date),
        ("WARC-Target-URI", None if url is None else one_line(url)),
        ("WARC-Page-ID", page_id),
        ("WARC-Payload-Digest", f"sha1:{sha1}"),
        ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"),
        ("Content-Type", "application/http;msgtype=response"),
    ]
    if revisit:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                   ("WARC-Refers-To", record_id(first, sha1, len(payload), "")), ("WARC-Refers-To-Page-ID", first)]
    return record(fields, block)


class _File:
    """A file being written under a temporary name: a gzip member a record."""

    def __init__(self, base: str, shard: int, roll: int, layout: Layout):
        self.fs, root = file_system(base)
        self.name = f"part-{shard:06d}-{roll:04d}.warc.gz"
        self.temporary = f"temporary/{self.name}.{uuid.uuid4().hex}"
        self.layout, self.shard, self.roll = layout, shard, roll
        self.fs.create_dir(f"{root}/temporary", recursive=True)
        self.out = self.fs.open_output_stream(f"{root}/{self.temporary}", compression=None)
        self.bytes, self.records, self.raw, self.sha256 = 0, 0, 0, hashlib.sha256()
        info = f"software: {layout.software}\r\nformat: WARC File Format 1.1\r\n".encode()
        self.member(record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id("warcinfo", self.name)), ("WARC-Date", layout.date),
                            ("WARC-Filename", self.name), ("WARC-Block-Digest", f"sha1:{sha1_base32(info)}"), ("Content-Type", "application/warc-fields")], info))

    def member(self, data: bytes) -> None:
        z = zlib.compressobj(self.layout.level, zlib.DEFLATED, 31)       # its header holds no time
        part = z.compress(data) + z.flush()
        self.out.write(part)
        self.sha256.update(part)
        self.bytes += len(part)

    def page(self, data: bytes) -> None:
        self.member(data)
        self.records += 1
        self.raw += len(data)

    def close(self) -> dict:
        self.out.close()
        return {"shard": self.shard, "roll": self.roll, "name": self.name, "temporary": self.temporary, "records": self.records,
                "bytes": self.bytes, "raw_bytes": self.raw, "sha256": self.sha256.hexdigest()}


_WRITTEN = "shard int, roll int, name string, temporary string, records long, bytes long, raw_bytes long, sha256 string"


def _bounds(keys: DataFrame, shard_bytes: int) -> list[tuple[int, int]]:
    """First (page, tie) of each shard, ascending, from ``keys`` (page, tie,
    n, bytes). A key of so many rows that it is dealt out comes once for each
    of its shards."""
    spark = keys.sparkSession
    placed = staged(keys.repartitionByRange("page", "tie").sortWithinPartitions("page", "tie")
                        .select("*", F.spark_partition_id().alias("task")), "warc-keys")
    sums = placed.groupBy("task").agg(F.sum("bytes").alias("sum")).orderBy("task").collect()             # a row a task
    total = sum(r["sum"] for r in sums)
    if not total:
        return []
    size = max(shard_bytes, -(-total // MOST_SHARDS))
    starts = spark.createDataFrame([(r["task"], at) for r, at in zip(sums, np.cumsum([0, *(r["sum"] for r in sums)]).tolist())], "task int, start long")
    inside = F.sum("bytes").over(Window.partitionBy("task").orderBy("page", "tie")) - F.col("bytes")
    before = placed.withColumn("inside", inside).join(F.broadcast(starts), "task").withColumn("before", F.col("start") + F.col("inside"))
    # shard k begins at byte k * size: with the key that covers it
    begun = F.expr(f"(before + bytes + {size - 1}) div {size} - (before + {size - 1}) div {size}")
    times = F.when(F.col("n") >= DEALT_ROWS, F.least(begun, F.expr("n div 64"))).otherwise(F.least(begun, F.lit(1)))
    rows = before.select("page", "tie", times.cast("int").alias("times")).where("times > 0").collect()      # MOST_SHARDS and one at most
    return sorted(k for r in rows for k in [(r["page"], r["tie"])] * r["times"])


def write_warc(pages: DataFrame, path: str, layout: Layout = Layout()) -> DataFrame:
    """Writes every row of ``pages`` (page_id, url, html) as a record under
    ``path`` and returns the manifest (shard, roll, name, records, bytes,
    raw_bytes, sha256).

    A null html is an empty payload; empty payloads are equal payloads. A null
    page id sorts first, is left out of its headers, and is the response of its
    group only where no page with an id is in it; of rows alike in id and
    payload one is the response. A null url is left out, control characters in
    one are percent-encoded. A very long payload is one record: a worker holds
    it, its record and the compressed form. Other columns are ignored, whatever
    their names; no rows give an empty manifest. ``path`` must hold no archive.
    """
    spark = pages.sparkSession
    payload = F.coalesce(pages["html"].cast("string").cast("binary"), F.lit(b""))
    page = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"), payload.alias("payload"))
    page = page.withColumn("key", F.unhex(F.sha2("payload", 256)))
    # sorts null first; equal payloads of a page stand together
    place = {"page": F.coalesce("page_id", F.lit(-(1 << 63))), "tie": F.xxhash64("key")}
    narrow = staged(page.select("page_id", "key", F.length("payload").cast("long").alias("size")), "warc-narrow")
    groups = staged(narrow.groupBy("page_id", "key").agg(F.first("size").alias("size"), F.count("*").alias("n")), "warc-groups")
    copies = staged(groups.where(F.col("size") >= layout.revisit_bytes).groupBy("key").agg(F.min("page_id").alias("first"), F.sum("n").alias("n"))
                          .where("n > 1"), "warc-copies")
    keys = groups.withColumns(place).groupBy("page", "tie").agg(F.sum("n").alias("n"), F.sum(F.col("n") * (F.col("size") + _HEAD)).alias("bytes"))
    bounds = spark.sparkContext.broadcast(_bounds(keys, layout.shard_bytes))

    @F.pandas_udf("first_shard int, last_shard int")
    def shards(page: pd.Series, tie: pd.Series) -> pd.DataFrame:
        b = bounds.value
        last = [bisect_right(b, k) - 1 for k in zip(page.tolist(), tie.tolist())]
        first = [max(0, min(x, bisect_left(b, k))) for x, k in zip(last, zip(page.tolist(), tie.tolist()))]
        return pd.DataFrame({"first_shard": np.array(first, np.int32), "last_shard": np.array(last, np.int32)})

    def placed(df: DataFrame) -> DataFrame:
        return df.withColumns(place).withColumn("at", shards("page", "tie"))

    # a payload that repeats: a mark before its pages, in each shard that they share; the most frequent ones are few
    frequent = F.col("n") > DEALT_ROWS
    marks = groups.join(few(copies.where(frequent).select("key", "first")), "key").unionByName(
        groups.join(few(copies.where(~frequent).select("key", "first")), "key"))
    marks = placed(marks.select("page_id", "key", "first"))
    marks = marks.select(F.explode(F.sequence("at.first_shard", "at.last_shard")).alias("shard"), "page", "tie", "key", F.lit(0).alias("kind"), "page_id",
                         F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"), "first",
                         (F.col("page_id").eqNullSafe(F.col("first")) & (F.col("shard") == F.col("at.first_shard"))).alias("leads"))
    spread = F.col("at.first_shard") + F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("at.last_shard") - F.col("at.first_shard") + 1).cast("int")
    body = placed(page).select(spread.alias("shard"), "page", "tie", "key", F.lit(1).alias("kind"), "page_id", "url", "payload",
                               F.lit(None).cast("long").alias("first"), F.lit(False).alias("leads"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, rows, mark, led, own = None, [], None, False, 0
        for batch in batches:
            for part in slices(batch, "payload"):
                for r in part.to_pylist():
                    if r["kind"] == 0:
                        mark, led = r, not r["leads"]                   # led: the group's response is written, or is elsewhere
                        continue
                    if out is None or out.shard != r["shard"]:
                        if out:
                            rows.append(out.close())
                        out, own = _File(path, r["shard"], 0, layout), 0
                    elif out.bytes >= layout.file_bytes:
                        rows.append(out.close())
                        out = _File(path, r["shard"], out.roll + 1, layout)
                    copy = mark is not None and all(mark[c] == r[c] for c in ("shard", "page_id", "key"))
                    name = "" if copy and not led else f"{r['shard']}.{own}"
                    out.page(page_record(r["page_id"], r["url"], r["payload"], mark["first"] if copy else None, copy and led, name, layout))
                    led, own = True, own + 1
        if out:
            rows.append(out.close())
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([
                ("shard", pa.int32()), ("roll", pa.int32()), ("name", pa.string()), ("temporary", pa.string()), ("records", pa.int64()),
                ("bytes", pa.int64()), ("raw_bytes", pa.int64()), ("sha256", pa.string())]))

    both = body.unionByName(marks).repartition("shard").sortWithinPartitions("shard", "page", "tie", "key", "page_id", "kind", "url")
    both.drop("page", "tie").mapInArrow(run, _WRITTEN).write.parquet(f"{path}/written")
    return commit(spark, path)


def commit(spark: SparkSession, path: str) -> DataFrame:
    """Gives the written files their names and commits the manifest. May be
    called again after a failure: files that have their name stay."""
    written = spark.read.schema(_WRITTEN).parquet(f"{path}/written")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(path)
        fs.create_dir(f"{root}/archive", recursive=True)
        for batch in batches:
            for r in batch.to_pylist():
                final = fs.get_file_info(f"{root}/archive/{r['name']}")
                if final.type == pafs.FileType.NotFound:
                    fs.move(f"{root}/{r['temporary']}", f"{root}/archive/{r['name']}")
                    final = fs.get_file_info(f"{root}/archive/{r['name']}")
                if final.size != r["bytes"]:
                    raise OSError(f"{r['name']} has {final.size} bytes, written were {r['bytes']}")
            yield batch.drop_columns(["temporary"])

    schema = _WRITTEN.replace("temporary string, ", "")
    written.mapInArrow(run, schema).write.mode("overwrite").parquet(f"{path}/manifest")
    fs, root = file_system(path)
    if fs.get_file_info(f"{root}/temporary").type == pafs.FileType.Directory:
        fs.delete_dir(f"{root}/temporary")                              # what lost attempts left
    return spark.read.schema(schema).parquet(f"{path}/manifest")


def members(stream, name: str) -> Iterator[bytes]:
    """The records of a gzip file, a member each, read a bounded part at a time."""
    rest, z, held = b"", zlib.decompressobj(31), []
    while True:
        data = rest or stream.read(_READ)
        if not data:
            break
        held.append(z.decompress(data))
        rest = z.unused_data
        if z.eof:
            yield b"".join(held)
            z, held = zlib.decompressobj(31), []
    if any(held):
        raise ValueError(f"{name}: the last record is cut")


def parse(raw: bytes, name: str) -> tuple[dict[str, str], bytes]:
    """(headers, block) of a record; its length and digests are checked."""
    head, _, rest = raw.partition(_CRLF + _CRLF)
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"{name}: no WARC record")
    fields = {k.lower(): v.removeprefix(" ") for k, _, v in (x.partition(":") for x in lines[1:])}
    size = int(fields["content-length"])
    block = rest[:size]
    if len(block) != size or rest[size:] != _CRLF + _CRLF:
        raise ValueError(f"{name}: {fields.get('warc-record-id')} has not the length it states")
    if "warc-block-digest" in fields and fields["warc-block-digest"] != f"sha1:{sha1_base32(block)}":
        raise ValueError(f"{name}: {fields.get('warc-record-id')} does not match its block digest")
    return fields, block


def _page(fields: dict[str, str], block: bytes, name: str) -> dict:
    head, _, payload = block.partition(_CRLF + _CRLF)
    stated = next((int(v) for k, _, v in (x.partition(":") for x in head.decode("latin-1").split("\r\n")) if k.lower() == "content-length"), None)
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    revisit = fields["warc-type"] == "revisit"
    if not revisit and (digest != sha1_base32(payload) or stated not in (None, len(payload))):
        raise ValueError(f"{name}: {fields.get('warc-record-id')} does not match its payload digest")
    page, first = fields.get("warc-page-id"), fields.get("warc-refers-to-page-id")
    return {"page_id": page and int(page), "url": fields.get("warc-target-uri"), "record_type": fields["warc-type"], "record_id": fields["warc-record-id"],
            "payload_bytes": stated if revisit else len(payload), "payload_digest": digest, "refers_to": first and int(first),
            "refers_to_id": fields.get("warc-refers-to"), "payload": None if revisit else payload}


_PAGES = "page_id long, url string, record_type string, record_id string, payload_bytes long, payload_digest string, refers_to long, refers_to_id string"


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Every page record of the manifest's files: page_id, url, record_type,
    record_id, payload_bytes, payload_digest, refers_to, refers_to_id, and with
    ``payloads`` the payload (null in revisits). Sizes, lengths, digests and the
    files' SHA-256 are checked; what does not match fails the read by name."""
    schema = _PAGES + (", payload binary" if payloads else "")
    manifest = spark.read.schema(_WRITTEN.replace("temporary string, ", "")).parquet(f"{path}/manifest")
    parts = max(1, min(manifest.count(), 100_000))                      # a file or so a task
    arrow = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("record_id", pa.string()), ("payload_bytes", pa.int64()),
                       ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("refers_to_id", pa.string()), *([("payload", pa.binary())] if payloads else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(path)
        for batch in batches:
            for file in batch.to_pylist():
                rows, held, n = [], 0, 0
                with fs.open_input_stream(f"{root}/archive/{file['name']}", compression=None) as f:
                    stream = _Hashed(f)
                    for raw in members(stream, file["name"]):
                        fields, block = parse(raw, file["name"])
                        if fields["warc-type"] not in ("response", "revisit"):
                            continue
                        rows.append(_page(fields, block, file["name"]))
                        held, n = held + len(raw), n + 1
                        if held > _READ or len(rows) >= 10_000:
                            yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                            rows, held = [], 0
                if stream.sha256.hexdigest() != file["sha256"] or n != file["records"]:
                    raise ValueError(f"{file['name']}: not the file of the manifest")
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return manifest.repartition(parts, "name").mapInArrow(run, schema)


class _Hashed:
    """A stream that hashes what is read from it."""

    def __init__(self, stream):
        self.stream, self.sha256 = stream, hashlib.sha256()

    def read(self, n: int) -> bytes:
        data = self.stream.read(n)
        self.sha256.update(data)
        return data


def warc_round_trip(pages: DataFrame, layout: Layout = Layout()) -> DataFrame:
    """Writes ``pages`` into a fresh archive of the shared folder and reads its
    records back, without payloads."""
    path = scratch_path(pages.sparkSession, "warc")
    write_warc(pages, path, layout)
    return read_warc(pages.sparkSession, path, payloads=False)
