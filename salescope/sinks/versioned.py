"""A table that changes by whole versions (R4, K2-K5 on files).

A commit writes its rows into a folder of its own and then publishes a manifest
that names the folders of every partition. Publishing is one rename that fails
where the version exists, so of two writers one wins and the other tries again
on what the first left; a reader takes the newest manifest and sees all of a
commit or nothing. ``replace`` swaps the partitions that occur in the new rows
and keeps the others: seeding a snapshot twice leaves it once.

Manifests hold a line for each partition, so their size follows the number of
snapshots or days, not of rows.
"""

from __future__ import annotations

import json
import os
import uuid
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: attempts to publish against other writers
_TRIES = 20


class VersionedTable:
    """``path`` holds ``data/__commit=<id>/<by>=<value>/`` and ``versions/``.
    ``by`` is the column whose values are swapped as a whole."""

    def __init__(self, spark: SparkSession, path: str, by: str):
        self.spark, self.path, self.by = spark, path.rstrip("/"), by
        jvm = spark.sparkContext._jvm
        self._hadoop = jvm.org.apache.hadoop.fs
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._hadoop.Path(self.path).getFileSystem(conf)

    # ---------------------------------------------------------------- files
    def _file(self, name: str):
        return self._hadoop.Path(f"{self.path}/{name}")

    def _names(self, folder: str) -> list[str]:
        at = self._file(folder)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def _read_json(self, name: str) -> dict:
        stream = self._fs.open(self._file(name))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _publish(self, version: int, manifest: dict) -> bool:
        """Whether this writer made the version."""
        self._fs.mkdirs(self._file("versions"))
        temporary, final = self._file(f"temporary-{uuid.uuid4().hex}"), self._file(f"versions/{version:010d}.json")
        out = self._fs.create(temporary, False)
        out.write(bytearray(json.dumps(manifest).encode()))         # written whole before it gets its name
        out.close()
        made = self._named(temporary, final)
        self._fs.delete(temporary, False)
        return made

    def _named(self, temporary, final) -> bool:
        """One name for one writer: a link on a local disk, a rename that does
        not overwrite elsewhere (atomic on HDFS; an object store needs one
        writer at a time)."""
        if self._fs.getUri().getScheme() == "file":
            try:
                os.link(temporary.toUri().getPath(), final.toUri().getPath())
                return True
            except FileExistsError:
                return False
        sc = self.spark.sparkContext
        kind = getattr(self._hadoop, "Options$Rename")
        how = sc._gateway.new_array(kind, 1)
        how[0] = kind.NONE
        try:
            self._hadoop.FileContext.getFileContext(self._fs.getUri(), sc._jsc.hadoopConfiguration()).rename(temporary, final, how)
            return True
        except Exception as e:  # noqa: BLE001 -- a Java exception, told by its name
            if "FileAlreadyExists" in str(e):
                return False
            raise

    # ------------------------------------------------------------- versions
    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in self._names("versions") if n.endswith(".json")]

    def manifest(self, version: int | None = None) -> dict | None:
        """{"schema", "parts": {value: [folders]}, "sizes": {commit: its
        folders when written}} of a version, the newest if
        none is given; None for a table without any."""
        known = self.versions()
        if version is None:
            return self._read_json(f"versions/{known[-1]:010d}.json") if known else None
        if version not in known:
            raise ValueError(f"{self.path} has no version {version}")
        return self._read_json(f"versions/{version:010d}.json")

    def read(self, version: int | None = None) -> DataFrame:
        """All rows of a version; a filter on ``by`` prunes folders."""
        m = self.manifest(version)
        if m is None:
            raise ValueError(f"{self.path} holds no table")
        schema = T.StructType.fromJson(m["schema"])
        folders = sorted({f for part in m["parts"].values() for f in part})
        commits = Counter(f.split("/")[0] for f in folders)
        # a commit of which nothing was replaced is read as one folder
        folders = sorted({c if commits[c] == m["sizes"][c] else f for f in folders for c in [f.split("/")[0]]})
        if not folders:
            return self.spark.createDataFrame([], schema)
        stored = T.StructType([*[f for f in schema.fields if f.name != self.by], schema[self.by]])
        df = self.spark.read.schema(T.StructType([*stored.fields, T.StructField("__commit", T.StringType())])) \
            .option("basePath", f"{self.path}/data").parquet(*[f"{self.path}/data/{f}" for f in folders])
        return df.select(*schema.fieldNames())

    # --------------------------------------------------------------- writes
    def _write(self, df: DataFrame) -> dict[str, list[str]]:
        commit = f"__commit={uuid.uuid4().hex}"
        # a large partition takes the files that its size needs, small ones one each
        df.hint("rebalance", F.col(self.by)).write.partitionBy(self.by).parquet(f"{self.path}/data/{commit}")
        return {n: [f"{commit}/{n}"] for n in self._names(f"data/{commit}") if n.startswith(f"{self.by}=")}

    def _fits(self, df: DataFrame) -> None:
        old = self.manifest()
        if old is not None and (held := T.StructType.fromJson(old["schema"]).simpleString()) != df.schema.simpleString():
            raise ValueError(f"{self.path} has the columns {held}, not {df.schema.simpleString()}")

    def _commit(self, df: DataFrame, merge) -> int:
        self._fits(df)
        made = self._write(df)
        for _ in range(_TRIES):
            self._fits(df)
            known = self.versions()
            old = self.manifest(known[-1]) if known else None
            version = known[-1] + 1 if known else 0
            parts = merge(dict(old["parts"]) if old else {}, made)
            sizes = (old["sizes"] if old else {}) | Counter(f.split("/")[0] for part in made.values() for f in part)
            used = {f.split("/")[0] for part in parts.values() for f in part}
            if self._publish(version, {"schema": df.schema.jsonValue(), "parts": parts, "sizes": {c: n for c, n in sizes.items() if c in used}}):
                return version
        raise RuntimeError(f"{self.path}: other writers took {_TRIES} versions")

    def replace(self, df: DataFrame) -> int:
        """The partitions that occur in ``df`` become its rows; returns the version."""
        return self._commit(df, lambda old, new: old | new)

    def append(self, df: DataFrame) -> int:
        """Adds the rows of ``df`` to their partitions."""
        return self._commit(df, lambda old, new: old | {k: old.get(k, []) + v for k, v in new.items()})

    def overwrite(self, df: DataFrame) -> int:
        """The table becomes the rows of ``df`` alone."""
        return self._commit(df, lambda old, new: new)


def seed(table: VersionedTable, targets: DataFrame) -> int:
    """Target rows (snapshot, key, target); snapshots seeded before are
    replaced, others stay."""
    return table.replace(targets)


def land(table: VersionedTable, latest: DataFrame, merged: DataFrame, which: str = "latest") -> int:
    """Q18 on files: the collected fact that replaces the landed one."""
    if which not in ("latest", "merged"):
        raise ValueError(f"which must be 'latest' or 'merged', not {which!r}")
    return table.overwrite(latest if which == "latest" else merged)
