"""Session construction and shared-storage helpers.

Library functions never create a session: callers pass DataFrames in. This
module is for entry points (tests, bench, command line) that need one.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "salescope") -> SparkSession:
    """A session with AQE on, UTC time and no UI.

    ``shuffle_partitions`` defaults to the core count for local masters; on a
    cluster leave it to the deployment (AQE coalesces small partitions).
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # local mode runs every task in the driver JVM: give it the heap
            # a cluster would spread over executors
            builder = builder.config("spark.driver.memory", os.environ.get("SALESCOPE_DRIVER_MEMORY", "16g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def session_key(spark: SparkSession) -> tuple:
    """Identifies a live session (and its application) for per-session caches."""
    try:
        return (id(spark), spark.sparkContext.applicationId)
    except Exception:  # noqa: BLE001 -- sessions without a local SparkContext
        return (id(spark), None)


def default_parallelism(spark: SparkSession) -> int:
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001
        return int(spark.conf.get("spark.default.parallelism", "8"))


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the deployment (a shared file system or
    object store) and is an error where it is not. Only with a local master --
    tests -- a private folder is created and registered instead, so the same
    code path works in both places.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 -- no local SparkContext: the setting must exist
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder") from None
        return configured.rstrip("/")
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        current = tempfile.mkdtemp(prefix="salescope-ckpt-")
        sc.setCheckpointDir(current)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current.rstrip("/")


_SCRATCH: dict[tuple, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-path of the shared folder for written intermediate tables."""
    path = f"{shared_dir(spark)}/salescope/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.setdefault(session_key(spark), []).append(path)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder once and read back: for a frame that
    several jobs read and that costs more to compute than to store."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_paths(spark: SparkSession) -> list[str]:
    """The scratch paths that this session has made and not removed, in order."""
    return list(_SCRATCH.get(session_key(spark), ()))


def remove_scratch(spark: SparkSession, paths: list[str] | None = None) -> None:
    """Removes scratch tables, all of the session's if none are named. Frames
    that still read them cannot be run again, so this is for a caller that has
    written its results."""
    made = _SCRATCH.get(session_key(spark), [])
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for path in list(made) if paths is None else paths:
        if path in made:
            at = hadoop.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
            made.remove(path)


_SHIPPED: set[tuple] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package's source to the session's executors, once a session.

    Functions that run in Python workers are pickled by reference, so a worker
    must be able to import the package; on a cluster, or when the driver was
    started from another folder, nothing else puts it on its path.
    """
    key = session_key(spark)
    if key in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    name = os.path.basename(root)
    from pyspark import SparkFiles
    folder = os.path.join(SparkFiles.getRootDirectory(), "src")          # Spark's own, gone with the session
    os.makedirs(folder, exist_ok=True)
    made = os.path.join(folder, f"{name}.zip")
    with zipfile.ZipFile(made, "w", zipfile.ZIP_DEFLATED) as z:
        for at, dirs, files in os.walk(root):
            dirs[:] = sorted(d for d in dirs if d != "__pycache__")
            for f in sorted(files):
                if f.endswith(".py"):
                    path = os.path.join(at, f)
                    z.write(path, os.path.join(name, os.path.relpath(path, root)))
    spark.sparkContext.addPyFile(made)                                   # served by the driver
    _SHIPPED.add(key)
