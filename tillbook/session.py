"""Session settings and the shared folder for written tables."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}
_open = threading.local()

# Shuffle files go when the query that wrote them has ended, not when the driver happens to collect its garbage. A plan
# that is run again repeats the stages that it misses.
_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(app: str, cpus: int | str = 8, memory: str = "8g", **extra: str) -> SparkSession:
    """Session for tests and the benchmark. A cluster brings its own settings."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus) if str(cpus).isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
    )
    return builder.config(map=extra).getOrCreate() if extra else builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: spark.checkpoint.dir.

    Only a local session may fall back to a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="tillbook-")
    return _local_folders[app]


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; no path is ever reused."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/tillbook/{app}/{label}-{uuid.uuid4().hex[:12]}"


def tidy(spark: SparkSession) -> None:
    """Let Spark remove shuffle files with their query, unless the session says otherwise."""
    if spark.conf.get(_TIDY, None) is None:
        spark.conf.set(_TIDY, "true")


def store(df: DataFrame, path: str, slices: tuple[str, ...] = ()) -> None:
    """Write a table of the library's own, in the codec that takes least disk."""
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*slices) if slices else writer).parquet(path)


def pin(df: DataFrame, label: str) -> DataFrame:
    """Write a derived table to the shared folder and read it back, which ends its lineage."""
    path = new_folder(df.sparkSession, label)
    store(df, path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.pinned_at = path
    for scope in getattr(_open, "scopes", [])[-1:]:
        scope.append(path)
    return out


def unpin(*pinned: DataFrame) -> None:
    """Delete pinned tables that nothing reads any more."""
    for df in pinned:
        _delete(df.sparkSession, df.pinned_at)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Tables that this thread pins inside are deleted at the end: by then, what is made of them is written."""
    scopes = _open.__dict__.setdefault("scopes", [])
    scopes.append([])
    try:
        yield
    finally:
        for path in scopes.pop():
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    """A path under new_folder, which is never reused."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
