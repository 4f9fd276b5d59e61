"""Incremental loads into append-only RAW tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillbook.functions.columns import at


def high_water(df: DataFrame, cursor: str = "updated_at"):
    """Largest cursor value, one scalar; NULL on an empty table."""
    return df.agg(F.max(cursor)).first()[0]


def rows_since(df: DataFrame, cursor: str, last: datetime | None) -> DataFrame:
    """Rows at or after the last loaded cursor value; None loads everything.

    The bound is a literal on a bare column, so it reaches the scan.
    """
    return df if last is None else df.filter(F.col(cursor) >= at(last))


def extract_incremental(df: DataFrame, cursor: str, last: datetime | None) -> tuple[DataFrame, datetime | None]:
    """rows_since and the cursor value to go on from, for a caller that keeps it."""
    rows = rows_since(df, cursor, last)
    return rows, high_water(rows, cursor) or last


def drop_boundary(df: DataFrame, raw: DataFrame, pk: list[str], cursor: str, last: datetime | None) -> DataFrame:
    """Leave out rows read before: same key at exactly the last cursor value. Never merges."""
    if last is None:
        return df
    loaded = raw.filter(F.col(cursor) == at(last)).select(*pk, cursor)
    return df.join(loaded, [*pk, cursor], "left_anti")


def append_raw(df: DataFrame, path: str, load_id: int) -> None:
    """Add rows of one load. Nothing that was stored is ever replaced; a repeated load adds to its first attempt."""
    df.withColumn("_load_id", F.lit(load_id).cast("bigint")).write.mode("append").partitionBy("_load_id").parquet(path)


def read_raw(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A RAW table with its declared columns."""
    return spark.read.schema(schema).parquet(path).select(schema.names)


def replace_table(df: DataFrame, path: str) -> None:
    """Write beside the table, then swap the folders: a failed write leaves the old table as it was."""
    spark, fresh = df.sparkSession, f"{path}.new-{uuid.uuid4().hex[:8]}"
    df.write.parquet(fresh)
    jvm = spark.sparkContext._jvm.org.apache.hadoop.fs
    old, new = jvm.Path(path), jvm.Path(fresh)
    files = old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if files.exists(old):
        files.delete(old, True)
    if not files.rename(new, old):
        raise OSError(f"{fresh} could not become {path}")
    spark.catalog.refreshByPath(path)


def load_appended(
    source: DataFrame,
    path: str,
    schema: StructType,
    pk: list[str],
    load_id: int,
    watch: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> None:
    """Extract since the newest RAW row, drop the boundary copies, append. `watch` sees exactly the appended rows.

    The cursor state is RAW itself, so a lost run repeats without a gap, and a repeated load adds only what
    the source has changed since.
    """
    spark = source.sparkSession
    raw = existing(spark, path, schema)
    if raw is None:
        append_raw(watch(source), path, load_id)
        return
    # The newest row may stand in any load, because a load can be repeated; one column is read.
    last = high_water(raw)
    append_raw(watch(drop_boundary(rows_since(source, "updated_at", last), raw, pk, "updated_at", last)), path, load_id)


def existing(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    """The table at a path, or None when nothing was written there yet."""
    try:
        return read_raw(spark, path, schema)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
