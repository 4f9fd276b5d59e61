"""Structured Streaming loads: files to RAW, copies out, facts in by key.

Every stream stops when it has caught up (availableNow); a restart with the same checkpoint reads nothing
twice, and a batch that is delivered again is recognised by its id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillbook.functions.columns import UNKNOWN_KEY
from tillbook.operators.history import latest_state
from tillbook.operators.pit import pit_join
from tillbook.operators.quality import Watched
from tillbook.operators.scale import broadcast_if_small
from tillbook.session import passing, pin
from tillbook.sources.ingest import existing
from tillbook.sources.snapshots import SnapshotTable


def read_files(
    spark: SparkSession, folder: str, schema: StructType, glob: str = "*.parquet", max_files: int = 10_000
) -> DataFrame:
    """New Parquet files of a folder as a stream; max_files bounds one micro-batch of a long backlog."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    return reader.option("maxFilesPerTrigger", max_files).parquet(folder)


def ingest_stream(stream: DataFrame, path: str, checkpoint: str) -> int:
    """Append what is new and stop. Returns the number of rows of this run."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(p["numInputRows"] for p in query.recentProgress)


def ingest_watched(stream: DataFrame, path: str, checkpoint: str, rules: Watched) -> list[tuple]:
    """ingest_stream with row rules measured by its batches; returns their results, one set for each batch."""
    query = (
        stream.observe("rules", *rules.counts())
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    seen = [p.observedMetrics["rules"].asDict() for p in query.recentProgress if "rules" in p.observedMetrics]
    return [row for counts in seen for row in rules.named(counts)]


def dedupe_stream(stream: DataFrame, keys: list[str], event_time: str, delay: str) -> DataFrame:
    """Drop copies that arrive within `delay`; state older than the watermark is let go.

    A watermark needs a TIMESTAMP, so the UTC wall clock column is cast (session time zone UTC).
    """
    timed = stream.withColumn("_event_time", F.col(event_time).cast("timestamp"))
    return timed.withWatermark("_event_time", delay).dropDuplicatesWithinWatermark(keys).drop("_event_time")


# State of a join outside the JVM heap, one store for each partition in place of four, changes logged by batch. A stream
# that began otherwise goes on as it began: its checkpoint holds these settings.
_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",  # counting looks every written key up
    "spark.sql.streaming.join.stateFormatVersion": "3",
}


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams that start inside keep their state by _STATE; the session's own settings come back."""
    before = {k: spark.conf.get(k, None) for k in _STATE}
    for k, v in _STATE.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def upsert_stream(
    stream: DataFrame,
    table: SnapshotTable,
    keys: list[str],
    checkpoint: str,
    order_by: str,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> None:
    """Write each micro-batch into a keyed table; the newest row of a key in a batch wins."""

    def write(batch: DataFrame, batch_id: int) -> None:
        newest = latest_state(batch, keys, order_by)
        # The checkpoint names the stream: another stream into the same table counts its own batches.
        table.upsert(transform(newest), keys, batch=f"{checkpoint}#{batch_id}")

    with _state_on_disk(table.spark):
        query = (
            stream.writeStream.foreachBatch(write)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    query.awaitTermination()


# Header columns that a line takes; of a line that stays alone the ids are Unknown and the rest is NULL.
HEADER = ["store_id", "employee_id", "payment_method_id", "transaction_ts"]


def join_lines_headers(lines: DataFrame, headers: DataFrame, delay: str) -> DataFrame:
    """Lines with their header, whichever comes first, held in state; each line comes out once.

    Both sides wait for each other until the watermarks, `delay` behind the slower stream, have passed. A line without
    a header then comes out with an empty one. Only lines of completed sales and lines that stayed alone are kept;
    `mark` is the later change of the two.
    """
    # State holds whole rows, so they carry what comes out and no more; _line_at is updated_at.
    spare = ["_load_id", "created_at", "updated_at"]
    left = lines.withColumn("_line_at", F.col("updated_at").cast("timestamp")).drop(*spare).withWatermark("_line_at", delay)
    right = headers.select(
        F.col("transaction_id").alias("_id"), *HEADER, "status", F.col("updated_at").cast("timestamp").alias("_header_at")
    ).withWatermark("_header_at", delay)
    reach = F.expr(f"interval {delay}")
    near = F.col("_header_at").between(F.col("_line_at") - reach, F.col("_line_at") + reach)
    joined = left.join(right, (F.col("transaction_id") == F.col("_id")) & near, "leftOuter")
    alone = F.col("_id").isNull()
    unknown = {c: F.coalesce(c, F.lit(UNKNOWN_KEY).cast("bigint")) for c in HEADER if c.endswith("_id")}
    mark = F.greatest(F.col("_line_at").cast("timestamp_ntz"), F.col("_header_at").cast("timestamp_ntz"))
    kept = joined.filter(alone | (F.col("status") == "completed")).withColumns(unknown | {"mark": mark})
    return kept.drop("_id", "_line_at", "_header_at", "status")


def repair_alone(table: SnapshotTable, headers: DataFrame, keys: list[str]) -> None:
    """Settle lines that stayed alone by headers that came after all: they take the header, or go if the sale was none."""
    with passing(table.spark):
        _repair_alone(table, headers, keys)


def _repair_alone(table: SnapshotTable, headers: DataFrame, keys: list[str]) -> None:
    rows = table.read()
    waiting = rows.filter(F.col("store_id") == UNKNOWN_KEY).drop(*HEADER)
    came = latest_state(headers, ["transaction_id"]).select("transaction_id", *HEADER, "status", F.col("updated_at").alias("_at"))
    settled = pin(waiting.join(came, "transaction_id").withColumn("mark", F.greatest("mark", "_at")).drop("_at"), "settled-lines")
    if settled.isEmpty():
        return
    rest = rows.join(broadcast_if_small(settled.select(*keys)), keys, "left_anti")
    table.replace(rest.unionByName(settled.filter("status = 'completed'").drop("status")), keys=keys)


class LandedStreams:
    """Streams of several tables that share a key, landed side by side, and the keyed table made from them.

    A batch of any table is stored, then the rows of every key it touches are made anew from all tables, so it
    does not matter which table's row of a key comes first. A batch delivered again replaces its own files.
    """

    def __init__(self, spark: SparkSession, folder: str, key: str):
        self.spark, self.folder, self.key = spark, folder, key

    def upsert(
        self,
        stream: DataFrame,
        name: str,
        schemas: dict[str, StructType],
        build: Callable[[dict[str, DataFrame]], DataFrame],
        table: SnapshotTable,
        keys: list[str],
        checkpoint: str,
        needs: tuple[str, ...] = ("sales_transaction", "sales_transaction_item"),
    ) -> None:
        """Land new rows of table `name` and upsert what `build` makes of the touched keys."""

        def write(batch: DataFrame, batch_id: int) -> None:
            # The whole checkpoint path names the stream: two streams of one table must not share a folder.
            stream_id = hashlib.sha1(checkpoint.rstrip("/").encode()).hexdigest()
            place = f"{self.folder}/{name}/batch={stream_id}-{batch_id}"
            batch.write.mode("overwrite").parquet(place)
            touched = pin(self.spark.read.schema(batch.schema).parquet(place).select(self.key).distinct(), "touched")
            lo, hi = touched.agg(F.min(self.key), F.max(self.key)).first()
            landed = {n: existing(self.spark, f"{self.folder}/{n}", schemas[n]) for n in needs}
            if lo is None or None in landed.values():
                return
            small = broadcast_if_small(touched)
            near = {n: df.filter(F.col(self.key).between(lo, hi)).join(small, self.key, "left_semi") for n, df in landed.items()}
            table.upsert(build(near), keys, batch=f"{checkpoint}#{batch_id}")

        (
            stream.writeStream.foreachBatch(write)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )


def stream_pit_join(batch: DataFrame, current_dim: Callable[[], DataFrame], key: str, ts: str, take: list[str]):
    """Point-in-time join of one micro-batch with the dimension as it is now; a miss gets key -2."""
    out = pit_join(batch, current_dim(), key, ts, take)
    keys = {c: F.coalesce(c, F.lit(UNKNOWN_KEY).cast("bigint")) for c in take if c.endswith("_key")}
    return out.withColumns(keys)


def repair_unknown(table: SnapshotTable, rebuild: Callable[[], DataFrame]) -> tuple[int, int]:
    """Full refresh of a fact with rows on -2: (unknown rows before, after). RAW is not touched."""
    from tillbook.operators.facts import unknown_rows

    before = unknown_rows(table.read()).count()
    table.replace(rebuild())
    return before, unknown_rows(table.read()).count()
