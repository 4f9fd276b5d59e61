"""A Parquet table whose writes are whole commits: replace, and upsert by key.

A write goes to new directories, one per slice of the table, and becomes visible by one log file that bears
the number of the version: a file of that name can appear only once, so of two writers that began on one
version the second fails, and there is no claim that a lost writer could leave behind. Readers of the version
before are undisturbed, a failed write leaves no trace in the log, and an upsert rewrites only the slices it
touches. On a v2 lake table MERGE INTO does the same.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tillbook.operators.quality import ContractError, contract_mismatches
from tillbook.operators.scale import broadcast_if_small, in_ranges, key_ranges
from tillbook.session import passing, pin, store

# The mark is ISO text in the file.
_LOG = "version bigint, batch string, slice string, directory string, mark string"


@dataclass(frozen=True)
class State:
    """A table as one read of its log shows it."""

    version: int
    directories: dict[str, str]
    high_water: datetime | None
    has_batch: bool
    last_batch: str | None


class SnapshotTable:
    """`slice_by` is a column of few values, such as the month of a fact. None keeps one slice.

    `mark` is a change time column: its largest value per slice is logged at commit, so the watermark of a
    table is read from the log and not from the rows.
    """

    def __init__(self, spark: SparkSession, path: str, slice_by: str | None = None, mark: str | None = None):
        self.spark, self.path, self.slice_by, self.mark = spark, path, slice_by, mark

    # -------------------------------------------------------------- reading
    def _log(self) -> DataFrame | None:
        try:
            log = self.spark.read.schema(_LOG).json(f"{self.path}/log")
        except AnalysisException as missing:
            if missing.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        return log.withColumn("mark", F.col("mark").cast("timestamp_ntz"))

    def state(self, batch: str | None = None, at: int | None = None) -> State:
        """Version, live slices and watermark in one pass over the log; as few rows as the table has slices.

        `at` shows the table as it was at that version.
        """
        log = self._log()
        if log is None:
            return State(0, {}, None, False, None)
        if at is not None:
            log = log.filter(F.col("version") <= at)
        newest = F.max_by(F.struct("directory", "mark", "version", "batch"), "version").alias("row")
        known = F.coalesce(F.bool_or(F.col("batch") == batch), F.lit(False)) if batch is not None else F.lit(False)
        rows = log.groupBy("slice").agg(newest, known.alias("known")).collect()
        live = [r for r in rows if r["row"]["directory"] is not None]
        last = max((r["row"] for r in rows), key=lambda r: r["version"], default=None)
        return State(
            last["version"] if last else 0,
            {r["slice"]: r["row"]["directory"] for r in live},
            max((r["row"]["mark"] for r in live if r["row"]["mark"] is not None), default=None),
            any(r["known"] for r in rows),
            last["batch"] if last else None,
        )

    def batches(self) -> set[str]:
        """Every batch ever committed; one for each write."""
        log = self._log()
        return set() if log is None else {r[0] for r in log.select("batch").distinct().collect() if r[0] is not None}

    def changed_slices(self, since: int) -> list[str]:
        """Slices written after a version."""
        log = self._log()
        return [] if log is None else [r[0] for r in log.filter(F.col("version") > since).select("slice").distinct().collect()]

    def version(self) -> int:
        return self.state().version

    def directories(self) -> dict[str, str]:
        return self.state().directories

    def high_water(self):
        """Largest mark of the table, None while it is empty."""
        return self.state().high_water

    def has_batch(self, batch: str) -> bool:
        return self.state(batch).has_batch

    def exists(self) -> bool:
        return bool(self.directories())

    def read(self) -> DataFrame:
        return self.rows_of(self.directories())

    def rows_of(self, found: dict[str, str]) -> DataFrame:
        """Rows of some slices, as a State names them; no other directory is listed."""
        if not found:
            raise FileNotFoundError(f"{self.path} has no committed data")
        return self.spark.read.parquet(*found.values())

    # -------------------------------------------------------------- writing
    def _next(self) -> int:
        """Version that a write beginning now will commit."""
        return self.version() + 1

    def _commit(self, version: int, rows: list[dict]) -> None:
        """Write the log file beside the log, then give it the version's name, which fails where it exists."""
        context = self.spark.sparkContext
        jvm, conf = context._jvm.org.apache.hadoop.fs, context._jsc.hadoopConfiguration()
        pending, name = jvm.Path(f"{self.path}/log/_pending-{uuid.uuid4().hex}"), jvm.Path(f"{self.path}/log/{version:012d}.json")
        files = pending.getFileSystem(conf)
        out = files.create(pending)
        try:
            out.write("".join(json.dumps(r) + "\n" for r in rows).encode())
        finally:
            out.close()
        try:
            never = context._gateway.new_array(jvm.Options.Rename, 0)
            jvm.FileContext.getFileContext(pending.toUri(), conf).rename(pending, name, never)
        except Py4JJavaError as failed:
            files.delete(pending, False)
            if "FileAlreadyExists" in failed.java_exception.getClass().getName():
                raise WriterConflict(f"version {version} of {self.path} was written by another writer") from failed
            raise

    def _slice(self):
        return F.lit("all") if self.slice_by is None else F.col(self.slice_by).cast("string")

    def _write(
        self, df: DataFrame, version: int, batch: str | None, touched: list[str], keys: list[str] | None = None, dealt: bool = False
    ) -> None:
        """Write slices, then commit. A touched slice that got no rows is committed as gone.

        `keys` are checked on the written rows before the commit, so the source is computed once. `dealt` rows are
        written where they are, without a shuffle for even files.
        """
        data = f"{self.path}/data/v{version}-{uuid.uuid4().hex[:8]}"
        sliced = df.withColumn("in_slice", self._slice())
        # Rebalance keeps files even: a large slice is split, small pieces are merged.
        store(sliced if dealt else sliced.hint("rebalance", "in_slice"), data, ("in_slice",))
        stored = self.spark.read.schema(df.schema.add("in_slice", "string")).parquet(data)
        if keys:
            _assert_unique(stored, keys)
        mark = F.max(self.mark) if self.mark else F.lit(None).cast("timestamp_ntz")
        written = {r[0]: r[1] for r in stored.groupBy("in_slice").agg(mark).collect()}
        rows = [(s, f"{data}/in_slice={s}", None if m is None else m.isoformat(sep=" ")) for s, m in written.items()]
        rows += [(s, None, None) for s in touched if s not in written]
        self._log_rows(version, batch, rows)

    def _log_rows(self, version: int, batch: str | None, rows: list[tuple]) -> None:
        names = ("slice", "directory", "mark")
        if rows:
            self._commit(version, [{"version": version, "batch": batch} | dict(zip(names, r, strict=True)) for r in rows])

    def point(self, now: State, directories: dict[str, str | None], batch: str | None = None) -> None:
        """Commit slices that were written elsewhere; None takes a slice away."""
        self._log_rows(now.version + 1, batch, [(s, d, None) for s, d in directories.items()])

    def replace(self, df: DataFrame, batch: str | None = None, keys: list[str] | None = None) -> None:
        """Full refresh: the new rows are the whole table; `keys` must be unique in them."""
        now = self.state(batch)
        if not now.has_batch:
            self._write(df, now.version + 1, batch, list(now.directories), keys)

    def rewrite(self, now: State, df: DataFrame, touched: list[str], batch: str | None = None, dealt: bool = False) -> None:
        """Put df in the place of some slices, as the version after the state that it was derived from."""
        self._write(df, now.version + 1, batch, touched, dealt=dealt)

    def upsert(self, src: DataFrame, keys: list[str], batch: str | None = None) -> None:
        """Replace rows with the same keys and add the others. A batch id is applied once.

        With a `mark`, a stored row with a later mark than the new one stays, so batches may come in any order.
        """
        with passing(self.spark):
            self._upsert(src, keys, batch)

    def _upsert(self, src: DataFrame, keys: list[str], batch: str | None) -> None:
        # All that the write builds on comes from this one read of the log, and only the next version may follow it.
        now = self.state(batch)
        version, found = now.version + 1, now.directories
        if now.has_batch:
            return
        if not found:
            self._write(src, version, batch, [], keys)
            return
        target = self.rows_of(found)
        assert_same_schema(src, target)
        src = src if hasattr(src, "pinned_at") else pin(src, "upsert")
        copies, lo, hi, earliest = _key_range(src, keys, self.mark)
        if copies > 1:
            raise ValueError(f"source rows repeat on {keys}")
        if lo is None:
            return
        # Rows that all carry the table's latest mark or a later one cannot be outdated: the usual night.
        latest = now.high_water
        if latest is not None and (earliest is None or earliest < latest):
            src = pin(self._not_outdated(src, target, keys, lo, hi), "upsert-newer")
            _, lo, hi, _ = _key_range(src, keys)
            if lo is None:
                return
        new_keys = broadcast_if_small(src.select(*keys))
        # A row may sit in another slice than its new version, so the old place is looked up by key.
        # Only key columns are read, and the key ranges let Parquet skip row groups.
        near = target.filter(_near(src, keys[0], lo, hi)).withColumn("in_slice", self._slice())
        old = near.join(new_keys, keys, "left_semi").select("in_slice")
        places = old.union(src.select(self._slice())).distinct()
        touched = [r[0] for r in places.collect()]
        present = [found[s] for s in touched if s in found]
        merged = src
        if present:
            merged = self.spark.read.parquet(*present).join(new_keys, keys, "left_anti").unionByName(src)
        self._write(merged, version, batch, touched)

    def _not_outdated(self, src: DataFrame, target: DataFrame, keys: list[str], lo, hi) -> DataFrame:
        """Rows of src whose key is new or whose mark is not before the stored one; a NULL mark is the earliest."""
        stored = target.filter(F.col(keys[0]).between(lo, hi)).select(*keys, F.col(self.mark).alias("_stored_mark"))
        joined = src.join(stored, keys, "left")
        return joined.filter(
            F.col("_stored_mark").isNull() | F.coalesce(F.col(self.mark) >= F.col("_stored_mark"), F.lit(False))
        ).select(src.columns)


def _near(src: DataFrame, key: str, lo, hi) -> Column:
    """Rows whose key may be in src: ranges of touched keys, or the one range of a key that is no whole number."""
    if isinstance(src.schema[key].dataType, IntegralType):
        return in_ranges(key, key_ranges(src, key))
    return F.col(key).between(lo, hi)


class WriterConflict(RuntimeError):
    """Another writer committed since this write began."""


def assert_same_schema(df: DataFrame, target: DataFrame) -> None:
    """Stop before a write that would change the shape of the target or the exact type of a column."""
    wrong = [f"{c}: {reason}" for c, _, _, reason in contract_mismatches(df.schema, target.schema)]
    types = {f.name: f.dataType for f in target.schema.fields}
    wrong += [
        f"{f.name}: {f.dataType.simpleString()} is not {types[f.name].simpleString()}"
        for f in df.schema.fields
        if f.name in types and f.dataType != types[f.name]
    ]
    if wrong:
        raise ContractError("; ".join(wrong))


def _key_range(src: DataFrame, keys: list[str], mark: str | None = None) -> tuple:
    """(most rows of one key, least and greatest first key, earliest mark or None if one is missing) in one pass."""
    earliest, unmarked = (F.min(mark), F.count_if(F.col(mark).isNull())) if mark else (F.lit(None), F.lit(1))
    counted = src.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), earliest.alias("_mark"), unmarked.alias("_unmarked"))
    copies, lo, hi, mark_at, bare = counted.agg(
        F.max("_n"), F.min(keys[0]), F.max(keys[0]), F.min("_mark"), F.sum("_unmarked")
    ).first()
    return copies or 0, lo, hi, None if bare else mark_at


def _assert_unique(src: DataFrame, keys: list[str]) -> None:
    if not src.groupBy(*keys).count().filter("count > 1").isEmpty():
        raise ValueError(f"source rows repeat on {keys}")


class StaleChange(RuntimeError):
    """A change event no longer matches the stored values."""


def apply_changes(
    target: DataFrame, events: DataFrame, key: str, guards: dict[str, str], sets: dict[str, str]
) -> DataFrame:
    """Target with the events applied, or an error when any event does not match; all or nothing.

    `guards` maps a target column to the event column with its expected value, `sets` maps a target column
    to the event column with its new value.
    """
    _assert_unique(events, [key])
    old = target.select(key, *[F.col(c).alias(f"_was_{c}") for c in guards])
    same = F.lit(True)
    for c, expected in guards.items():
        same = same & F.col(f"_was_{c}").eqNullSafe(F.col(expected))
    # Every guard column NULL and expected NULL still needs a target row, hence the marker.
    checked = events.join(old.withColumn("_hit", F.lit(True)), key, "left")
    stale = checked.filter(F.col("_hit").isNull() | ~same)
    n = stale.count()
    if n:
        raise StaleChange(f"{n} change events do not match the stored values; nothing is applied")
    new = events.select(key, *[F.col(e).alias(f"_new_{c}") for c, e in sets.items()], F.lit(True).alias("_hit"))
    out = target.join(broadcast_if_small(new), key, "left")
    hit = F.col("_hit").isNotNull()
    changed = {c: F.when(hit, F.col(f"_new_{c}")).otherwise(F.col(c)) for c in sets}
    return out.withColumns(changed).select(target.columns)
