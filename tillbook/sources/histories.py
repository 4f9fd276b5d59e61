"""A history that is kept up to date: only keys with new change rows are versioned again.

The table holds every distinct change row with the version it starts, if any, in slices by hash of the key. A
merge reads the slices of the changed keys, versions those keys from their stored and new rows, and copies the
other rows of these slices as they lie: they are neither shuffled nor sorted. A row that comes late and is older
than stored ones splits the version it falls into, because all change times of its key are at hand. Rows and
versions become visible in one commit, and merging a load again changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.operators.differences import unequal_rows
from tillbook.operators.history import scd2
from tillbook.operators.scale import DEFAULT, Limits, broadcast_if_small
from tillbook.session import passing, pin
from tillbook.sources.snapshots import SnapshotTable

VERSION = ["valid_from", "valid_to", "is_current"]


class MaintainedHistory:
    def __init__(
        self,
        spark: SparkSession,
        path: str,
        key: str,
        tracked: list[str],
        type1: list[str],
        order_by: str = "updated_at",
        buckets: int = 64,
        limits: Limits = DEFAULT,
    ):
        self.spark, self.key, self.tracked, self.type1, self.order_by = spark, key, tracked, type1, order_by
        self.buckets, self.limits = buckets, limits
        self.table = SnapshotTable(spark, path, slice_by="bucket")

    def _versions(self, rows: DataFrame) -> DataFrame:
        started = rows.filter("valid_from is not null")
        return started.select(self.key, "latest.*", *self.tracked, *VERSION) if self.type1 else started.select(self.key, *self.tracked, *VERSION)

    def versions(self) -> DataFrame:
        """The history, as scd2 over all rows ever merged gives it."""
        return self._versions(self.table.read())

    def _bucket(self):
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def kept(self, stored: DataFrame, changed_keys: DataFrame) -> DataFrame:
        """Rows of other keys in slices that are rewritten; the changed keys are sent to them."""
        return stored.join(broadcast_if_small(changed_keys, self.limits), self.key, "left_anti")

    def versioned(self, points: DataFrame) -> DataFrame:
        """Change rows with the versions they start and the latest Type 1 values of their key."""
        found = scd2(points, self.key, self.order_by, self.tracked, self.type1, self.limits, started=True)
        latest = F.struct(*self.type1) if self.type1 else F.lit(None).cast("struct<none:int>")
        found = found.select(self.key, self.order_by, *VERSION, latest.alias("latest"))
        return points.join(found, [self.key, self.order_by], "left").withColumn("bucket", self._bucket())

    def merge(self, rows: DataFrame, batch: str | None = None, again: bool = False) -> bool:
        """Bring new change rows in, in any order of loads; False if the batch was merged before or holds nothing new.

        With `again` a batch that was merged is merged once more, which adds only what it did not hold then. Two
        different rows of a key with one change time are an error, as in scd2.
        """
        with passing(self.spark):
            return self._merge(rows, batch, again)

    def _merge(self, rows: DataFrame, batch: str | None, again: bool) -> bool:
        columns = [self.key, self.order_by, *self.tracked, *self.type1]
        now = self.table.state(batch)
        if now.has_batch and not again:
            return False
        new = pin(rows.select(columns).distinct(), "history-new")
        keys = pin(new.select(self.key, self._bucket().cast("string").alias("slice")).distinct(), "history-keys")
        touched = [r[0] for r in keys.select("slice").distinct().collect()]
        if not touched:
            return False
        keys = keys.select(self.key)
        present = {s: now.directories[s] for s in touched if s in now.directories}
        points, stored = new, None
        if present:
            stored = self.table.rows_of(present)
            old = stored.join(broadcast_if_small(keys, self.limits), self.key, "left_semi").select(columns)
            points = old.unionByName(new).distinct()
        points = pin(points, "history-points")
        if not points.groupBy(self.key, self.order_by).count().filter("count > 1").isEmpty():
            raise ValueError(f"change rows repeat on {self.key} and {self.order_by}")
        changed = self.versioned(points).hint("rebalance", "bucket")
        merged = changed if stored is None else self.kept(stored, keys).unionByName(changed)
        self.table.rewrite(now, merged, touched, batch, dealt=True)
        return True

    def differing(self, since: int) -> tuple[DataFrame, DataFrame] | None:
        """(before, after): versions of the keys whose versions changed after a table version; None if no slice did.

        Only slices written since are read.
        """
        slices = self.table.changed_slices(since)
        if not slices:
            return None
        then, now = self.table.state(at=since).directories, self.table.directories()
        after = self._versions(self.table.rows_of({s: now[s] for s in slices if s in now}))
        old = {s: then[s] for s in slices if s in then}
        before = self._versions(self.table.rows_of(old)) if old else after.limit(0)
        key = unequal_rows(before, after).select(self.key).distinct()
        key = broadcast_if_small(pin(key, "differing-keys"), self.limits)
        return before.join(key, self.key, "left_semi"), after.join(key, self.key, "left_semi")
