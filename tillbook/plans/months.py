"""The monthly headcount snapshot kept by months: a night computes the months that something touched.

Touched are the months of days on which an employee whose history changed has another state than before, the
months of rewritten fact slices, and the months from the last report day on. They are computed as runs of
neighbouring months from the versions that overlap them and from the fact slices of these months; every other
month keeps its files. A change of the stores touches every month, because the snapshot is dense.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.functions.columns import LOCAL_TZ
from tillbook.operators import headcount
from tillbook.operators.differences import unequal_rows
from tillbook.operators.dims import DATE_START, real_members
from tillbook.schemas import MART
from tillbook.session import passing
from tillbook.sources.histories import MaintainedHistory
from tillbook.sources.snapshots import SnapshotTable, State

STORES = ["store_key", "store_id", "store_name"]


def next_month(first: date) -> date:
    return (first.replace(day=28) + timedelta(days=4)).replace(day=1)


def months_between(a: date, b: date) -> list[date]:
    """First days of the months from a's to b's."""
    found, at = [], a.replace(day=1)
    while at <= b:
        found.append(at)
        at = next_month(at)
    return found


def runs_of(months: list[date]) -> list[tuple[date, date]]:
    """First and last month of each run of neighbouring months."""
    out: list[tuple[date, date]] = []
    for m in sorted(set(months)):
        if out and next_month(out[-1][1]) == m:
            out[-1] = (out[-1][0], m)
        else:
            out.append((m, m))
    return out


class MonthlyHeadcount:
    def __init__(self, spark: SparkSession, path: str, start: date = DATE_START, tz: str = LOCAL_TZ):
        self.spark, self.start, self.tz = spark, start, tz
        self.table = SnapshotTable(spark, path, slice_by="month_start_date_key")

    def read(self, as_of: date) -> DataFrame:
        """The snapshot; what depends on the report day alone is not stored."""
        rows = self.table.read().withColumns({"is_month_closed": F.last_day("month_start") < F.lit(as_of), "as_of_date": F.lit(as_of)})
        return rows.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in MART["fct_store_headcount_monthly"].fields])

    def _state_months(self, people: MaintainedHistory, since: int, as_of: date) -> list[date]:
        """Months in which someone's state differs; the last day of a month also touches the opening of the next."""
        differing = people.differing(since)
        if differing is None:
            return []
        # A day on which someone is employed neither at its end nor the day before counts nowhere.
        before, after = (self._touching(headcount.state_runs(df, self.start, as_of, self.tz)) for df in differing)
        return [r[0] for r in unequal_rows(before, after).select("touched").distinct().collect()]

    @staticmethod
    def _touching(runs: DataFrame) -> DataFrame:
        """What each month depends on: its own runs and the state at the end of the month before."""
        following = F.add_months("month_start", 1)
        ending = F.col("run_last") == F.last_day("month_start")
        own = runs.withColumnRenamed("month_start", "touched")
        ends = runs.filter(ending).withColumns({"touched": following, "run_first": F.col("run_last")}).drop("month_start")
        return own.unionByName(ends)

    def _stores_changed(self, now: State, dim_store: DataFrame) -> bool:
        asked = real_members(dim_store, "store_key").select(STORES)
        one = max(now.directories)
        held = self.table.rows_of({one: now.directories[one]}).select(STORES)
        return not (held.exceptAll(asked).isEmpty() and asked.exceptAll(held).isEmpty())

    def dirty_months(self, now: State, people: MaintainedHistory, fact: SnapshotTable, dim_store: DataFrame, as_of: date) -> list[date]:
        everything = months_between(self.start, as_of)
        if not now.directories:
            return everything
        last, fact_version, people_version = now.last_batch.split("|")
        last = date.fromisoformat(last)
        if last > as_of or self._stores_changed(now, dim_store):
            return everything
        sold = [date(int(s[:4]), int(s[4:]), 1) for s in fact.changed_slices(int(fact_version)) if len(s) == 6]
        touched = {*months_between(last, as_of), *sold, *self._state_months(people, int(people_version), as_of)}
        return sorted(touched & set(everything))

    def refresh(self, people: MaintainedHistory, fact: SnapshotTable, dim_store: DataFrame, dim_date: DataFrame, as_of: date) -> list[date]:
        """Compute and commit the touched months; returns them."""
        with passing(self.spark):
            return self._refresh(people, fact, dim_store, dim_date, as_of)

    def _refresh(self, people: MaintainedHistory, fact: SnapshotTable, dim_store: DataFrame, dim_date: DataFrame, as_of: date) -> list[date]:
        now, fact_now, people_now = self.table.state(), fact.state(), people.table.state()
        dirty = self.dirty_months(now, people, fact, dim_store, as_of)
        history, parts = people.versions(), []
        for first, last in runs_of(dirty):
            until = min(next_month(last) - timedelta(days=1), as_of)
            slices = {f"{m:%Y%m}" for m in months_between(first, last)}
            held = {s: d for s, d in fact_now.directories.items() if s in slices}
            sales = fact.rows_of(held or fact_now.directories)
            sales = sales if held else sales.limit(0)
            daily = headcount.daily_state(history, first, until, self.tz)
            parts.append(headcount.headcount_monthly(daily, dim_store, sales, dim_date, until, first).drop("is_month_closed", "as_of_date"))
        if parts:
            rows = parts[0]
            for part in parts[1:]:
                rows = rows.unionByName(part)
            gone = [s for s in now.directories if s > f"{as_of:%Y%m%d}"]
            names = [f"{m:%Y%m%d}" for m in dirty]
            note = f"{as_of}|{fact_now.version}|{people_now.version}"
            self.table.rewrite(now, rows, [*names, *gone], note)
        return dirty
