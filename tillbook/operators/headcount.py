"""Employee state per local day and the dense monthly store snapshot."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillbook.functions.columns import (
    LOCAL_TZ,
    employed_on,
    is_distinct,
    local_date,
    local_day_end,
    yyyymmdd,
)
from tillbook.operators.dims import DATE_START, real_members
from tillbook.operators.scale import broadcast_if_small
from tillbook.schemas import MART


def held_days(history: DataFrame, start: date, as_of: date, tz: str = LOCAL_TZ) -> DataFrame:
    """Versions with the first and last local day they hold at its end, clipped to the report days.

    A version holds day d when valid_from <= end of d < valid_to. Days run from the day before `start`.
    Each day of an employee belongs to one version, so an employee keeps at most one version per day.
    """
    from_day, to_day = local_date("valid_from", tz), local_date("valid_to", tz)
    first = F.when(local_day_end(F.date_sub(from_day, 1), tz) >= F.col("valid_from"), F.date_sub(from_day, 1))
    last = F.when(local_day_end(F.date_sub(to_day, 1), tz) < F.col("valid_to"), F.date_sub(to_day, 1))
    return history.withColumns(
        {
            "first_day": F.greatest(F.coalesce(first, from_day), F.date_sub(F.lit(start), 1)),
            "last_day": F.least(F.coalesce(last, F.date_sub(to_day, 2)), F.lit(as_of)),
        }
    ).filter("first_day <= last_day")


def daily_state(history: DataFrame, start: date, as_of: date, tz: str = LOCAL_TZ) -> DataFrame:
    """Employee state at the end of each local day, with the state of the day before.

    Only versions are shuffled: the day before the first day of a version is the last day of the version
    before it, so the window runs on versions and the days are exploded after it without a shuffle.
    """
    versions = _held_versions(history, start, as_of, tz)
    days = versions.withColumn("calendar_date", F.explode(F.sequence("first_day", "last_day")))
    return _state_on(days, "calendar_date")


def _held_versions(history: DataFrame, start: date, as_of: date, tz: str) -> DataFrame:
    """held_days with the last day and store of the version before."""
    along = Window.partitionBy("employee_id").orderBy("first_day")
    # A fixed number of partitions: AQE would merge the small version rows and so the many days behind them.
    parts = int(history.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    held = held_days(history, start, as_of, tz).repartition(parts, "employee_id")
    return held.withColumns({"_prev_day": F.lag("last_day").over(along), "_prev_store": F.lag("store_id").over(along)})


def _state_on(rows: DataFrame, day_column: str, *rest: str) -> DataFrame:
    """State on one day of a version and on the day before."""
    day, first = F.col(day_column), F.col(day_column) == F.col("first_day")
    prev_day = F.when(first, F.col("_prev_day")).otherwise(F.date_sub(day, 1))
    return rows.withColumn("_prev_day", prev_day).select(
        "employee_id",
        day_column,
        *rest,
        employed_on("start_date", "end_date", day).alias("is_employed"),
        "store_id",
        F.when(F.col("_prev_day").isNotNull(), employed_on("start_date", "end_date", F.col("_prev_day"))).alias(
            "prev_is_employed"
        ),
        F.when(first, F.col("_prev_store")).otherwise(F.col("store_id")).alias("prev_store_id"),
    )


STATE = ["is_employed", "store_id", "prev_is_employed", "prev_store_id"]


def state_runs(history: DataFrame, start: date, as_of: date, tz: str = LOCAL_TZ) -> DataFrame:
    """daily_state as the longest runs of days of a month with one state: (employee_id, month_start, run_first, run_last, state).

    Days on which someone is employed neither at the end nor the day before are left out. Inside a version the state
    changes only on the day after its first day and where the first or last working day is passed, so no day is exploded.
    """
    first, last = F.col("first_day"), F.col("last_day")
    edges = [first, F.date_add(first, 1), *[F.date_add(F.col(c), i) for c in ("start_date", "end_date") for i in (0, 1)]]
    months = F.expr("sequence(trunc(first_day, 'month'), trunc(last_day, 'month'), interval 1 month)")
    begins = F.array_sort(F.array_distinct(F.filter(F.concat(F.array(*edges), months), lambda d: d.between(first, last))))
    pieces = _held_versions(history, start, as_of, tz).withColumn("_begins", begins)
    pieces = pieces.select("*", F.posexplode("_begins").alias("_i", "run_first"))
    ends = F.coalesce(F.date_sub(F.get(F.col("_begins"), F.col("_i") + 1), 1), last)
    pieces = _state_on(pieces.withColumn("run_last", ends), "run_first", "run_last")
    pieces = pieces.filter(F.col("is_employed") | F.coalesce("prev_is_employed", F.lit(False)))
    pieces = pieces.withColumn("month_start", F.trunc("run_first", "month"))

    # Neighbouring pieces of one state are one run, however many versions they come from.
    along = Window.partitionBy("employee_id").orderBy("run_first")
    before = F.lag(F.struct("month_start", "run_last", *STATE)).over(along)
    same = F.col("_before").isNotNull() & (F.date_add(F.col("_before.run_last"), 1) == F.col("run_first"))
    for c in ("month_start", *STATE):
        same = same & F.col(f"_before.{c}").eqNullSafe(F.col(c))
    begun = pieces.withColumn("_before", before).withColumn("_new", F.when(same, 0).otherwise(1))
    numbered = begun.withColumn("_run", F.sum("_new").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    grouped = numbered.groupBy("employee_id", "_run", "month_start", *STATE)
    return grouped.agg(F.min("run_first").alias("run_first"), F.max("run_last").alias("run_last")).drop("_run")


def employed_by_day(people: DataFrame, start: date, as_of: date) -> DataFrame:
    """Employees per day, once without and once with their last working day. One row per person in."""
    first, last = F.greatest("start_date", F.lit(start)), F.least(F.coalesce("end_date", F.lit(as_of)), F.lit(as_of))
    days = people.filter(first <= last).withColumn("day", F.explode(F.sequence(first, last)))
    return days.groupBy("day").agg(
        F.count_if(employed_on("start_date", "end_date", F.col("day"))).alias("employed_at_end"),
        F.count_if(employed_on("start_date", "end_date", F.col("day"), inclusive_end=True)).alias("can_sell"),
    )


KINDS = ["joiner", "leaver", "transfer_in", "transfer_out"]


def movements(daily: DataFrame) -> DataFrame:
    """One row per movement at the store it affects. The first day has no day before: no movement."""
    now, before = F.col("is_employed"), F.col("prev_is_employed")
    moved = now & before & (F.col("store_id") != F.col("prev_store_id"))
    changed = before.isNotNull() & (is_distinct(now, before) | is_distinct("store_id", "prev_store_id"))

    def entry(when, store: str, kind: str):
        return F.when(when, F.struct(F.col(store).alias("store_id"), F.lit(kind).alias("movement")))

    found = F.array_compact(
        F.array(
            entry(now & ~before, "store_id", "joiner"),
            entry(before & ~now, "prev_store_id", "leaver"),
            entry(moved, "store_id", "transfer_in"),
            entry(moved, "prev_store_id", "transfer_out"),
        )
    )
    rows = daily.filter(changed).select("employee_id", "calendar_date", F.explode(found).alias("m"))
    return rows.select("employee_id", "calendar_date", "m.*")


def count_by_kind(moves: DataFrame) -> DataFrame:
    """Movements per store and month, one column per kind."""
    month = F.trunc("calendar_date", "month").alias("month_start")
    names = {"joiner": "joiners", "leaver": "leavers", "transfer_in": "transfers_in", "transfer_out": "transfers_out"}
    counts = [F.count_if(F.col("movement") == k).alias(names[k]) for k in KINDS]
    return moves.groupBy("store_id", month).agg(*counts)


def _levels(daily: DataFrame, start: date, as_of: date) -> DataFrame:
    """Employed staff at month ends: closing of the month, opening of the next one."""
    day = F.col("calendar_date")
    month_end = day == F.last_day(day)
    opening = month_end & (day < F.lit(as_of))
    closing = (day >= F.lit(start)) & (month_end | (day == F.lit(as_of)))

    def entry(when, month, o: int, c: int):
        return F.when(when, F.struct(month.alias("month_start"), F.lit(o).alias("o"), F.lit(c).alias("c")))

    both = F.array_compact(
        F.array(entry(opening, F.date_add(day, 1), 1, 0), entry(closing, F.trunc(day, "month"), 0, 1))
    )
    ends = daily.filter(F.col("is_employed") & (month_end | (day == F.lit(as_of))))
    rows = ends.select("store_id", F.explode(both).alias("e")).select("store_id", "e.*")
    return rows.groupBy("store_id", "month_start").agg(
        F.sum("o").alias("opening_headcount"), F.sum("c").alias("closing_headcount")
    )


def revenue_by_store_month(fct: DataFrame, dim_store: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Net revenue per store and local month; the fact is summed per key before any join."""
    sums = fct.groupBy("store_key", "date_key").agg(F.sum("net_amount").alias("net_revenue"))
    days = dim_date.select("date_key", F.trunc("full_date", "month").alias("month_start"))
    stores = broadcast_if_small(dim_store.select("store_key", "store_id"))
    return (
        sums.join(F.broadcast(days), "date_key")
        .join(stores, "store_key")
        .groupBy("store_id", "month_start")
        .agg(F.sum("net_revenue").alias("net_revenue"))
    )


def dense_spine(dim_store: DataFrame, start: date, as_of: date) -> DataFrame:
    """Every real store with every month up to the as-of month, by exploding each store row."""
    months = F.expr(f"sequence(date'{start}', date'{as_of.replace(day=1)}', interval 1 month)")
    stores = real_members(dim_store, "store_key").select("store_key", "store_id", "store_name")
    return stores.withColumn("month_start", F.explode(months))


def fill_left(spine: DataFrame, agg: DataFrame, on: list[str], zero_cols: list[str]) -> DataFrame:
    """Every spine row with its aggregates, zero where there are none."""
    out = spine.join(agg, on, "left")
    return out.withColumns({c: F.coalesce(c, F.lit(0)) for c in zero_cols})


def headcount_monthly(
    daily: DataFrame,
    dim_store: DataFrame,
    fct: DataFrame,
    dim_date: DataFrame,
    as_of: date,
    start: date = DATE_START,
) -> DataFrame:
    """Dense store x month snapshot.

    Levels, movements and revenue are stacked and summed once per store and month, so the spine meets one
    small table in place of four.
    """
    levels, moves = _levels(daily, start, as_of), count_by_kind(movements(daily))
    stacked = levels.unionByName(moves, allowMissingColumns=True).unionByName(
        revenue_by_store_month(fct, dim_store, dim_date), allowMissingColumns=True
    )
    measures = [c for c in stacked.columns if c not in ("store_id", "month_start")]
    summed = stacked.groupBy("store_id", "month_start").agg(*[F.sum(c).alias(c) for c in measures])
    filled = fill_left(dense_spine(dim_store, start, as_of), summed, ["store_id", "month_start"], measures)
    both = F.col("opening_headcount") + F.col("closing_headcount")
    out = filled.withColumns(
        {
            "month_start_date_key": yyyymmdd("month_start"),
            "average_headcount": both.cast("decimal(18,0)") / 2,
            "is_month_closed": F.last_day("month_start") < F.lit(as_of),
            "as_of_date": F.lit(as_of),
        }
    )
    fields = MART["fct_store_headcount_monthly"].fields
    return out.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])


def recount(history: DataFrame, start: date, as_of: date, tz: str = LOCAL_TZ) -> DataFrame:
    """Closing headcount straight from history, without the daily table.

    Each version is exploded into the months whose closing day it holds, so there is no range join.
    """
    held = held_days(history, start, as_of, tz).withColumn("first_day", F.greatest("first_day", F.lit(start)))
    months = F.expr("sequence(trunc(first_day, 'month'), trunc(last_day, 'month'), interval 1 month)")
    rows = held.filter("first_day <= last_day").withColumn("month_start", F.explode(months))
    closing = F.least(F.last_day("month_start"), F.lit(as_of))
    kept = rows.filter(closing.between(F.col("first_day"), F.col("last_day"))).filter(
        employed_on("start_date", "end_date", closing)
    )
    return kept.groupBy("store_id", "month_start").agg(F.count_distinct("employee_id").alias("headcount"))
