"""Dashboard queries, reconciliation and the smaller analyses."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillbook.functions.columns import (
    ceil_to_step,
    local_date,
    ratio,
    shift_by_pct,
    to_local,
    to_utc,
)
from tillbook.operators.scale import broadcast_if_small
from tillbook.plans.metrics import query

Tables = dict[str, DataFrame]


def latest_n(df: DataFrame, key: str, n: int) -> DataFrame:
    return df.orderBy(F.col(key).desc()).limit(n)


def pick_k(df: DataFrame, key: str, k: int, seed: int) -> DataFrame:
    """k rows chosen by a seeded hash of the key: the same data and seed give the same rows."""
    draw = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    return df.orderBy(draw, key).limit(k)


# ------------------------------------------------------------------ dashboard
def revenue_by_month(t: Tables) -> DataFrame:
    return query(t, ["net_revenue"], grain="month")


def revenue_by_category(t: Tables) -> DataFrame:
    return query(t, ["net_revenue"], by=["category_name"], order="net_revenue")


def revenue_by_store(t: Tables) -> DataFrame:
    return query(t, ["net_revenue"], by=["store_name"], order="net_revenue")


def promotion_impact(t: Tables, k: int = 20) -> DataFrame:
    where = F.col("promotion_label") != "No promotion"
    return query(t, ["net_revenue", "discount_amount"], ["promotion_label"], where=where, order="net_revenue", limit=k)


def profit_by_month(t: Tables) -> DataFrame:
    return query(t, ["gross_profit"], grain="month")


def revenue_per_employee(t: Tables) -> DataFrame:
    return query(t, ["revenue_per_employee"], by=["store_name"], grain="month")


def profit_by_cashier(fct: DataFrame, dim_employee: DataFrame) -> DataFrame:
    """Receipts, revenue and profit per seller; the fact is summed per key before the join."""
    per_receipt = fct.groupBy("employee_key", "transaction_id").agg(
        F.sum("net_amount").alias("net"), F.sum("gross_profit").alias("profit")
    )
    sums = per_receipt.groupBy("employee_key").agg(
        F.count(F.lit(1)).alias("receipts"), F.sum("net").alias("net"), F.sum("profit").alias("profit")
    )
    people = dim_employee.select("employee_key", "employee_id", "employee_name")
    # A receipt has one seller, so receipts of the versions of a seller add up.
    return (
        sums.join(broadcast_if_small(people), "employee_key")
        .groupBy("employee_id", "employee_name")
        .agg(
            F.sum("receipts").alias("transaction_count"),
            F.sum("net").alias("net_revenue"),
            F.sum("profit").alias("gross_profit"),
        )
    )


def receipts_by_day_part(fct: DataFrame, dim_time: DataFrame) -> DataFrame:
    times = fct.groupBy("time_key").agg(
        F.count_distinct("transaction_id").alias("n"), F.sum("net_amount").alias("net_revenue")
    )
    # A receipt has one time, so receipts per minute add up to receipts per part of the day.
    return (
        times.join(F.broadcast(dim_time.select("time_key", "day_part")), "time_key")
        .groupBy("day_part")
        .agg(F.sum("n").alias("transaction_count"), F.sum("net_revenue").alias("net_revenue"))
    )


def reconcile_totals(fct: DataFrame, enriched: DataFrame) -> DataFrame:
    """Totals of three breakdowns, from one scan, next to the fact total."""
    total = fct.agg(F.lit("fact").alias("breakdown"), F.sum("net_amount").alias("net_revenue"))
    keys = {"category": F.col("category_name"), "store": F.col("store_name"), "month": F.trunc("full_date", "month")}
    rows = enriched.select("net_amount", *[k.alias(n) for n, k in keys.items()])
    sets = [[F.col(n)] for n in keys]
    groups = rows.groupingSets(sets, *keys).agg(F.grouping_id().alias("_set"), F.sum("net_amount").alias("net_revenue"))
    # grouping_id has a bit per column, set where the column is not part of the breakdown
    name = F.when(F.col("_set") == 0b011, "category").when(F.col("_set") == 0b101, "store").otherwise("month")
    return total.unionByName(groups.groupBy(name.alias("breakdown")).agg(F.sum("net_revenue").alias("net_revenue")))


def sold_calendar(fct: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Every calendar day with its attributes and its number of lines."""
    per_day = fct.groupBy("date_key").agg(F.count(F.lit(1)).alias("lines"))
    return dim_date.join(F.broadcast(per_day), "date_key", "left").withColumn("lines", F.coalesce("lines", F.lit(0)))


def sold_clock(fct: DataFrame, dim_time: DataFrame) -> DataFrame:
    """Every minute of the day with its attributes and its number of lines."""
    per_minute = fct.groupBy("time_key").agg(F.count(F.lit(1)).alias("lines"))
    return dim_time.join(F.broadcast(per_minute), "time_key", "left").withColumn("lines", F.coalesce("lines", F.lit(0)))


# ------------------------------------------------------------------ analyses
def anomaly(
    df: DataFrame, by: str, day: str, value: str, floor: float, n: int = 14, times: float = 2.0
) -> DataFrame:
    """Each day against the median of the n days before it: threshold = max(times x median, floor).

    Input has one row per `by` and day with a value. The days between the first and the last of a `by` without one
    count as zero, so n rows are n complete days, and a window holds no more rows than there are days.
    """
    spans = df.groupBy(by).agg(F.explode(F.sequence(F.min(day), F.max(day))).alias(day))
    df = spans.join(df, [by, day], "left").withColumn(value, F.coalesce(value, F.lit(0).cast(df.schema[value].dataType)))
    before = Window.partitionBy(by).orderBy(day).rowsBetween(-n, -1)
    x = F.col(value).cast("double")
    median = F.when(F.count(value).over(before) == n, F.percentile(x, F.lit(0.5)).over(before))
    out = df.withColumn("median_before", median)
    threshold = F.greatest(F.col("median_before") * times, F.lit(float(floor)))
    out = out.withColumn("threshold", F.when(F.col("median_before").isNotNull(), threshold))
    return out.withColumn("is_above", F.coalesce(x > F.col("threshold"), F.lit(False)))


def what_if_margin(changed: DataFrame, by: str) -> DataFrame:
    """Margin before and after a cost change (facts.what_if_cost)."""
    return changed.groupBy(by).agg(
        F.sum("gross_profit").alias("gross_profit"),
        F.sum("new_gross_profit").alias("new_gross_profit"),
        ratio(F.sum("gross_profit"), F.sum("net_amount")).alias("gross_margin"),
        ratio(F.sum("new_gross_profit"), F.sum("net_amount")).alias("new_gross_margin"),
    )


# Steps of the price list and opening hours.
COST_STEP, PRICE_STEP = 100, 1000
OPEN_HOUR, CLOSE_HOUR = 7, 22


def revise_prices(
    df: DataFrame, cost_pct: str, price_pct: str, cost_step: int = COST_STEP, price_step: int = PRICE_STEP
) -> DataFrame:
    """New cost, and a new price where `price_pct` is not NULL. A lowered price stays at or above the old
    cost, and the new cost never passes the new price."""
    cost, price = F.col("unit_cost"), F.col("unit_price")
    repriced = F.greatest(shift_by_pct(price, F.col(price_pct), price_step), ceil_to_step(cost, price_step))
    out = df.withColumn("new_unit_price", F.when(F.col(price_pct).isNull(), price).otherwise(repriced))
    return out.withColumn(
        "new_unit_cost", F.least(shift_by_pct(cost, F.col(cost_pct), cost_step), F.col("new_unit_price"))
    )


def open_intervals(
    df: DataFrame, start: str, end: str, tz: str, open_hour: int = OPEN_HOUR, close_hour: int = CLOSE_HOUR
) -> DataFrame:
    """One row per local day with the opening time inside (start, end], as local wall clock.

    start and end are UTC; an input row explodes into as many days as it spans.
    """
    first, last = local_date(start, tz), local_date(end, tz)
    days = df.filter(F.col(start) < F.col(end)).withColumn("_day", F.explode(F.sequence(first, last)))

    def at(hour: int):
        return to_utc(F.col("_day").cast("timestamp_ntz") + F.make_dt_interval(hours=F.lit(hour)), tz)

    lo, hi = F.greatest(at(open_hour), F.col(start)), F.least(at(close_hour), F.col(end))
    return (
        days.withColumns({"_lo": lo, "_hi": hi})
        .filter("_lo < _hi")
        .withColumns({"open_from": to_local("_lo", tz), "open_to": to_local("_hi", tz)})
        .drop("_day", "_lo", "_hi")
    )
