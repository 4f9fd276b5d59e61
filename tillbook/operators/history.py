"""Versioned history from append-only change rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillbook.functions.columns import is_distinct, open_end, open_start
from tillbook.operators.scale import DEFAULT, Limits, group_of, neighbours, time_cuts, with_segment


def dedupe_copies(df: DataFrame, tech_cols: list[str] = ("_load_id",)) -> DataFrame:
    """Collapse rows that agree on every business column; versions stay.

    A hash aggregate on all columns: copies merge before the shuffle, and no group can be large.
    """
    return df.drop(*tech_cols).distinct()


def scd2(
    df: DataFrame,
    key: str,
    order_by: str,
    tracked: list[str],
    type1: list[str] = (),
    limits: Limits = DEFAULT,
    counted: DataFrame | None = None,
    started: bool = False,
) -> DataFrame:
    """Version rows of each key with [valid_from, valid_to) and is_current.

    A version starts where any tracked column differs from the row before it; Type 1 columns carry the
    latest value of the key on every version. Needs (key, order_by) unique apart from exact copies.
    `counted` is a cheaper table to count rows per key on, such as RAW before copies are removed. With `started`,
    each version also shows the change time of the row it starts with.
    """
    cuts = time_cuts(df if counted is None else counted, [key], order_by, limits)
    rows = with_segment(df.select(key, order_by, *tracked, *type1), cuts, [key], order_by)
    rows = _with_latest(rows, key, order_by, type1, cuts)

    seen = neighbours(rows, [key], order_by, prev=tracked, cuts=cuts)
    changed = F.col("_prev").isNull()
    for c in tracked:
        changed = changed | is_distinct(F.col(f"_prev.{c}"), c)
    starts = (
        seen.filter(changed)
        .withColumn("valid_from", F.when(F.col("_prev").isNull(), open_start()).otherwise(F.col(order_by)))
        .drop("_prev")
    )
    versions = neighbours(starts, [key], order_by, nxt=[order_by], cuts=cuts)
    return versions.select(
        key,
        *([order_by] if started else []),
        *type1,
        *tracked,
        "valid_from",
        F.coalesce(F.col(f"_next.{order_by}"), open_end()).alias("valid_to"),
        F.col("_next").isNull().alias("is_current"),
    )


def _with_latest(rows: DataFrame, key: str, order_by: str, type1: list[str], cuts: DataFrame | None) -> DataFrame:
    if not type1:
        return rows
    whole = (
        Window.partitionBy(*group_of([key], cuts))
        .orderBy(order_by)
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    out = rows.withColumns({c: F.last(c).over(whole) for c in type1})
    if cuts is None:
        return out
    latest = (
        rows.join(F.broadcast(cuts.select(key)), key, "left_semi")
        .groupBy(key)
        .agg(F.max_by(F.struct(*type1), order_by).alias("_latest"))
    )
    out = out.join(F.broadcast(latest), key, "left")
    known = F.col("_latest").isNotNull()
    return out.withColumns({c: F.when(known, F.col(f"_latest.{c}")).otherwise(F.col(c)) for c in type1}).drop("_latest")


# Natural key, tracked and Type 1 columns of the two histories.
HISTORIES = {
    "product": ("product_id", ["category_id", "brand_id", "unit_price", "unit_cost"], ["product_sku", "product_name"]),
    "employee": ("employee_id", ["store_id"], ["employee_name", "salary", "address", "start_date", "end_date"]),
}


def named_employees(stg_employee: DataFrame) -> DataFrame:
    return stg_employee.withColumn("employee_name", F.concat("first_name", F.lit(" "), "last_name"))


def product_history(
    stg_product: DataFrame, limits: Limits = DEFAULT, counted: DataFrame | None = None
) -> DataFrame:
    key, tracked, type1 = HISTORIES["product"]
    return scd2(stg_product, key, "updated_at", tracked, type1, limits, counted)


def employee_history(
    stg_employee: DataFrame, limits: Limits = DEFAULT, counted: DataFrame | None = None
) -> DataFrame:
    key, tracked, type1 = HISTORIES["employee"]
    return scd2(named_employees(stg_employee), key, "updated_at", tracked, type1, limits, counted)


def latest_state(raw: DataFrame, pk: list[str], order_by: str = "updated_at") -> DataFrame:
    """Current row per key of an append-only table; max_by combines map-side."""
    rest = [c for c in raw.columns if c not in pk]
    return raw.groupBy(*pk).agg(F.max_by(F.struct(*rest), order_by).alias("_row")).select(*pk, "_row.*")


def wrong_pins(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    """(product_key, unit_cost, version_cost, rows) of facts whose stored cost is not that of their version.

    Facts are summed per key and cost before the join, so no busy key is shuffled row by row.
    """
    versions = dim_product.select("product_key", F.col("unit_cost").alias("version_cost"))
    pinned = fact.groupBy("product_key", "unit_cost").agg(F.count(F.lit(1)).alias("rows"))
    return pinned.join(versions, "product_key", "left").filter(is_distinct("unit_cost", "version_cost"))
