"""The sales fact, its wide form, and facts derived from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillbook.functions.columns import (
    AMOUNT,
    GROSS,
    LOCAL_TZ,
    NO_PROMOTION_KEY,
    UNKNOWN_KEY,
    at,
    discount,
    greatest_strict,
    hhmm,
    local_date,
    to_local,
    yyyymmdd,
)
from tillbook.operators.pit import pit_join
from tillbook.operators.scale import DEFAULT, Limits, broadcast_if_small, in_ranges, key_ranges
from tillbook.schemas import MART
from tillbook.session import pin, unpin


def headers_lines(tx: DataFrame, items: DataFrame) -> DataFrame:
    """Lines with their header; the mark of a row is the later change of the two."""
    head = tx.select(
        "transaction_id",
        "store_id",
        "employee_id",
        "payment_method_id",
        "transaction_ts",
        F.col("updated_at").alias("_header_updated_at"),
    )
    return items.join(head, "transaction_id").select(
        *[c for c in items.columns if c not in ("created_at", "updated_at", "coupon_amount")],
        F.coalesce("coupon_amount", F.lit(0)).cast("decimal(12,2)").alias("coupon_amount"),
        "store_id",
        "employee_id",
        "payment_method_id",
        "transaction_ts",
        greatest_strict("updated_at", "_header_updated_at").alias("source_updated_at"),
    )


def incremental_slice(items: DataFrame, tx: DataFrame, watermark, limits: Limits = DEFAULT) -> DataFrame:
    """headers_lines restricted to rows marked at or after the watermark; None loads all.

    The mark spans two tables, so no single filter reaches a scan. Receipts with any change at or after
    the watermark are found from two pushed-down filters, and only those are joined.
    """
    if watermark is None:
        return headers_lines(tx, items)
    since = at(watermark)

    def changed(df: DataFrame) -> DataFrame:
        return df.filter(F.col("updated_at") >= since).select("transaction_id")

    ids = pin(changed(items).unionByName(changed(tx)).distinct(), "changed-receipts")
    touched = in_ranges("transaction_id", key_ranges(ids, "transaction_id"))
    ids = broadcast_if_small(ids, limits)

    def near(df: DataFrame) -> DataFrame:
        # New receipts have high ids, and a corrected old one stands alone: row groups between them are skipped.
        return df.filter(touched).join(ids, "transaction_id", "left_semi")

    rows = headers_lines(near(tx), near(items))
    return rows.filter(F.col("source_updated_at") >= since)


def lookup(df: DataFrame, dim: DataFrame, on: str, take: list[str], limits: Limits = DEFAULT) -> DataFrame:
    """Left join to a Type 1 dimension on its natural key."""
    return df.join(broadcast_if_small(dim.select(on, *take), limits), on, "left")


def lookup_calendar(df: DataFrame, dim_date: DataFrame, dim_time: DataFrame, local_ts: Column) -> DataFrame:
    """date_key and time_key of a local time; NULL when the dimension lacks the day or minute.

    Both sides are fixed in size by construction: one row per calendar day and per minute of a day.
    """
    out = df.withColumns({"_day": yyyymmdd(local_ts), "_minute": hhmm(local_ts)})
    days = dim_date.select(F.col("date_key").alias("_day"), "date_key")
    minutes = dim_time.select(F.col("time_key").alias("_minute"), "time_key")
    out = out.join(F.broadcast(days), "_day", "left").join(F.broadcast(minutes), "_minute", "left")
    return out.drop("_day", "_minute")


def fct_sales(lines: DataFrame, dims: dict[str, DataFrame], tz: str = LOCAL_TZ, limits: Limits = DEFAULT) -> DataFrame:
    """Line-grain sales fact from joined headers and lines (headers_lines or incremental_slice).

    Versions are found first: these joins may shuffle, and rows are shortest before the small dimensions widen them.
    """
    priced = pit_join(lines, dims["dim_product"], "product_id", "transaction_ts", ["product_key", "unit_cost"], limits=limits)
    df = priced.drop("product_id")
    df = pit_join(df, dims["dim_employee"], "employee_id", "transaction_ts", ["employee_key"], limits=limits)
    if hasattr(priced, "merged_from") and hasattr(df, "merged_from"):
        unpin(priced.merged_from)  # the second merge wrote what it reads
    df = lookup(df.drop("employee_id"), dims["dim_store"], "store_id", ["store_key"], limits)
    df = lookup(df, dims["dim_payment_method"], "payment_method_id", ["payment_method_key"], limits)
    promo = ["promotion_key", "promotion_type", "promotion_amount"]
    df = lookup(df, dims["dim_promotion"], "promotion_id", promo, limits)
    df = lookup_calendar(df, dims["dim_date"], dims["dim_time"], to_local("transaction_ts", tz))

    quantity, price = F.col("quantity"), F.col("regular_price")
    gross, coupon = F.col("gross_amount"), F.col("coupon_amount")
    df = df.withColumns(
        {
            "gross_amount": (quantity * price).cast(GROSS),
            "discount_amount": discount(quantity, price, F.col("promotion_type"), F.col("promotion_amount")),
            "cost_amount": (quantity * F.col("unit_cost")).cast(GROSS),
        }
    )
    df = df.withColumn("net_amount", (gross - F.col("discount_amount") - coupon).cast(AMOUNT))
    df = df.withColumn("gross_profit", (F.col("net_amount") - F.col("cost_amount")).cast(AMOUNT))
    none = F.when(F.col("promotion_id").isNull(), NO_PROMOTION_KEY)
    df = df.withColumn("promotion_key", F.coalesce(none, "promotion_key"))
    fields = MART["fct_sales"].fields
    keys = {f.name for f in fields if f.name.endswith("_key")}
    return df.select(
        [
            (F.coalesce(f.name, F.lit(UNKNOWN_KEY)) if f.name in keys else F.col(f.name)).cast(f.dataType).alias(f.name)
            for f in fields
        ]
    )


def sale_month(date_key: Column | str = "date_key") -> Column:
    """YYYYMM of a date key, the physical slice of the fact; -2 stays -2."""
    key = F.col(date_key) if isinstance(date_key, str) else date_key
    return F.when(key > 0, F.floor(key / 100).cast("int")).otherwise(key)


def enrich(fct: DataFrame, dims: dict[str, DataFrame], limits: Limits = DEFAULT) -> DataFrame:
    """Fact plus dimension attributes; every key has a member, so inner joins keep every row.

    Products come first: their table may be too large to send, and rows are shuffled before they take on text.
    """
    wide = fct
    for name, key, cols in [
        ("dim_product", "product_key", ["product_name", "category_name", "brand_name"]),
        ("dim_store", "store_key", ["store_name"]),
        ("dim_promotion", "promotion_key", ["promotion_label", "promotion_type"]),
        ("dim_payment_method", "payment_method_key", ["payment_method_name"]),
    ]:
        wide = wide.join(broadcast_if_small(dims[name].select(key, *cols), limits), key)
    wide = wide.join(F.broadcast(dims["dim_date"]), "date_key")
    return wide.select([f.name for f in MART["fct_sales_enriched"].fields])


def receipts(fct: DataFrame) -> DataFrame:
    """One row per receipt."""
    return fct.groupBy("transaction_id", "store_key", "date_key", "time_key").agg(
        F.count(F.lit(1)).alias("line_count"),
        F.sum("quantity").alias("quantity"),
        F.sum("net_amount").alias("basket_value"),
        F.sum("gross_profit").alias("gross_profit"),
    )


def unknown_rows(fct: DataFrame) -> DataFrame:
    """Rows that wait for a dimension member."""
    keys = [f.name for f in MART["fct_sales"].fields if f.name.endswith("_key")]
    waiting = F.lit(False)
    for k in keys:
        waiting = waiting | (F.col(k) == UNKNOWN_KEY)
    return fct.filter(waiting)


def what_if_cost(fct: DataFrame, pct) -> DataFrame:
    """Profit if every unit cost rises by `pct` (0.05 = five percent)."""
    cost = (F.col("cost_amount") * (1 + F.lit(pct))).cast(AMOUNT)
    return fct.withColumns({"new_cost_amount": cost, "new_gross_profit": (F.col("net_amount") - cost).cast(AMOUNT)})


def explode_lines(headers: DataFrame, lines: str = "lines") -> DataFrame:
    """Line rows of nested headers: header columns are copied, line_number counts from 1."""
    rest = [c for c in headers.columns if c != lines]
    out = headers.select(*rest, F.posexplode(lines).alias("_pos", "_line"))
    return out.select(*rest, (F.col("_pos") + 1).alias("line_number"), "_line.*")


def promo_active(start: Column, end: Column, day: Column) -> Column:
    return day.between(start, end)


def promotion_coverage(bridge: DataFrame, promotion: DataFrame, lines: DataFrame, tz: str = LOCAL_TZ) -> DataFrame:
    """Product and day on promotion without a sale of that product under that promotion on that day."""
    days = (
        bridge.join(broadcast_if_small(promotion.select("promotion_id", "start_date", "end_date")), "promotion_id")
        .select("promotion_id", "product_id", F.explode(F.sequence("start_date", "end_date")).alias("full_date"))
    )
    sold = lines.select("promotion_id", "product_id", local_date("transaction_ts", tz).alias("full_date")).distinct()
    return days.join(sold, ["promotion_id", "product_id", "full_date"], "left_anti")

