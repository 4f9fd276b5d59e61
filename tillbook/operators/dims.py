"""Dimensions: surrogate keys, reserved members, calendar and clock."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.functions.columns import (
    NO_PROMOTION_KEY,
    UNKNOWN_KEY,
    open_end,
    open_start,
    promotion_label,
    surrogate_key,
    yyyymmdd,
)
from tillbook.operators.scale import broadcast_if_small
from tillbook.schemas import MART
from tillbook.sources.tables import spine

# First calendar day and number of days.
DATE_START = date(2020, 1, 1)
DATE_DAYS = 4018


def with_members(df: DataFrame, members: list[dict], name: str) -> DataFrame:
    """Append reserved members and give the result the contract's columns and types."""
    fields = MART[name].fields
    typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in fields]
    out = df.select(typed)
    one = df.sparkSession.range(1)
    for member in members:
        values = [member.get(f.name) for f in fields]
        literal = [v if isinstance(v, type(F.lit(0))) else F.lit(v) for v in values]
        out = out.unionByName(one.select([v.cast(f.dataType).alias(f.name) for v, f in zip(literal, fields)]))
    return out


def dim_type1(df: DataFrame, name: str, key: str, natural: str) -> DataFrame:
    """Latest attributes only, plus the Unknown member: -2 in numbers, 'Unknown' in text."""
    unknown = {f.name: "Unknown" for f in MART[name].fields} | {key: UNKNOWN_KEY, natural: UNKNOWN_KEY}
    return with_members(df.withColumn(key, surrogate_key(natural)), [unknown], name)


def dim_store(stg_store: DataFrame) -> DataFrame:
    return dim_type1(stg_store, "dim_store", "store_key", "store_id")


def dim_payment_method(stg: DataFrame) -> DataFrame:
    named = stg.withColumnRenamed("method", "payment_method_name")
    return dim_type1(named, "dim_payment_method", "payment_method_key", "payment_method_id")


def dim_promotion(stg: DataFrame) -> DataFrame:
    df = stg.select(
        surrogate_key("promotion_id").alias("promotion_key"),
        "promotion_id",
        promotion_label(F.col("type"), F.col("amount")).alias("promotion_label"),
        F.col("type").alias("promotion_type"),
        F.col("amount").alias("promotion_amount"),
        "start_date",
        "end_date",
    )
    reserved = {NO_PROMOTION_KEY: "No promotion", UNKNOWN_KEY: "Unknown"}
    members = [{"promotion_key": k, "promotion_id": k, "promotion_label": v} for k, v in reserved.items()]
    return with_members(df, members, "dim_promotion")


def _open_member(**values) -> dict:
    return values | {"valid_from": open_start(), "valid_to": open_end(), "is_current": True}


def denormalize(product: DataFrame, category: DataFrame, brand: DataFrame) -> DataFrame:
    out = product.join(broadcast_if_small(category), "category_id", "left")
    return out.join(broadcast_if_small(brand), "brand_id", "left")


def dim_product(history: DataFrame, category: DataFrame, brand: DataFrame) -> DataFrame:
    df = denormalize(history, category, brand).withColumn("product_key", surrogate_key("product_id", "valid_from"))
    text = ["product_sku", "product_name", "category_name", "brand_name"]
    unknown = _open_member(product_key=UNKNOWN_KEY, product_id=UNKNOWN_KEY, **{c: "Unknown" for c in text})
    return with_members(df, [unknown], "dim_product")


def dim_employee(history: DataFrame) -> DataFrame:
    df = history.withColumn("employee_key", surrogate_key("employee_id", "valid_from"))
    unknown = _open_member(
        employee_key=UNKNOWN_KEY, employee_id=UNKNOWN_KEY, store_id=UNKNOWN_KEY, employee_name="Unknown"
    )
    return with_members(df, [unknown], "dim_employee")


def calendar(spark: SparkSession, start: date, days: int) -> DataFrame:
    return spine(spark, days).select(F.date_add(F.lit(start), F.col("i").cast("int")).alias("full_date"))


def dim_date(spark: SparkSession, start: date = DATE_START, days: int = DATE_DAYS) -> DataFrame:
    d = F.col("full_date")
    weekday = F.weekday(d) + 1
    df = calendar(spark, start, days).select(
        yyyymmdd(d).alias("date_key"),
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day_of_month"),
        weekday.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.weekofyear(d).alias("week_of_year"),
        (weekday >= 6).alias("is_weekend"),
    )
    unknown = {"date_key": UNKNOWN_KEY, "month_name": "Unknown", "day_name": "Unknown"}
    return with_members(df, [unknown], "dim_date")


def dim_time(spark: SparkSession) -> DataFrame:
    hour = F.floor(F.col("i") / 60).cast("int")
    minute = (F.col("i") % 60).cast("int")
    clock = spine(spark, 24 * 60).select(hour.alias("hour_24"), minute.alias("minute"))
    h = F.col("hour_24")
    # The hours where a part of the day begins.
    part = F.when(h < 6, "Night").when(h < 12, "Morning").when(h < 18, "Afternoon").when(h < 22, "Evening")
    df = clock.select(
        (h * 100 + F.col("minute")).alias("time_key"),
        F.format_string("%02d:%02d:00", h, F.col("minute")).alias("time_of_day"),
        h,
        "minute",
        ((h + 11) % 12 + 1).alias("hour_12"),
        F.when(h >= 12, "PM").otherwise("AM").alias("am_pm"),
        F.coalesce(part, F.lit("Night")).alias("day_part"),
    )
    unknown = {"time_key": UNKNOWN_KEY, "am_pm": "Unknown", "day_part": "Unknown"}
    return with_members(df, [unknown], "dim_time")


def real_members(dim: DataFrame, key: str) -> DataFrame:
    return dim.filter(F.col(key) != UNKNOWN_KEY)


def pii_columns(name: str) -> list[str]:
    from tillbook.schemas import PII

    return PII.get(name, [])


def tag_pii(df: DataFrame, name: str) -> DataFrame:
    """Mark personal columns in the column metadata, which travels with the schema."""
    return df.withColumns({c: F.col(c).alias(c, metadata={"pii": True}) for c in pii_columns(name)})


def drop_pii(df: DataFrame) -> DataFrame:
    return df.drop(*[f.name for f in df.schema.fields if f.metadata.get("pii")])
