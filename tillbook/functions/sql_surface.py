"""The building blocks as SQL functions, for users who write Spark SQL and no Python.

Each is a CREATE FUNCTION ... RETURN expression, which the optimizer inlines: a call costs what the expression costs.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tillbook.functions.columns import LOCAL_TZ, NO_PROMOTION_KEY, OPEN_END, OPEN_START, UNKNOWN_KEY

FUNCTIONS = {
    # concat_ws skips NULLs, as the column form does
    "surrogate_key(parts ARRAY<STRING>)": (
        "BIGINT",
        "(((CAST(CONV(SUBSTRING(MD5(CONCAT_WS('|', parts)), 1, 8), 16, 10) AS BIGINT)) & 2147483647L) * 4294967296L)"
        " + CAST(CONV(SUBSTRING(MD5(CONCAT_WS('|', parts)), 9, 8), 16, 10) AS BIGINT)",
    ),
    "unknown_key()": ("BIGINT", f"CAST({UNKNOWN_KEY} AS BIGINT)"),
    "no_promotion_key()": ("BIGINT", f"CAST({NO_PROMOTION_KEY} AS BIGINT)"),
    "open_start()": ("TIMESTAMP_NTZ", f"TIMESTAMP_NTZ'{OPEN_START}'"),
    "open_end()": ("TIMESTAMP_NTZ", f"TIMESTAMP_NTZ'{OPEN_END}'"),
    "to_local(ts TIMESTAMP_NTZ)": ("TIMESTAMP_NTZ", f"CONVERT_TIMEZONE('UTC', '{LOCAL_TZ}', ts)"),
    "local_date(ts TIMESTAMP_NTZ)": ("DATE", f"CAST(CONVERT_TIMEZONE('UTC', '{LOCAL_TZ}', ts) AS DATE)"),
    "yyyymmdd(day DATE)": ("INT", "YEAR(day) * 10000 + MONTH(day) * 100 + DAY(day)"),
    "employed_on(first DATE, last DATE, day DATE)": ("BOOLEAN", "COALESCE(first <= day AND (last IS NULL OR last > day), FALSE)"),
    "sells_on(first DATE, last DATE, day DATE)": ("BOOLEAN", "COALESCE(first <= day AND (last IS NULL OR last >= day), FALSE)"),
    "discount(quantity INT, price DECIMAL(12,2), kind STRING, amount DECIMAL(12,2))": (
        "DECIMAL(20,6)",
        "COALESCE(CASE kind WHEN 'percentage' THEN CAST(CAST(quantity * price AS DECIMAL(18,2)) * amount * 0.01 AS DECIMAL(20,6)) "
        "WHEN 'fixed_amount' THEN CAST(quantity * LEAST(amount, price) AS DECIMAL(20,6)) END, CAST(0 AS DECIMAL(20,6)))",
    ),
    "promo_label(kind STRING, amount DECIMAL(12,2))": (
        "STRING",
        "CASE kind WHEN 'percentage' THEN CONCAT(CASE WHEN amount = CAST(amount AS BIGINT) THEN CAST(CAST(amount AS BIGINT) AS STRING) "
        "ELSE CAST(amount AS STRING) END, '% off') WHEN 'fixed_amount' THEN CONCAT(FORMAT_NUMBER(ROUND(amount, 0), 0), ' VND off') END",
    ),
    "margin(profit DECIMAL(38,6), revenue DECIMAL(38,6))": ("DOUBLE", "CAST(profit AS DOUBLE) / NULLIF(CAST(revenue AS DOUBLE), 0)"),
}


def create_functions(spark: SparkSession, prefix: str = "", temporary: bool = True) -> list[str]:
    """Create all functions, in the session or in the current database; returns their names."""
    kind = "TEMPORARY FUNCTION" if temporary else "FUNCTION"
    for signature, (returns, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE {kind} {prefix}{signature} RETURNS {returns} RETURN {body}")
    return [prefix + s.split("(")[0] for s in FUNCTIONS]
