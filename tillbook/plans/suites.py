"""Check suites: RAW expectations, history, marts, headcount, sales integrity."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillbook import schemas
from tillbook.functions.columns import (
    LOCAL_TZ,
    OPEN_END,
    employed_on,
    is_distinct,
    local_date,
    month_starts_between,
    open_start,
    to_local,
)
from tillbook.operators import headcount
from tillbook.operators.dims import DATE_DAYS, DATE_START, real_members
from tillbook.operators.facts import promo_active
from tillbook.operators.quality import (
    Rule,
    accepted_range,
    accepted_values,
    broadcastable_orphans,
    check_keys,
    check_rows,
    contract_nulls,
    expression_is_true,
    groups_having,
    not_null,
    orphans,
    reconcile,
    report,
    same_totals,
    stack,
    tuple_hash,
    unique,
)
from tillbook.operators.scale import DEFAULT, Limits, broadcast_if_small, neighbours, time_cuts

# What RAW must satisfy before anything is built on it.
STATUSES = ["completed", "cancelled", "returned"]
RAW_RULES = {
    "sales_transaction": lambda: [
        *map(not_null, ["transaction_id", "store_id", "employee_id", "payment_method_id", "transaction_ts", "updated_at"]),
        accepted_values("status", STATUSES),
    ],
    "sales_transaction_item": lambda: [
        *map(not_null, ["transaction_id", "line_number", "product_id", "quantity", "regular_price"]),
        accepted_range("quantity", lo=1),
        accepted_range("regular_price", lo=0),
        accepted_range("coupon_amount", lo=0),
    ],
    "product": lambda: [
        *map(not_null, ["id", "product_sku", "unit_price", "unit_cost", "updated_at"]),
        accepted_range("unit_price", lo=0),
        accepted_range("unit_cost", lo=0),
    ],
    "employee": lambda: [*map(not_null, ["id", "store_id", "updated_at"]), accepted_range("salary", lo=0)],
}


def raw_checks(df: DataFrame, table: str) -> DataFrame:
    """All expectations of one RAW table in one pass."""
    return check_rows(df, table, RAW_RULES[table](), min_rows=1)


def status_changes(raw_tx: DataFrame) -> DataFrame:
    return groups_having(raw_tx, ["transaction_id"], F.count_distinct("status").alias("statuses"), F.col("statuses") > 1)


# The constraints of the source tables.
SOURCE_RULES = {
    "employee": lambda: [accepted_range("salary", lo=0), expression_is_true("end_date >= start_date")],
    "product": lambda: [accepted_range("unit_price", lo=0), accepted_range("unit_cost", lo=0)],
    "promotion": lambda: [
        accepted_values("type", ["percentage", "fixed_amount"]),
        accepted_range("amount", lo=0, inclusive=False),
        Rule("percentage <= 100", (F.col("type") == "percentage") & (F.col("amount") > 100)),
        expression_is_true("end_date >= start_date"),
    ],
    "sales_transaction": lambda: [accepted_values("status", STATUSES)],
    "sales_transaction_item": lambda: [
        accepted_range("line_number", lo=0, inclusive=False),
        accepted_range("quantity", lo=0, inclusive=False),
        accepted_range("regular_price", lo=0),
        accepted_range("coupon_amount", lo=0),
    ],
}
UNIQUE_NAMES = {"store": "store_name", "category": "category_name", "brand": "brand_name", "payment_method": "method"}


def check_source_rules(raw: dict[str, DataFrame]) -> DataFrame:
    parts = [check_rows(raw[t], t, rules()) for t, rules in SOURCE_RULES.items()]
    parts += [report(t, f"unique {c}", unique(raw[t], [c])) for t, c in UNIQUE_NAMES.items()]
    skus = raw["product"].select("id", "product_sku").distinct()
    parts.append(report("product", "unique product_sku", unique(skus, ["product_sku"])))
    pairs = invalid_promo_pairs(raw["sales_transaction_item"], raw["promotion_product"])
    parts.append(report("sales_transaction_item", "promotion pair exists", pairs, F.col("rows")))
    return stack(parts)


def invalid_promo_pairs(items: DataFrame, bridge: DataFrame) -> DataFrame:
    """(product, promotion, rows) of lines whose pair the bridge lacks; no promotion, no check."""
    pairs = items.filter(F.col("promotion_id").isNotNull()).groupBy("product_id", "promotion_id")
    found = pairs.agg(F.count(F.lit(1)).alias("rows"))
    return found.join(bridge.select("product_id", "promotion_id"), ["product_id", "promotion_id"], "left_anti")


# The key of each staging table. History needs one row per key and change time.
STAGING_KEYS = {
    "store": ["store_id"],
    "category": ["category_id"],
    "brand": ["brand_id"],
    "promotion": ["promotion_id"],
    "payment_method": ["payment_method_id"],
    "promotion_product": ["promotion_id", "product_id"],
    "product": ["product_id", "updated_at"],
    "employee": ["employee_id", "updated_at"],
    "sales_transaction": ["transaction_id"],
    "sales_transaction_item": ["transaction_id", "line_number"],
}


def staging_keys(stg: dict[str, DataFrame]) -> DataFrame:
    """Each staging table: key columns are filled and unique."""
    return stack([check_keys(stg[name], f"stg_{name}", cols) for name, cols in STAGING_KEYS.items()])


# ------------------------------------------------------------------ history
def overlaps(history: DataFrame, key: str, limits: Limits = DEFAULT) -> DataFrame:
    """Versions that run into the next version of their key. If any two overlap, some neighbours do."""
    return _with_next(history, key, limits).filter(F.col("next_valid_from") < F.col("valid_to"))


def validity_gaps(history: DataFrame, key: str, limits: Limits = DEFAULT) -> DataFrame:
    """Versions that do not end exactly where the next version of their key begins."""
    return _with_next(history, key, limits).filter(F.col("next_valid_from") != F.col("valid_to"))


def _with_next(history: DataFrame, key: str, limits: Limits) -> DataFrame:
    cuts = time_cuts(history, [key], "valid_from", limits)
    side = neighbours(history, [key], "valid_from", nxt=["valid_from"], cuts=cuts)
    return side.withColumn("next_valid_from", F.col("_next.valid_from")).drop("_next", "_segment")


def check_scd2(
    history: DataFrame,
    table: str,
    key: str,
    tracked: list[str],
    type1: list[str],
    source: DataFrame | None = None,
    gapless: bool = False,
    limits: Limits = DEFAULT,
) -> DataFrame:
    """One row per rule. Pairwise overlap is found on adjacent versions, which is equivalent."""
    latest = tuple_hash(type1)
    by_key = history.groupBy(key).agg(
        F.min("valid_from").alias("first"),
        F.count_if("is_current").alias("current"),
        F.min(latest).alias("lo"),
        F.max(latest).alias("hi"),
    )
    cuts = time_cuts(history, [key], "valid_from", limits)
    side = neighbours(
        history, [key], "valid_from", prev=[*tracked, "valid_from"], nxt=["valid_from"], cuts=cuts
    )
    same = F.col("_prev").isNotNull()
    for c in tracked:
        same = same & F.col(f"_prev.{c}").eqNullSafe(F.col(c))
    following = F.col("_next.valid_from")
    rules = [
        Rule("no identical adjacent", same),
        Rule("no overlap", following < F.col("valid_to")),
        Rule("unique version", F.col("_prev.valid_from") == F.col("valid_from")),
        Rule("valid range", F.col("valid_to") <= F.col("valid_from")),
        Rule("open end means current", is_distinct(F.col("valid_to") == F.lit(OPEN_END).cast("timestamp_ntz"), "is_current")),
    ]
    if gapless:
        rules.append(Rule("no gap", following != F.col("valid_to")))
    parts = [
        check_rows(side, table, rules),
        check_rows(
            by_key,
            table,
            [
                Rule("first version from 1900", F.col("first") != open_start()),
                Rule("single current", F.col("current") != 1),
                Rule("type 1 consistent", F.col("lo") != F.col("hi")),
            ],
        ),
    ]
    if source is not None:
        parts.append(report(table, "complete", orphans(source, history.select(key).distinct(), key)))
    return stack(parts)


# ------------------------------------------------------------------ marts
FACT_DIMS = ["date", "time", "product", "store", "employee", "payment_method", "promotion"]


def fact_relationships(fct: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    return stack(
        [
            report("fct_sales", f"relationships {d}_key", broadcastable_orphans(fct, dims[f"dim_{d}"], f"{d}_key"), F.col("rows"))
            for d in FACT_DIMS
        ]
    )


STAGING_PARENTS = ["store", "payment_method", "promotion", "sales_transaction", "sales_transaction_item"]


def staging_relationships(stg: dict[str, DataFrame]) -> DataFrame:
    pairs = [
        ("sales_transaction", "store_id", "store"),
        ("sales_transaction", "payment_method_id", "payment_method"),
        ("sales_transaction_item", "transaction_id", "sales_transaction"),
        ("sales_transaction_item", "promotion_id", "promotion"),
    ]
    return stack(
        [
            report(f"stg_{child}", f"relationships {col}", orphans(stg[child], stg[parent], col), F.col("rows"))
            for child, col, parent in pairs
        ]
    )


def fact_rules(fct: DataFrame) -> DataFrame:
    rules = [
        expression_is_true("net_amount >= 0"),
        expression_is_true("discount_amount <= gross_amount"),
        expression_is_true("quantity > 0"),
        expression_is_true("gross_amount >= 0"),
        expression_is_true("coupon_amount >= 0"),
        not_null("unit_cost", severity="warn"),
    ]
    return stack(
        [
            check_rows(fct, "fct_sales", rules),
            report("fct_sales", "unique line", unique(fct, ["transaction_id", "line_number"])),
        ]
    )


def dim_rules(dims: dict[str, DataFrame]) -> DataFrame:
    known = F.col("date_key") != -2
    methods = ["cash", "card", "e_wallet", "bank_transfer", "Unknown"]
    parts = [
        check_rows(dims["dim_payment_method"], "dim_payment_method", [accepted_values("payment_method_name", methods)]),
        check_rows(
            dims["dim_promotion"],
            "dim_promotion",
            [
                accepted_values("promotion_type", ["fixed_amount", "percentage"]),
                accepted_range("promotion_amount", lo=0, inclusive=False),
            ],
        ),
        check_rows(dims["dim_date"], "dim_date", [not_null("full_date", where=known)]),
        check_rows(dims["dim_time"], "dim_time", [accepted_range("hour_24", 0, 23), accepted_range("minute", 0, 59)]),
        check_calendar(dims["dim_date"]),
        check_clock(dims["dim_time"]),
    ]
    for d in ["product", "store", "employee", "payment_method", "promotion"]:
        parts.append(report(f"dim_{d}", f"unique {d}_key", unique(dims[f"dim_{d}"], [f"{d}_key"])))
    return stack(parts)


def check_calendar(dim_date: DataFrame, days: int = DATE_DAYS) -> DataFrame:
    n, span = F.count(F.lit(1)), F.datediff(F.max("full_date"), F.min("full_date")) + 1
    wrong = real_members(dim_date, "date_key").agg(n.alias("n"), span.alias("span"))
    return report("dim_date", "contiguous", wrong.filter((F.col("n") != days) | (F.col("span") != F.col("n"))))


def check_clock(dim_time: DataFrame) -> DataFrame:
    wrong = real_members(dim_time, "time_key").agg(F.count(F.lit(1)).alias("n")).filter("n != 1440")
    return report("dim_time", "1440 minutes", wrong)


def row_count_matches(fct: DataFrame, stg_items: DataFrame, stg_tx: DataFrame) -> DataFrame:
    source = stg_items.join(stg_tx.select("transaction_id"), "transaction_id")
    return same_totals(fct.select("transaction_id"), source.select("transaction_id"), [], "fct_sales vs source")


def enriched_matches(fct: DataFrame, enriched: DataFrame) -> DataFrame:
    return same_totals(fct, enriched, ["net_amount", "gross_profit"], "fct_sales_enriched vs fct_sales")


def contract_checks(marts: dict[str, DataFrame]) -> DataFrame:
    return stack([contract_nulls(df, schemas.MART[name], name) for name, df in marts.items()])


# ------------------------------------------------------------------ headcount
def opening_gaps(snap: DataFrame) -> DataFrame:
    """Months whose opening is not the closing of the month before; a store has as many rows as months."""
    along = Window.partitionBy("store_id").orderBy("month_start")
    return snap.withColumn("previous_closing", F.lag("closing_headcount").over(along)).filter(
        "previous_closing is not null and opening_headcount != previous_closing"
    )


def check_headcount(
    snap: DataFrame,
    history: DataFrame,
    fct: DataFrame,
    dim_store: DataFrame,
    dim_date: DataFrame,
    as_of: date,
    start: date = DATE_START,
    tz: str = LOCAL_TZ,
) -> DataFrame:
    months = month_starts_between(F.lit(start), F.lit(as_of)) + 1
    last_month = as_of.replace(day=1)
    per_store = snap.groupBy("store_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("month_start").alias("lo"), F.max("month_start").alias("hi")
    )
    stores = real_members(dim_store, "store_key").select("store_id")
    short = stores.join(per_store, "store_id", "left").filter(
        F.col("n").isNull() | (F.col("n") != months) | (F.col("lo") != F.lit(start)) | (F.col("hi") != F.lit(last_month))
    )
    table = "fct_store_headcount_monthly"
    recounted = headcount.recount(history, start, as_of, tz).withColumnRenamed("headcount", "recounted")
    # Staff at a store the dimension lacks is not part of the snapshot.
    recounted = recounted.join(broadcast_if_small(stores), "store_id", "left_semi")
    closing = snap.select("store_id", "month_start", "closing_headcount").withColumnRenamed("closing_headcount", "value")
    sales = headcount.revenue_by_store_month(fct, dim_store, dim_date)
    known = sales.withColumnRenamed("net_revenue", "value")
    revenue = snap.select("store_id", "month_start", F.col("net_revenue").alias("value"))
    in_report = F.col("month_start").between(F.lit(start), F.lit(last_month))
    return stack(
        [
            report(table, "complete", short),
            check_rows(
                snap,
                table,
                [
                    Rule("one as-of day", F.col("as_of_date") != F.lit(as_of)),
                    Rule("closed flag", F.col("is_month_closed") == (F.col("month_start") == F.trunc("as_of_date", "month"))),
                    Rule(
                        "closing = opening + flows",
                        F.col("closing_headcount")
                        != F.expr("opening_headcount + joiners + transfers_in - leavers - transfers_out"),
                    ),
                    expression_is_true("opening_headcount >= 0 and closing_headcount >= 0"),
                ],
            ),
            report(table, "opening = previous closing", opening_gaps(snap)),
            report(
                table,
                "closing = history",
                reconcile(closing, recounted.withColumnRenamed("recounted", "value"), ["store_id", "month_start"], "value")
                .filter("level = 'key'"),
            ),
            report(
                table,
                "revenue = fct_sales",
                reconcile(revenue, known.filter(in_report), ["store_id", "month_start"], "value").filter("level = 'key'"),
            ),
        ]
    )


def revenue_differences(snap: DataFrame, fct: DataFrame, dim_store: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Store-months and the grand total where snapshot and fact disagree, in either direction."""
    sales = headcount.revenue_by_store_month(fct, dim_store, dim_date)
    shown = snap.select("store_id", "month_start", "net_revenue")
    return reconcile(shown, sales, ["store_id", "month_start"], "net_revenue")


# ------------------------------------------------------------------ sales integrity
def bad_sellers(tx: DataFrame, emp: DataFrame, tz: str = LOCAL_TZ) -> DataFrame:
    """Sales by someone of another store or not employed that local day (last day included)."""
    people = emp.select("employee_id", F.col("store_id").alias("home"), "start_date", "end_date")
    sold = tx.withColumn("sale_day", local_date("transaction_ts", tz))
    joined = sold.join(broadcast_if_small(people), "employee_id")
    on_duty = employed_on("start_date", "end_date", F.col("sale_day"), inclusive_end=True)
    return joined.filter((F.col("home") != F.col("store_id")) | ~on_duty)


def bad_lines(items: DataFrame, tx: DataFrame, prod: DataFrame, promo: DataFrame, tz: str = LOCAL_TZ) -> DataFrame:
    """Lines off the price list, or with a promotion that was not running on the local sale day."""
    days = tx.select("transaction_id", local_date("transaction_ts", tz).alias("sale_day"))
    prices = prod.select("product_id", "unit_price")
    runs = promo.select("promotion_id", "start_date", "end_date")
    joined = (
        items.join(days, "transaction_id")
        .join(broadcast_if_small(prices), "product_id")
        .join(broadcast_if_small(runs), "promotion_id", "left")
    )
    running = promo_active(F.col("start_date"), F.col("end_date"), F.col("sale_day"))
    return joined.filter((F.col("regular_price") != F.col("unit_price")) | ~running)


def noncontiguous(tx: DataFrame, items: DataFrame) -> DataFrame:
    """Receipts without lines, or whose lines are not numbered 1..n."""
    lines = items.groupBy("transaction_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("line_number").alias("lo"), F.max("line_number").alias("hi")
    )
    return tx.select("transaction_id").join(lines, "transaction_id", "left").filter(
        "n is null or lo != 1 or hi != n"
    )


def off_hours(tx: DataFrame, tz: str = LOCAL_TZ, first: int = 7, last: int = 21) -> DataFrame:
    return tx.filter(~F.hour(to_local("transaction_ts", tz)).between(first, last))


def check_sales(
    tx: DataFrame,
    items: DataFrame,
    emp: DataFrame,
    prod: DataFrame,
    promo: DataFrame,
    store: DataFrame,
    method: DataFrame,
    tz: str = LOCAL_TZ,
    limits: Limits = DEFAULT,
) -> DataFrame:
    t = "sales"
    return stack(
        [
            report(t, "seller belongs and is employed", bad_sellers(tx, emp, tz)),
            report(t, "lines contiguous", noncontiguous(tx, items)),
            report(t, "price list and running promotion", bad_lines(items, tx, prod, promo, tz)),
            report(t, "store exists", orphans(tx, store, "store_id"), F.col("rows")),
            report(t, "payment method exists", orphans(tx, method, "payment_method_id"), F.col("rows")),
            report(t, "opening hours", off_hours(tx, tz)),
            report(t, "updated after sale", tx.filter("updated_at < transaction_ts")),
        ]
    )
