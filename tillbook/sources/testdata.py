"""The retail source tables, derived from the driver's TPC-H-like Parquet files.

Row-level rules only, plus the keys a rule needs. A tenth of the rows of appended tables arrives twice,
with a second load id, like rows read again at a cursor boundary.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook import schemas
from tillbook.operators.scale import DEFAULT, Limits, numbered

YEARS_AHEAD = 25


def _ahead(ts: str) -> Column:
    return F.add_months(F.col(ts), 12 * YEARS_AHEAD).cast("timestamp_ntz")


def _promotion_id() -> Column:
    return F.nullif(F.round(F.col("l_discount") * 100).cast("bigint"), F.lit(0))


def _name_id(name: str) -> Column:
    return F.conv(F.substring(F.md5(F.col(name)), 1, 7), 16, 10).cast("bigint")


def _brand_id() -> Column:
    return F.expr("substring(p_brand, 7)").cast("bigint")


def _loaded(df: DataFrame, key: str) -> DataFrame:
    twice = F.array(F.lit(1).cast("bigint"), F.lit(2).cast("bigint"))
    once = F.array(F.lit(1).cast("bigint"))
    return df.withColumn("_load_id", F.explode(F.when(F.col(key) % 10 == 0, twice).otherwise(once)))


def _stamped(df: DataFrame) -> DataFrame:
    start = F.lit("2020-01-01 00:00:00").cast("timestamp_ntz")
    return df.withColumns({"created_at": start, "updated_at": start})


def retail_table(spark: SparkSession, sf_dir: str, name: str, limits: Limits = DEFAULT) -> DataFrame:
    """One retail table with the declared RAW columns and types."""

    def given(table: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{table}.parquet")

    build = _BUILDERS[name]
    df = build(given, limits) if name == "sales_transaction_item" else build(given)
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.RAW[name].fields])


def _store(given):
    nation, region = given("nation"), given("region")
    phone = F.concat(F.lit("028-"), F.lpad(F.col("n_nationkey").cast("string"), 4, "0"))
    return _stamped(
        nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            F.col("n_nationkey").alias("id"),
            F.col("n_name").alias("store_name"),
            F.col("r_name").alias("address"),
            phone.alias("phone_number"),
        )
    )


def _category(given):
    kinds = given("part").select("p_type").distinct()
    return _stamped(kinds.select(_name_id("p_type").alias("id"), F.col("p_type").alias("category_name")))


def _brand(given):
    brands = given("part").select("p_brand").distinct()
    return _stamped(brands.select(_brand_id().alias("id"), F.col("p_brand").alias("brand_name")))


def _payment_method(given):
    # Four methods. Orders with priority 5 have no method, which gives unknown members.
    names = F.array(*[F.lit(m) for m in ["cash", "card", "e_wallet", "bank_transfer"]])
    number = F.substring("o_orderpriority", 1, 1).cast("int")
    methods = given("orders").select(number.alias("id")).distinct().filter("id between 1 and 4")
    return _stamped(methods.select("id", F.get(names, F.col("id") - 1).alias("method")))


def _promotion(given):
    # Promotion 10 stays out of the table, so its lines meet an unknown promotion.
    ids = given("lineitem").select(_promotion_id().alias("id")).distinct().filter("id between 1 and 9")
    start = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") * 100).cast("int"))
    even = F.col("id") % 2 == 0
    fixed = F.when(F.col("id") == 9, 1250).otherwise(F.col("id") * 10)
    percent = F.when(F.col("id") == 8, 12.5).otherwise(F.col("id"))
    return _stamped(
        ids.select(
            "id",
            F.when(even, "percentage").otherwise("fixed_amount").alias("type"),
            F.when(even, percent).otherwise(fixed).alias("amount"),
            start.alias("start_date"),
            F.date_add(start, 59).alias("end_date"),
        )
    )


def _promotion_product(given):
    # Every fiftieth pair is left out, so some lines carry a pair the bridge does not know.
    pairs = given("lineitem").select(F.col("l_partkey").alias("product_id"), _promotion_id().alias("promotion_id"))
    known = (F.col("promotion_id") <= 9) & ((F.col("product_id") + F.col("promotion_id")) % 50 != 0)
    return _stamped(pairs.filter(known).distinct())


def _sales_transaction(given):
    orders, customer = given("orders"), given("customer")
    ts = _ahead("o_orderdate") + F.make_dt_interval(secs=(F.col("o_orderkey") * 7919 % 86400).cast("decimal(18,6)"))
    stranger = F.col("o_orderkey") % 20 == 0
    status = (
        F.when(F.col("o_orderstatus").isin("F", "O"), "completed")
        .when(F.col("o_orderkey") % 2 == 0, "returned")
        .otherwise("cancelled")
    )
    out = orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("c_nationkey").alias("store_id"),
        F.when(stranger, F.col("o_custkey") + 10_000_000).otherwise(F.col("o_custkey") % 200).alias("employee_id"),
        F.substring("o_orderpriority", 1, 1).alias("payment_method_id"),
        ts.alias("transaction_ts"),
        status.alias("status"),
    )
    changed = F.col("transaction_ts") + F.make_dt_interval(hours=(F.col("transaction_id") % 48).cast("int"))
    return _loaded(
        out.withColumns({"created_at": F.col("transaction_ts"), "updated_at": changed}), "transaction_id"
    )


def _sales_transaction_item(given, limits):
    # (l_orderkey, l_linenumber) repeats, so lines are numbered anew. The part goes first in the order:
    # it has many values, so even a very long receipt can be cut into pieces.
    order = ["l_partkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate"]
    lines = numbered(given("lineitem"), ["l_orderkey"], order, "line_number", limits)
    promo = _promotion_id()
    coupon = F.when(promo % 2 == 1, 0.0).otherwise(F.round(F.col("l_tax") * 100))
    out = lines.select(
        F.col("l_orderkey").alias("transaction_id"),
        "line_number",
        F.col("l_partkey").alias("product_id"),
        promo.alias("promotion_id"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("regular_price"),
        coupon.alias("coupon_amount"),
        _ahead("l_shipdate").alias("created_at"),
        _ahead("l_shipdate").alias("updated_at"),
    )
    return _loaded(out, "transaction_id")


def _product(given):
    # A leap day moves onto the 28th, so rows are grouped by the moved day.
    moved = given("lineitem").select("l_partkey", "l_tax", _ahead("l_shipdate").alias("updated_at"))
    changes = moved.groupBy("l_partkey", "updated_at").agg(F.max("l_tax").alias("tax"))
    retail = F.col("p_retailprice").cast("decimal(12,2)")
    out = changes.join(given("part"), F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("p_partkey").alias("id"),
        F.concat(F.lit("SKU-"), F.lpad(F.col("p_partkey").cast("string"), 8, "0")).alias("product_sku"),
        _name_id("p_type").alias("category_id"),
        _brand_id().alias("brand_id"),
        F.concat("p_name", F.lit(" "), F.year("updated_at").cast("string")).alias("product_name"),
        (retail * 2).alias("unit_price"),
        (retail * (1 + F.col("tax").cast("decimal(12,2)"))).alias("unit_cost"),
        F.lit("2020-01-01 00:00:00").cast("timestamp_ntz").alias("created_at"),
        "updated_at",
    )
    return _loaded(out, "id")


def _employee(given):
    # Store of an event type.
    stores = {"click": 0, "view": 1, "purchase": 2, "signup": 3, "error": 4}
    store = F.coalesce(*[F.when(F.col("event_type") == k, v) for k, v in stores.items()])
    uid = F.col("user_id")
    start = F.date_add(F.lit("2023-12-25").cast("date"), (uid % 40).cast("int"))
    out = given("events").select(
        uid.alias("id"),
        store.alias("store_id"),
        F.concat(F.lit("First"), uid.cast("string")).alias("first_name"),
        F.concat(F.lit("Last"), F.col("event_type")).alias("last_name"),
        F.date_add(F.lit("1980-01-01").cast("date"), (uid % 9000).cast("int")).alias("date_of_birth"),
        F.col("props").alias("address"),
        F.concat(F.lit("09"), F.lpad(uid.cast("string"), 8, "0")).alias("phone_number"),
        start.alias("start_date"),
        F.when(uid % 3 == 0, F.date_add(start, (uid % 17 + 3).cast("int"))).alias("end_date"),
        F.abs(F.col("value").cast("decimal(12,2)")).alias("salary"),
        F.col("ts").alias("created_at"),
        F.col("ts").alias("updated_at"),
    )
    return _loaded(out, "id")


_BUILDERS = {
    "store": _store,
    "category": _category,
    "brand": _brand,
    "payment_method": _payment_method,
    "promotion": _promotion,
    "promotion_product": _promotion_product,
    "sales_transaction": _sales_transaction,
    "sales_transaction_item": _sales_transaction_item,
    "product": _product,
    "employee": _employee,
}
