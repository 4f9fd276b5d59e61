import hashlib
from datetime import date, datetime
from functools import reduce
from operator import xor

import pytest
from pyspark.sql import functions as F

from conftest import money, rows, ts
from tillbook import schemas
from tillbook.operators import quality as Q
from tillbook.plans import metrics, suites
from tillbook.plans.metrics import METRICS, MetricError, Ratio, Simple


def bad(df):
    return {r["rule"]: r["bad_rows"] for r in df.collect() if r["bad_rows"]}


def test_raw_expectations(spark):
    clean = spark.createDataFrame(
        [(1, "A", money("10.0"), money("5.0"), ts("2026-01-01"))],
        "id bigint, product_sku string, unit_price decimal(12,2), unit_cost decimal(12,2), updated_at timestamp_ntz",
    )
    assert bad(suites.raw_checks(clean, "product")) == {}
    assert bad(suites.raw_checks(clean.limit(0), "product")) == {"row_count >= 1": 1}
    data = [(1, 1, 1, 1, ts("2026-01-01"), "completed", ts("2026-01-01")), (None, 1, 1, 1, ts("2026-01-01"), "refunded", ts("2026-01-01"))]
    tx = spark.createDataFrame(
        data,
        "transaction_id bigint, store_id bigint, employee_id bigint, payment_method_id bigint, transaction_ts timestamp_ntz, "
        "status string, updated_at timestamp_ntz",
    )
    results = suites.raw_checks(tx, "sales_transaction")
    assert bad(results) == {"not_null transaction_id": 1, "accepted_values status": 1}
    with pytest.raises(Q.QualityError, match="accepted_values status 1 bad rows"):
        Q.gate(results)


def test_row_rules_let_null_pass(spark):
    df = spark.createDataFrame([(1,), (None,), (5,), (9,)], "x int")
    rules = [
        Q.not_null("x"),
        Q.not_null("x", where=F.lit(False)),
        Q.accepted_values("x", [1, 5]),
        Q.accepted_range("x", 1, 9),
        Q.accepted_range("x", 1, 9, inclusive=False),
        Q.expression_is_true("x > 4"),
    ]
    assert [r["bad_rows"] for r in Q.check_rows(df, "t", rules).collect()] == [1, 0, 1, 0, 2, 1]
    assert rows(Q.failing_rows(df, Q.expression_is_true("x > 4"))) == [(1,)]


def test_all_row_rules_share_one_pass(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = Q.check_rows(df, "t", [Q.not_null("user_id"), Q.accepted_range("value", 0)])._jdf.queryExecution().toString()
    assert plan.split("== Physical Plan ==")[1].count("FileScan") == 1


def test_a_warning_does_not_block(spark):
    df = spark.createDataFrame([(None,)], "x int")
    Q.gate(Q.check_rows(df, "t", [Q.not_null("x", severity="warn")]))


def test_unique_orphans_and_tuples(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (2, None), (2, None), (None, 3), (None, 3)], "a int, b int")
    assert rows(Q.unique(df, ["a"])) == [(1, 2), (2, 2)]
    assert rows(Q.unique(df, ["a", "b"])) == [(1, 1, 2)]
    parent = spark.createDataFrame([(1,)], "id int")
    assert rows(Q.orphans(df, parent, "a", "id")) == [(2, 2)]
    assert rows(Q.distinct_tuples(df, "a", ["b"])) == [(1, 1), (2, 1), (None, 1)]


def test_totals_and_reconciliation(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "k string, v int")
    b = spark.createDataFrame([("x", 1), ("z", 5)], "k string, v int")
    assert bad(Q.same_totals(a, a, ["v"], "t")) == {}
    assert bad(Q.same_totals(a, b, ["v"], "t")) == {"same totals": 1}
    assert bad(Q.same_totals(a, a.limit(0), ["v"], "t")) == {"same totals": 2}
    got = rows(Q.reconcile(a, b, ["k"], "v"), "level", "k", "left_value", "right_value")
    assert got == [("key", "y", 2, 0), ("key", "z", 0, 5), ("total", None, 3, 6)]


def test_fingerprint_ignores_order_and_sees_changes(spark):
    df = spark.range(100).withColumn("v", F.col("id") * 2)
    first = rows(Q.fingerprint(df, ["id", "v"]))
    assert rows(Q.fingerprint(df.orderBy(F.col("id").desc()).repartition(7), ["id", "v"])) == first
    assert rows(Q.fingerprint(df.withColumn("v", F.col("v") + F.when(F.col("id") == 3, 1).otherwise(0)), ["id", "v"])) != first


def test_fingerprint_sums_63_bit_keys_without_nulls(spark):
    cells = [(1, 2, "a"), (None, 2, "a"), (3, None, None), (None, None, None), (1, 2, "a"), (9, 9, "")]
    df = spark.createDataFrame(cells, "a int, b long, c string")
    texts = ["|".join(str(x) for x in row if x is not None) for row in cells]
    keys = [int(hashlib.md5(t.encode()).hexdigest()[:16], 16) & (1 << 63) - 1 for t in texts]
    assert max(keys) >= 1 << 60
    assert rows(Q.fingerprint(df, ["a", "b", "c"]), "rows", "hash_sum", "hash_xor") == [(6, str(sum(keys)), reduce(xor, keys))]
    assert rows(Q.fingerprint(df.limit(0), ["a", "b", "c"]), "rows", "hash_sum", "hash_xor") == [(0, None, None)]


@pytest.mark.parametrize(
    ("newest", "status"),
    [("2026-01-10 00:00:00", "pass"), ("2026-01-08 22:00:00", "pass"), ("2026-01-08 21:59:59", "warn"),
     ("2026-01-07 00:00:00", "warn"), ("2026-01-06 23:59:59", "error")],
)
def test_freshness(spark, newest, status):
    df = spark.createDataFrame([(ts(newest),)], "updated_at timestamp_ntz")
    assert Q.freshness(df, "t", datetime(2026, 1, 10)).first()["status"] == status


def test_freshness_of_an_empty_table(spark):
    assert Q.freshness(spark.createDataFrame([], "updated_at timestamp_ntz"), "t", datetime(2026, 1, 10)).first()["status"] == "missing"


def test_contract(spark):
    contract = schemas.columns("a bigint not null; b string; c decimal(12,2)")
    ok = spark.createDataFrame([(1, "x", money(1))], "a int, b string, c decimal(38,6)")
    Q.assert_shape(ok, contract, "t")
    renamed = ok.withColumnRenamed("b", "bb").withColumn("c", F.lit("text"))
    assert Q.contract_mismatches(renamed.schema, contract) == [
        ("b", "", "varchar", "missing in definition"),
        ("bb", "varchar", "", "missing in contract"),
        ("c", "varchar", "number", "data type mismatch"),
    ]
    with pytest.raises(Q.ContractError, match="missing in definition"):
        Q.assert_shape(renamed, contract, "t")
    nulls = spark.createDataFrame([(None, None, None)], "b string, c decimal(12,2), a bigint")
    assert bad(Q.contract_nulls(nulls, contract, "t")) == {"not_null a": 1}


def test_mart_suites_hold_on_built_marts(star):
    """Everything but the deliberate gaps of the test data passes."""
    fct, dims = star.stored("fct_sales"), star.dims()
    assert bad(suites.fact_rules(fct)) == {}
    assert bad(suites.dim_rules(dims)) == {}
    assert bad(suites.fact_relationships(fct, dims)) == {}
    assert bad(suites.enriched_matches(fct, star.stored("fct_sales_enriched"))) == {}
    assert bad(suites.row_count_matches(fct, star.stored("stg_sales_transaction_item"), star.stored("stg_sales_transaction"))) == {}


def test_mart_suites_see_broken_marts(star):
    fct, dims, wide = star.stored("fct_sales"), star.dims(), star.stored("fct_sales_enriched")
    assert bad(suites.fact_rules(fct.withColumn("net_amount", F.lit(-1))))["expression net_amount >= 0"] == fct.count()
    assert "unique line" in bad(suites.fact_rules(fct.union(fct)))
    fewer = dims | {"dim_store": dims["dim_store"].filter("store_id != 3")}
    assert set(bad(suites.fact_relationships(fct, fewer))) == {"relationships store_key"}
    assert bad(suites.enriched_matches(fct, wide.filter("store_name != 'NATION_3'")))["same totals"] == 3
    assert set(bad(suites.check_calendar(dims["dim_date"].filter("date_key != 20240229")))) == {"contiguous"}
    assert set(bad(suites.check_clock(dims["dim_time"].filter("time_key != 1200")))) == {"1440 minutes"}
    raw = star.stored("raw_sales_transaction")
    changed = raw.union(raw.limit(1).withColumn("status", F.lit("other")))
    assert suites.status_changes(changed).count() == 1


def test_source_and_staging_rules_see_bad_rows(star):
    raw = {n: star.stored(f"raw_{n}") for n in schemas.RAW}
    raw["promotion"] = raw["promotion"].withColumn("amount", F.lit(money("200.00"))).withColumn("end_date", F.lit(date(2000, 1, 1)))
    raw["store"] = raw["store"].withColumn("store_name", F.lit("same"))
    raw["sales_transaction_item"] = raw["sales_transaction_item"].withColumn("quantity", F.lit(0))
    found = bad(suites.check_source_rules(raw))
    assert found["percentage <= 100"] == 4 and found["expression end_date >= start_date"] == 9
    assert found["unique store_name"] == 1 and found["accepted_range quantity"] > 0
    keys = star.stored("raw_store").select(F.col("id").alias("store_id"))
    broken = keys.union(keys.limit(2)).union(keys.limit(1).select(F.lit(None).cast("bigint")))
    assert bad(Q.check_keys(broken, "t", ["store_id"])) == {"not_null store_id": 1, "unique store_id": 2}
    items, tx = star.stored("stg_sales_transaction_item"), star.stored("stg_sales_transaction")
    fewer = star.stored("fct_sales").filter("line_number != 1")
    assert bad(suites.row_count_matches(fewer, items, tx)) == {"same totals": 1}


def test_sales_integrity_cases(spark):
    tx = spark.createDataFrame(
        [(1, 1, 10, ts("2024-01-10 05:00")), (2, 2, 10, ts("2024-01-10 05:00")), (3, 1, 10, ts("2024-01-20 05:00")), (4, 1, 10, ts("2024-01-10 20:00"))],
        "transaction_id bigint, store_id bigint, employee_id bigint, transaction_ts timestamp_ntz",
    )
    emp = spark.createDataFrame([(10, 1, date(2024, 1, 1), date(2024, 1, 10))], "employee_id bigint, store_id bigint, start_date date, end_date date")
    # Sale 1 is on the last working day; sale 4 is on the next local day.
    assert rows(suites.bad_sellers(tx, emp), "transaction_id") == [(2,), (3,), (4,)]
    assert rows(suites.off_hours(tx), "transaction_id") == [(4,)]
    lines = spark.createDataFrame(
        [(1, 1, 5, 7, money(9)), (1, 2, 5, None, money(9)), (2, 2, 5, None, money(8)), (3, 1, 5, 7, money(9))],
        "transaction_id bigint, line_number int, product_id bigint, promotion_id bigint, regular_price decimal(12,2)",
    )
    assert rows(suites.noncontiguous(tx, lines), "transaction_id") == [(2,), (4,)]
    prod = spark.createDataFrame([(5, money(9))], "product_id bigint, unit_price decimal(12,2)")
    promo = spark.createDataFrame([(7, date(2024, 1, 1), date(2024, 1, 15))], "promotion_id bigint, start_date date, end_date date")
    assert rows(suites.bad_lines(lines, tx, prod, promo), "transaction_id", "line_number") == [(2, 2), (3, 1)]
    bridge = spark.createDataFrame([(5, 8)], "product_id bigint, promotion_id bigint")
    assert rows(suites.invalid_promo_pairs(lines, bridge)) == [(5, 7, 2)]


# ------------------------------------------------------------------ metrics
def test_the_metrics_are_the_agreed_ones():
    assert len(METRICS) == 15
    for m in METRICS.values():
        metrics.validate_metric(m)


# What each metric means as one expression.
EXPRESSIONS = {
    "net_revenue": "SUM(net_amount)",
    "quantity_sold": "SUM(quantity)",
    "transaction_count": "COUNT(DISTINCT transaction_id)",
    "gross_margin": "CAST(SUM(gross_profit) AS DOUBLE) / CAST(NULLIF(SUM(net_amount), 0) AS DOUBLE)",
    "average_basket_value": "SUM(net_amount) / NULLIF(COUNT(DISTINCT transaction_id), 0)",
    "closing_headcount": "SUM(closing_headcount)",
    "employee_months": "SUM(average_headcount)",
    "revenue_per_employee": "CAST(SUM(net_revenue) AS DOUBLE) / CAST(NULLIF(SUM(average_headcount), 0) AS DOUBLE)",
}


@pytest.mark.parametrize("name", EXPRESSIONS)
def test_expressions(name):
    assert metrics.expression(METRICS[name]) == EXPRESSIONS[name]


def test_refused_definitions(monkeypatch):
    ratio = Ratio("r", "R", "d", "closing_headcount", "joiners")
    with pytest.raises(MetricError, match="semi-additive"):
        metrics.validate_metric(ratio)
    with pytest.raises(MetricError, match="one semantic model"):
        metrics.validate_metric(Ratio("r", "R", "d", "net_revenue", "joiners"))
    with pytest.raises(MetricError, match="label"):
        metrics.validate_metric(Simple("s", "", "d", "joiners"))


def test_unknown_columns_and_dimensions_are_refused(star):
    tables = {"fct_sales_enriched": star.stored("fct_sales_enriched")}
    with pytest.raises(MetricError, match="no dimension"):
        metrics.query(tables, ["net_revenue"], by=["no_such"])
    with pytest.raises(MetricError, match="unknown columns"):
        metrics.query({"fct_sales_enriched": star.stored("fct_sales")}, ["net_revenue"])


def test_catalog_warns_about_semi_additive_metrics(spark):
    warned = {r["metric"] for r in metrics.catalog(spark).filter("warning is not null").collect()}
    assert warned == {"closing_headcount", "opening_headcount"}


def test_metrics_of_two_models_side_by_side(star):
    tables = {n: star.stored(n) for n in schemas.MART}
    both = metrics.query(tables, ["net_revenue", "joiners"], by=["store_name"], grain="year")
    alone = metrics.query(tables, ["net_revenue"], by=["store_name"], grain="year")
    assert both.count() >= alone.count()
    assert both.exceptAll(both.distinct()).isEmpty()
    top = metrics.query(tables, ["net_revenue"], by=["store_name"], order="net_revenue", limit=3).collect()
    assert len(top) == 3 and top[0]["net_revenue"] >= top[1]["net_revenue"] >= top[2]["net_revenue"]


def test_rules_are_measured_by_the_write(spark):
    """Two appends, then the source is taken away: the results need neither it nor a scan of the table."""
    from tillbook.operators.quality import Rule, Watched, check_rows, not_null, sum_watched, watched_results
    from tillbook.session import new_folder

    rules = [not_null("v"), Rule("small", F.col("k") > 5, "warn")]
    source, table = new_folder(spark, "source"), new_folder(spark, "table")
    data = spark.createDataFrame([(i, None if i % 3 == 0 else "x") for i in range(10)], "k int, v string")
    watched = Watched("t", rules)
    for part in ("k < 4", "k >= 4"):
        data.filter(part).write.mode("overwrite").parquet(source)
        watched.watch(spark.read.parquet(source)).write.mode("append").parquet(table)
    data.limit(0).write.mode("overwrite").parquet(source)
    found = watched.results()
    assert len(found) == 4 and {r[4] for r in found} == {4, 6}
    got = sum_watched(watched_results(spark, found), min_rows=1)
    assert rows(got) == rows(check_rows(spark.read.parquet(table), "t", rules, min_rows=1))
    few = sum_watched(watched_results(spark, found), min_rows=11).filter("rule like 'row_count%'")
    assert rows(few, "bad_rows") == [(1,)]


def test_rules_are_measured_by_stream_batches(spark):
    from tillbook.operators.quality import Watched, not_null, sum_watched, watched_results
    from tillbook.session import new_folder
    from tillbook.streaming import loads

    folder, path, state = (new_folder(spark, n) for n in ("files", "raw", "state"))
    shape = spark.createDataFrame([], "k int, v string").schema
    results = []
    for batch in ([(1, "a"), (2, None)], [(3, None)], []):
        spark.createDataFrame(batch, shape).write.mode("append").parquet(folder)
        stream = loads.read_files(spark, folder, shape)
        results += loads.ingest_watched(stream, path, state, Watched("t", [not_null("v")]))
    assert rows(sum_watched(watched_results(spark, results)), "bad_rows") == [(2,)]
    assert spark.read.parquet(path).count() == 3
