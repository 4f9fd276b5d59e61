"""Differences of two snapshots, ranges of touched keys, co-located tables, SQL functions."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import day, money, rows, ts
from tillbook.functions import columns as C
from tillbook.functions.sql_surface import create_functions
from tillbook.operators import facts
from tillbook.operators.differences import differing_ranges, table_differences
from tillbook.operators.scale import in_ranges, key_ranges, merge_ranges
from tillbook.plans import registry
from tillbook.session import new_folder


def rows_scanned(df) -> int:
    """Rows that the Parquet readers of a plan gave out, after whole row groups were skipped."""
    df._jdf.queryExecution().executedPlan()
    df.write.format("noop").mode("overwrite").save()
    found, open_ = 0, [df._jdf.queryExecution().executedPlan()]
    df.collect()
    while open_:
        node = open_.pop()
        if "FileSourceScanExec" in node.getClass().getName():
            found += node.metrics().apply("numOutputRows").value()
        children = node.children()
        open_ += [children.apply(i) for i in range(children.size())]
    return found




@pytest.mark.parametrize("rows_at_once", [1, 40, 100_000])
def test_exactly_the_differing_keys(spark, rows_at_once):
    rng = random.Random(5)
    one = {(k, n): (rng.choice(["a", "b", None]), rng.choice([0.5, None])) for k in rng.sample(range(-10**9, 10**12), 400) for n in (1, 2)}
    two = dict(one)
    keys = sorted(one)
    want = []
    for key in keys[::97]:
        del two[key]
        want.append((*key, "only first"))
    for key in keys[5::131]:
        two[key] = ("changed", None)
        want.append((*key, "changed"))
    two[(keys[50][0] + 1, 1)] = (None, None)
    want.append((keys[50][0] + 1, 1, "only second"))
    frames = [spark.createDataFrame([(*k, *v) for k, v in t.items()], "k bigint, line int, v string, w double") for t in (one, two)]
    assert rows(table_differences(*frames, "k", ["line"], rows=rows_at_once)) == sorted(want, key=repr)
    assert rows(table_differences(frames[0], frames[0], "k", ["line"])) == []


def test_swapped_values_are_a_difference(spark):
    """Two rows of one range that exchange a value keep every column's sum."""
    one = spark.createDataFrame([(1, 1, "a", 1.0), (2, 1, "b", 2.0)], "k bigint, line int, v string, w double")
    two = spark.createDataFrame([(1, 1, "b", 1.0), (2, 1, "a", 2.0)], "k bigint, line int, v string, w double")
    assert rows(table_differences(one, two, "k")) == [(1, "changed"), (2, "changed")]
    nothing = one.limit(0)
    assert rows(table_differences(nothing, nothing, "k")) == [] and rows(table_differences(one, nothing, "k"), "k") == [(1,), (2,)]


def test_only_differing_ranges_are_read_again(spark):
    path = [new_folder(spark, "d") for _ in range(2)]
    base = spark.range(200_000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    base.repartitionByRange(20, "k").sortWithinPartitions("k").write.parquet(path[0])
    base.withColumn("v", F.when(F.col("k") == 77_777, -1).otherwise(F.col("v"))).repartitionByRange(20, "k").sortWithinPartitions("k").write.parquet(path[1])
    one, two = (spark.read.parquet(p) for p in path)
    ranges = differing_ranges(one, two, "k", ["k", "v"], rows=1000)
    assert len(ranges) == 1 and ranges[0][1] - ranges[0][0] < 1000 and ranges[0][0] <= 77_777 <= ranges[0][1]
    assert rows_scanned(one.filter(in_ranges("k", ranges))) <= 20_000, "one file of twenty"
    assert rows(table_differences(one, two, "k", rows=1000)) == [(77_777, "changed")]


# ------------------------------------------------------------------ ranges of touched keys
def test_ranges_are_cut_at_the_widest_gaps():
    assert merge_ranges([(1, 2), (4, 5), (100, 101), (103, 110)], 2) == [(1, 5), (100, 110)]
    assert merge_ranges([(1, 2), (4, 5)], 64) == [(1, 2), (4, 5)] and merge_ranges([], 3) == []


def test_key_ranges_hold_every_key(spark):
    rng = random.Random(6)
    values = [rng.choice([0, 10**6, 10**12]) + rng.randrange(1000) for _ in range(300)]
    found = key_ranges(spark.createDataFrame([(v,) for v in values], "k bigint"), "k", 8)
    assert len(found) <= 8 and all(any(lo <= v <= hi for lo, hi in found) for v in values)
    assert sum(hi - lo for lo, hi in found) < 10**12 / 100, "the widest gap is left out"
    assert key_ranges(spark.createDataFrame([], "k bigint"), "k") == []


def test_one_old_and_one_new_receipt_do_not_read_what_lies_between(star, spark):
    lines = star.stored("raw_sales_transaction_item").drop("_load_id")
    ends = lines.agg(F.min("transaction_id"), F.max("transaction_id")).first()
    corrected = F.col("transaction_id").isin(list(ends))
    stamped = lines.withColumn("updated_at", F.when(corrected, C.at(ts("2030-01-01"))).otherwise(F.col("updated_at")))
    path = new_folder(spark, "receipts")
    stamped.repartitionByRange(10, "transaction_id").sortWithinPartitions("transaction_id").write.parquet(path)
    stored = spark.read.parquet(path)
    tx = star.stored("stg_sales_transaction")
    got = facts.incremental_slice(stored, tx, ts("2029-01-01"))
    assert {r[0] for r in rows(got, "transaction_id")} <= set(ends) and not got.isEmpty()
    touched = in_ranges("transaction_id", key_ranges(stored.filter(F.col("updated_at") >= C.at(ts("2029-01-01"))), "transaction_id"))
    assert rows_scanned(stored.filter(touched)) <= stored.count() * 3 // 10, "two files of ten"


# ------------------------------------------------------------------ co-located tables
def test_bucketed_headers_and_lines_meet_without_a_shuffle(star, spark):
    joined = registry.bucketed_lines(star).hint("merge")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert joined.count() == star.lines().count()


# ------------------------------------------------------------------ SQL functions
def test_sql_functions_equal_the_column_functions(spark):
    prefix = f"t{uuid.uuid4().hex[:6]}_"
    assert prefix + "discount" in create_functions(spark, prefix)
    data = [
        (1, "a", ts("2024-01-01 20:30:00"), day("2024-01-01"), day("2024-01-31"), day("2024-01-31"), 3, money("10.55"), "percentage", money("12.50")),
        (2, None, ts("2024-03-01 01:00:00"), day("2024-01-01"), None, day("2023-12-31"), 2, money("9.99"), "fixed_amount", money("1250.00")),
        (3, "x|y", None, None, None, None, None, None, None, None),
    ]
    schema = "k bigint, s string, t timestamp_ntz, a date, b date, d date, q int, price decimal(12,2), kind string, amount decimal(12,2)"
    df = spark.createDataFrame(data, schema)
    df.createOrReplaceTempView(f"{prefix}rows")
    calls = {
        "surrogate_key(array(cast(k as string), s))": C.surrogate_key("k", "s"),
        "to_local(t)": C.to_local("t"),
        "local_date(t)": C.local_date("t"),
        "yyyymmdd(a)": C.yyyymmdd("a"),
        "employed_on(a, b, d)": C.employed_on("a", "b", F.col("d")),
        "sells_on(a, b, d)": C.employed_on("a", "b", F.col("d"), inclusive_end=True),
        "discount(q, price, kind, amount)": C.discount(F.col("q"), F.col("price"), F.col("kind"), F.col("amount")),
        "promo_label(kind, amount)": C.promotion_label(F.col("kind"), F.col("amount")),
        "margin(price, amount)": C.ratio(F.col("price"), F.col("amount")),
        "open_start()": C.open_start(),
        "open_end()": C.open_end(),
        "unknown_key()": F.lit(C.UNKNOWN_KEY).cast("bigint"),
        "no_promotion_key()": F.lit(C.NO_PROMOTION_KEY).cast("bigint"),
    }
    for call, column in calls.items():
        got = spark.sql(f"select k, {prefix}{call} as v from {prefix}rows")
        assert rows(got) == rows(df.select("k", column.alias("v"))), call
        assert "PythonUDF" not in got._jdf.queryExecution().executedPlan().toString()
