"""Exact distinct receipts from stored bitmaps."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tillbook.operators.scale import Limits
from tillbook.plans import metrics
from tillbook.plans.rollups import STORED, Rollup, Rollups, receipt_numbers


@pytest.fixture(scope="module")
def wide(spark):
    """Receipts on two stores with several categories each; ids are far apart, one receipt has lines of two days."""
    first = date(2024, 1, 30)
    data = []
    for i in range(200):
        for line in range(i % 4 + 1):
            data.append((i * 1_000_003, first + timedelta(days=i % 40), f"s{i % 2}", f"c{(i + line) % 3}", 1.0, 2.0, 3.0, line))
    data.append((0, first + timedelta(days=1), "s0", "c0", 1.0, 2.0, 3.0, 9))
    return spark.createDataFrame(
        data,
        "transaction_id bigint, full_date date, store_name string, category_name string, net_amount double, gross_amount double, gross_profit double, quantity int",
    )


@pytest.fixture(scope="module")
def rollups(wide):
    return Rollups.build(wide)


@pytest.mark.parametrize("by", [[], ["store_name"], ["category_name"], ["store_name", "category_name"]])
@pytest.mark.parametrize("grain", ["day", "month", "quarter", "year", None])
def test_rollups_answer_as_the_fact_does(rollups, wide, by, grain):
    answerable = any(set(by) <= set(r.by) and (r.grain == "day" or (r.grain == "month" and grain != "day") or grain in ("quarter", "year", None)) for r in STORED)
    if not answerable:
        with pytest.raises(metrics.MetricError, match="no stored rollup"):
            rollups.query(["transaction_count"], by, grain)
        return
    asked = wide.withColumn("period", metrics.period("full_date", grain)) if grain else wide
    keys = [*(["period"] if grain else []), *by]
    want = asked.groupBy(*keys).agg(F.count_distinct("transaction_id").alias("transaction_count"), F.sum("net_amount").alias("net_revenue"))
    assert rows(rollups.query(["transaction_count", "net_revenue"], by, grain)) == rows(want)


def test_the_smallest_rollup_that_answers_is_read(rollups):
    sizes = {r.name: n for r, n in rollups.sizes.items()}
    assert rollups.choose(["store_name"], "month").name == "store_name-day"
    assert rollups.choose([], "year").name == min(sizes, key=lambda n: (sizes[n], n))
    assert rollups.choose(["category_name"], "month").name == "category_name-month"
    with pytest.raises(metrics.MetricError, match="net"):
        rollups.query(["net"])


def test_a_week_does_not_nest_into_a_month(spark, wide):
    held = Rollups.build(wide, (Rollup((), "week"),))
    with pytest.raises(metrics.MetricError):
        held.query(["transaction_count"], [], "month")
    assert held.query(["transaction_count"], [], None).first()[0] == 200


def test_numbers_are_dense_within_a_month(wide):
    plain = {r[0]: r[1] for r in rows(receipt_numbers(wide))}
    assert len(set(plain.values())) == len(plain) == 200
    by_month = {}
    for n in plain.values():
        by_month.setdefault(n >> 40, []).append(n & ((1 << 40) - 1))
    assert all(sorted(places) == list(range(1, len(places) + 1)) for places in by_month.values())
    split = {r[0]: r[1] for r in rows(receipt_numbers(wide, Limits(rows_per_task=30)))}
    assert sorted(split.values()) == sorted(plain.values()), "a month cut into segments is numbered the same way"


def test_empty_fact(wide):
    held = Rollups.build(wide.limit(0))
    assert rows(held.query(["transaction_count"], ["store_name"], "month")) == []
