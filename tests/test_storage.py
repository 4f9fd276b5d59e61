"""What layers, loads, checks and streams leave on disk."""

import glob
import os
from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import money, rows, ts
from tillbook import schemas
from tillbook.operators import facts, headcount
from tillbook.operators.differences import unequal_rows
from tillbook.operators.scale import DEFAULT
from tillbook.plans import nightly, registry, suites
from tillbook.plans.rollups import Rollups
from tillbook.plans.star import Star
from tillbook.session import new_folder, passing, pin, unpin
from tillbook.sources.snapshots import SnapshotTable
from tillbook.streaming import loads


def folders(spark, label: str) -> set[str]:
    """Tables with this label that lie in the shared folder."""
    return set(glob.glob(f"{os.path.dirname(new_folder(spark, 'any'))}/{label}-*"))


@pytest.fixture
def kept(spark):
    """Labels whose tables a test may not leave behind."""
    labels = ["pit-facts", "fact-rows", "upsert", "upsert-newer", "receipt-lines", "history-points", "changed-receipts"]
    before = {x: folders(spark, x) for x in labels}
    return lambda: {x for x in labels if folders(spark, x) - before[x]}


def test_pinned_tables_go_with_their_scope(spark):
    outer = pin(spark.range(3), "scope")
    with passing(spark):
        inner = pin(spark.range(4), "scope")
        with passing(spark):
            innermost = pin(spark.range(5), "scope")
        assert not os.path.exists(innermost.pinned_at) and os.path.exists(inner.pinned_at)
    assert not os.path.exists(inner.pinned_at) and outer.count() == 3
    unpin(outer)
    assert not os.path.exists(outer.pinned_at)
    with pytest.raises(ValueError), passing(spark):
        failed = pin(spark.range(2), "scope")
        raise ValueError
    assert not os.path.exists(failed.pinned_at)


def test_shuffle_files_go_with_their_query(spark, star):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    assert spark.conf.get(key) == "true"
    try:
        spark.conf.set(key, "false")
        Star(spark, star.raw, date(2026, 8, 2))
        assert spark.conf.get(key) == "false", "a session that says otherwise keeps its setting"
    finally:
        spark.conf.set(key, "true")
    again = spark.range(1000).groupBy(F.col("id") % 7).count()
    assert rows(again) == rows(again), "a plan that runs twice gives the same rows"


def test_a_fact_of_two_merges_keeps_one_copy_of_its_lines(spark, star):
    before = folders(spark, "pit-facts")
    fact = facts.fct_sales(star.lines(), star.dims(), star.tz, replace(DEFAULT, versions_per_key=0))
    assert len(folders(spark, "pit-facts") - before) == 1
    assert unequal_rows(fact, star.stored("fct_sales").drop("sale_month")).isEmpty()


def test_loads_leave_only_their_table(spark, star, kept):
    limits = replace(DEFAULT, versions_per_key=0)
    raws = registry._sales_raws(star)
    run = Star(spark, lambda n: raws[n], registry.AS_OF, limits=limits, views=("raw_sales_transaction", "raw_sales_transaction_item", "stg_sales_transaction"))
    for name, df in star.dims().items():
        run.use(name, df)
    table = nightly.fact_table(spark, new_folder(spark, "leaves"))
    for mode in ("incremental", "incremental", "full"):
        nightly.run_fct_sales(run, table, mode)
        assert kept() == set()
        assert unequal_rows(table.read().drop("sale_month"), star.stored("fct_sales").drop("sale_month")).isEmpty()


def test_rollups_leave_only_their_groups(spark, star, kept):
    rollups = Rollups.build(star.stored("fct_sales_enriched"))
    assert kept() == set()
    asked = rollups.query(["transaction_count"]).first()[0]
    assert asked == star.stored("fct_sales").select("transaction_id").distinct().count()


def test_the_daily_table_is_not_written_for_the_snapshot(spark):
    fresh = Star(spark, registry.star(spark, "/root/testdata/sf0.001").raw, registry.AS_OF)
    fresh.stored("fct_store_headcount_monthly")
    assert not os.path.exists(f"{fresh.root}/employee_daily_store")


def test_mart_checks_are_computed_one_by_one(spark, star):
    marts = {name: star.stored(name) for name in schemas.MART}
    headers = star.stored("stg_sales_transaction")
    checked = nightly.mart_checks(star, marts, star.stored("stg_sales_transaction_item"), headers)
    assert all("/check-results-" in path for path in checked.inputFiles())
    single = rows(suites.fact_rules(marts["fct_sales"]))
    assert set(single) <= set(rows(checked))


def test_runs_of_state_are_the_counted_days(spark, star):
    day = date(2024, 4, 17)
    history = star.stored("employee_history")
    counted = F.col("is_employed") | F.coalesce("prev_is_employed", F.lit(False))
    days = headcount.daily_state(history, date(2023, 12, 1), day).filter(counted)
    runs = headcount.state_runs(history, date(2023, 12, 1), day)
    spread = runs.withColumn("calendar_date", F.explode(F.sequence("run_first", "run_last")))
    assert unequal_rows(spread.select(days.columns), days).isEmpty()
    assert spread.filter(F.trunc("calendar_date", "month") != F.col("month_start")).isEmpty()
    # No two runs could be one: equal histories give equal runs, whatever versions they are made of.
    ends = runs.select("employee_id", "month_start", *headcount.STATE, F.date_add("run_last", 1).alias("run_first"))
    keys = ["employee_id", "month_start", "run_first", *headcount.STATE]
    assert ends.select(keys).intersect(runs.select(keys)).isEmpty()
    assert runs.count() < days.count() / 3


def test_runs_do_not_depend_on_how_versions_are_cut(spark):
    columns = "employee_id bigint, store_id bigint, start_date date, end_date date, valid_from timestamp_ntz, valid_to timestamp_ntz"
    d = date.fromisoformat
    open_ = (ts("1900-01-01 00:00:00"), ts("9999-12-31 00:00:00"))
    person = (1, 7, d("2024-01-10"), d("2024-03-05"))
    whole = spark.createDataFrame([(*person, *open_), (2, 7, None, None, *open_)], columns)
    mid = ts("2024-02-11 03:00:00")
    cut = spark.createDataFrame([(*person, open_[0], mid), (*person, mid, open_[1]), (2, 7, None, None, *open_)], columns)
    a, b = (rows(headcount.state_runs(df, d("2024-01-01"), d("2024-04-30"))) for df in (whole, cut))
    assert a == b and len(a) == 5  # joining, rest of January, February, March, leaving
    assert {r[0] for r in a} == {1}


def test_state_of_joined_streams_lies_outside_the_heap(spark):
    provider = "spark.sql.streaming.stateStore.providerClass"
    before, base, state = spark.conf.get(provider), new_folder(spark, "state-test"), new_folder(spark, "state-test")
    at = ts("2024-01-01 10:00:00")
    line = spark.createDataFrame([(1, 1, 5, None, 2, money("3.00"), money("0.00"), at, at, 1)], schemas.RAW["sales_transaction_item"])
    head = spark.createDataFrame([(1, 3, 4, 2, at, "completed", at, ts("2024-01-02 10:00:00"), 1)], schemas.RAW["sales_transaction"])
    line.write.parquet(f"{base}/lines")
    head.write.parquet(f"{base}/heads")
    streams = [loads.read_files(spark, f"{base}/{n}", schemas.RAW[t]) for n, t in (("lines", "sales_transaction_item"), ("heads", "sales_transaction"))]
    joined = loads.join_lines_headers(*streams, "30 days")
    table = SnapshotTable(spark, f"{base}/table", mark="mark")
    loads.upsert_stream(joined, table, nightly.FACT_KEYS, state, "mark")
    assert "RocksDBStateStoreProvider" in open(f"{state}/offsets/0").read()
    assert spark.conf.get(provider) == before
    assert table.read().select("transaction_id", "store_id", "mark").collect() == [(1, 3, ts("2024-01-02 10:00:00"))]
