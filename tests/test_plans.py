"""What the physical plans must and must not contain."""

import re
from datetime import datetime

from pyspark.sql import functions as F

from tillbook.operators import facts, history
from tillbook.plans import metrics
def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_history_sorts_and_shuffles_once_after_the_copies(star):
    plan = physical(star.fresh("product_history"))
    assert plan.count("Window [") == 3 and plan.count("Sort [") == 1
    assert plan.count("Exchange hashpartitioning") == 2


def test_day_states_are_not_shuffled(star):
    plan = physical(star.fresh("employee_daily_store"))
    assert plan.count("Exchange") == 1 and plan.index("Generate explode") < plan.index("Exchange")


def test_fact_lookups_are_broadcast(star):
    plan = physical(star.fresh("fct_sales"))
    assert plan.count("BroadcastHashJoin") >= 7 and "LeftOuter, BuildRight" in plan


def test_metric_reads_only_its_columns(star):
    tables = {"fct_sales_enriched": star.stored("fct_sales_enriched")}
    plan = physical(metrics.query(tables, ["net_revenue"], by=["store_name"], where="full_date >= date'2024-01-01'"))
    scan = re.search(r"FileScan parquet \[([^\]]*)\]", plan).group(1)
    assert sorted(c.split("#")[0] for c in scan.split(",")) == ["full_date", "net_amount", "store_name"]
    assert "PushedFilters: [IsNotNull(full_date), GreaterThanOrEqual(full_date,2024-01-01)]" in plan


def test_fact_slices_are_pruned(star):
    plan = physical(star.stored("fct_sales").filter("sale_month = 202401").agg(F.sum("net_amount")))
    assert "PartitionFilters: [isnotnull(sale_month" in plan


def test_slice_filter_passes_the_copy_removal(star):
    items = history.dedupe_copies(star.stored("raw_sales_transaction_item"))
    plan = physical(facts.incremental_slice(items, star.stored("stg_sales_transaction"), datetime(2026, 1, 1)))
    # The semi join with the changed receipts is below the aggregate, and the id range is at the scan.
    assert plan.index("HashAggregate") < plan.index("LeftSemi")
    assert "GreaterThanOrEqual(transaction_id," in plan


def test_lines_are_shuffled_once_up_to_the_join(star):
    plan = physical(star.lines())
    dealt = [row for row in plan.splitlines() if "Exchange hashpartitioning" in row]
    # The lines' own exchange, and one of the headers if they are too many to send.
    assert plan.count("REPARTITION_BY_COL") == 1 and len(dealt) <= 2
    assert all("hashpartitioning(transaction_id" in row and "line_number" not in row for row in dealt)


def test_merged_point_in_time_join_reads_its_facts_from_one_write(star, spark):
    from dataclasses import replace

    from tillbook.operators.pit import pit_join

    limits = replace(star.limits, versions_per_key=0)
    take = ["valid_from", "unit_cost"]
    plan = physical(pit_join(star.lines(), star.stored("product_history"), "product_id", "transaction_ts", take, limits=limits))
    assert plan.count("FileScan") == 2 and plan.count("pit-facts") == 1
