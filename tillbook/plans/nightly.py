"""The nightly run: load RAW, gate, layers, incremental fact, snapshot, checks."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime, time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook import schemas
from tillbook.operators import facts, history, staging
from tillbook.operators.quality import WATCHED, Watched, assert_shape, freshness, gate, report, settled, stack, sum_watched, watched_results
from tillbook.plans import suites
from tillbook.plans.months import MonthlyHeadcount
from tillbook.plans.star import Star
from tillbook.session import passing, pin
from tillbook.sources.histories import MaintainedHistory
from tillbook.sources.ingest import load_appended, read_raw, replace_table
from tillbook.sources.nights import Nights
from tillbook.sources.snapshots import SnapshotTable

FACT_KEYS = ["transaction_id", "line_number"]


def load_raw(spark: SparkSession, source: Callable[[str], DataFrame], root: str, load_id: int) -> None:
    """Append the changed rows of the cursor tables and replace the small ones; RAW rules are measured by the appends."""
    found = []
    for name, pk in schemas.APPENDED.items():
        rules = Watched(name, suites.RAW_RULES[name]())
        load_appended(source(name), f"{root}/raw/{name}", schemas.RAW[name], pk, load_id, rules.watch)
        found += rules.results()
    watched_results(spark, found).coalesce(1).write.mode("append").parquet(f"{root}/raw_checks")
    for name in schemas.REPLACED:
        replace_table(source(name), f"{root}/raw/{name}")


def raw_results(spark: SparkSession, root: str) -> DataFrame:
    """RAW expectations over all loads, from what the appends measured.

    A table whose measured rows are not its rows, because a load was lost between its two writes, is scanned instead.
    """
    seen = spark.read.schema(WATCHED).parquet(f"{root}/raw_checks")
    raw = raw_table(spark, root)
    measured = {r[0]: r[1] for r in seen.groupBy("table", "rule").agg(F.sum("rows").alias("n")).groupBy("table").agg(F.max("n")).collect()}
    lost = [t for t in suites.RAW_RULES if measured.get(t) != raw(t).count()]
    out = sum_watched(seen.filter(~F.col("table").isin(lost)) if lost else seen, min_rows=1)
    return stack([out, *[suites.raw_checks(raw(t), t) for t in lost]])


def raw_table(spark: SparkSession, root: str) -> Callable[[str], DataFrame]:
    return lambda name: read_raw(spark, f"{root}/raw/{name}", schemas.RAW[name])


def fact_table(spark: SparkSession, root: str) -> SnapshotTable:
    return SnapshotTable(spark, f"{root}/marts/fct_sales", slice_by="sale_month", mark="source_updated_at")


def run_fct_sales(star: Star, table: SnapshotTable, mode: str = "incremental", batch: str | None = None) -> None:
    """Load the fact: rows at or after its own watermark by key, or everything.

    An empty or missing target has no watermark and loads all rows.
    """
    watermark = table.high_water() if mode == "incremental" else None
    # Lines are dealt out by receipt once, which serves both the removal of copies and the join.
    items = history.dedupe_copies(star.stored("raw_sales_transaction_item").repartition("transaction_id"))
    tx, dimensions = star.stored("stg_sales_transaction"), star.dims()
    with passing(star.spark):
        lines = facts.incremental_slice(items, tx, watermark, star.limits)
        df = facts.fct_sales(lines, dimensions, star.tz, star.limits)
        assert_shape(df, schemas.MART["fct_sales"], "fct_sales")
        # Pinned, so that the shuffles of the joins are gone before the table writes its own.
        df = pin(df.withColumn("sale_month", facts.sale_month()), "fact-rows")
        if mode == "full":
            table.replace(df, batch, FACT_KEYS)
        else:
            table.upsert(df, FACT_KEYS, batch)


def maintained_history(star: Star, root: str, name: str) -> MaintainedHistory:
    key, tracked, type1 = history.HISTORIES[name]
    return MaintainedHistory(star.spark, f"{root}/histories/{name}", key, tracked, type1, limits=star.limits)


def merge_loads(star: Star, kept: MaintainedHistory, name: str, load_id: int) -> None:
    """Bring the loads that the history lacks into it, this one in any case: a repeated load may have added rows.

    RAW is partitioned by load, so only those loads are read.
    """
    raw = star.raw(name)
    merged = [int(b) for b in kept.table.batches() if int(b) != load_id]
    rows = raw.filter(~F.col("_load_id").isin(merged)) if merged else raw
    stage = {"product": staging.stage_product, "employee": lambda df: history.named_employees(staging.stage_employee(df))}
    kept.merge(stage[name](rows), str(load_id), again=True)


def history_checks(star: Star) -> DataFrame:
    """The rules of both histories."""
    (product_id, tracked, names), (employee_id, store, people) = history.HISTORIES["product"], history.HISTORIES["employee"]
    product, employee = star.stored("product_history"), star.stored("employee_history")
    return settled(
        [
            suites.check_scd2(
                product, "product_history", product_id, tracked, names, source=star.fresh("stg_product"), limits=star.limits
            ),
            suites.check_scd2(employee, "employee_history", employee_id, store, people, gapless=True, limits=star.limits),
        ]
    )


def mart_checks(star: Star, marts: dict[str, DataFrame], lines: DataFrame, headers: DataFrame) -> DataFrame:
    """The rules of all marts and histories; a night with an error among them is not published."""
    return settled(
        [
            suites.contract_checks(marts),
            suites.fact_rules(marts["fct_sales"]),
            suites.dim_rules(star.dims()),
            suites.fact_relationships(marts["fct_sales"], star.dims()),
            suites.enriched_matches(marts["fct_sales"], marts["fct_sales_enriched"]),
            suites.check_headcount(
                marts["fct_store_headcount_monthly"], star.stored("employee_history"), marts["fct_sales"], marts["dim_store"], marts["dim_date"], star.as_of
            ),
            suites.row_count_matches(marts["fct_sales"], lines, headers),
        ]
    ).unionByName(history_checks(star))


def source_checks(raw: Callable[[str], DataFrame], relationships: DataFrame, as_of: date) -> DataFrame:
    """What the source should keep to; its breaches are reported."""
    return settled(
        [
            relationships,
            suites.check_source_rules({n: raw(n) for n in schemas.RAW}),
            report("sales_transaction", "status never changes", suites.status_changes(raw("sales_transaction"))),
            *[freshness_rule(raw(t), t, as_of) for t in schemas.APPENDED],
        ]
    )


def freshness_rule(raw: DataFrame, table: str, as_of: date) -> DataFrame:
    """Freshness at the end of the report day as a rule that never blocks."""
    late = freshness(raw, table, datetime.combine(as_of, time.max)).filter("status <> 'pass'")
    return report(table, "fresh", late, severity="warn")


def run_pipeline(
    spark: SparkSession,
    source: Callable[[str], DataFrame],
    root: str,
    as_of: date,
    load_id: int,
    mode: str = "incremental",
    blocking_relationships: bool = True,
) -> DataFrame:
    """One night; returns the check results, those of freshness as warnings.

    Bad RAW, repeated staging keys and staging rows without their parent stop the run before history is built.
    With blocking_relationships=False missing parents are only reported. A mart that breaks a rule stops the run
    before anything is published: `nights(...).read(mart)` shows all marts of the night before.
    """
    load_raw(spark, source, root, load_id)
    raw = raw_table(spark, root)
    gate(raw_results(spark, root))

    # A new folder per attempt, so a night that failed half-way can run again. RAW is read in place, and
    # staging and the wide fact stay views: a night must not rewrite what it did not change.
    layers = f"{root}/layers/load-{load_id}-{uuid.uuid4().hex[:8]}"
    views = (*(f"raw_{n}" for n in schemas.RAW), "stg_sales_transaction", "fct_sales_enriched")
    star = Star(spark, raw, as_of, root=layers, views=views)
    gate(suites.staging_keys({n: star.fresh(f"stg_{n}") for n in suites.STAGING_KEYS}))
    parents = {n: star.fresh(f"stg_{n}") for n in suites.STAGING_PARENTS}
    relationships = pin(suites.staging_relationships(parents), "staging-relationships")
    if blocking_relationships:
        gate(relationships)
    kept = {name: maintained_history(star, root, name) for name in history.HISTORIES}
    for name, table in kept.items():
        merge_loads(star, table, name, load_id)
        star.use(f"{name}_history", table.versions())
    fact = fact_table(spark, root)
    # No batch id: a repeated load id may bring new rows, and the load by key adds nothing twice.
    run_fct_sales(star, fact, mode)
    star.use("fct_sales", fact.read())
    months = MonthlyHeadcount(spark, f"{root}/marts/fct_store_headcount_monthly", tz=star.tz)
    months.refresh(kept["employee"], fact, star.stored("dim_store"), star.stored("dim_date"), as_of)
    star.use("fct_store_headcount_monthly", months.read(as_of))
    star.build(without=("employee_daily_store",))

    marts = {name: star.stored(name) for name in schemas.MART}
    checked = pin(mart_checks(star, marts, parents["sales_transaction_item"], parents["sales_transaction"]), "mart-checks")
    gate(checked)
    places = {n: [f"{layers}/{n}"] for n in star.dims()}
    places |= {"fct_sales": list(fact.directories().values()), "fct_store_headcount_monthly": list(months.table.directories().values())}
    nights(spark, root).publish(places, f"{as_of}#{load_id}")
    results = checked.unionByName(source_checks(raw, relationships, as_of))
    # Written, because the next night replaces tables that the rules read.
    return pin(results.withColumn("load_id", F.lit(load_id)), "night-checks")


def nights(spark: SparkSession, root: str) -> Nights:
    return Nights(spark, f"{root}/marts/nights")
