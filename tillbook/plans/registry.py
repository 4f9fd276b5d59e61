"""Every registered query, over the retail tables derived from one test data folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, IntegerType, TimestampNTZType

from tillbook import schemas
from tillbook.functions.columns import LOCAL_TZ, at, local_date
from tillbook.functions.sql_surface import create_functions
from tillbook.operators import differences, dims, facts, headcount, history, quality, staging
from tillbook.operators.pit import pit_join
from tillbook.operators.scale import Limits, broadcast_if_small
from tillbook.plans import metrics, nightly, reports, suites
from tillbook.plans.months import MonthlyHeadcount
from tillbook.plans.rollups import Rollups
from tillbook.plans.star import Star
from tillbook.session import new_folder
from tillbook.sources import ingest, testdata
from tillbook.sources.histories import MaintainedHistory
from tillbook.sources.snapshots import SnapshotTable, apply_changes
from tillbook.sources.tables import materialize
from tillbook.streaming import loads

AS_OF = date(2026, 8, 2)  # last day of the given sales
CUT = datetime(2025, 1, 1)
LATE = datetime(2022, 1, 1)
NOW = datetime(2026, 8, 2, 12)

_stars: dict[tuple[str, str], Star] = {}


def star(spark: SparkSession, sf_dir: str) -> Star:
    """Layers of one folder, written once per Spark application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stars:
        _stars[key] = Star(spark, lambda name: testdata.retail_table(spark, sf_dir, name), AS_OF)
    return _stars[key]


def present(df: DataFrame) -> DataFrame:
    """Types both engines print alike: money as DOUBLE, whole numbers as BIGINT, dates and times as text."""
    out = []
    for f in df.schema.fields:
        c, t = F.col(f.name), f.dataType
        if isinstance(t, DecimalType):
            c = (F.round(c, 2) if t.precision > 20 else c).cast("double")
        elif isinstance(t, IntegerType):
            c = c.cast("bigint")
        elif isinstance(t, DateType):
            c = c.cast("string")
        elif isinstance(t, TimestampNTZType):
            # Text of a wall clock, padded to microseconds.
            text = c.cast("string")
            c = F.rpad(F.when(F.length(text) == 19, F.concat(text, F.lit("."))).otherwise(text), 26, "0")
        out.append(c.alias(f.name))
    return df.select(out)


Build = Callable[[Star], DataFrame]
_BUILDS: dict[str, Build] = {}


def registered(build: Build) -> Build:
    _BUILDS[build.__name__] = build
    return build


def _marts(s: Star) -> dict[str, DataFrame]:
    return {name: s.stored(name) for name in schemas.MART}


def _source(s: Star, name: str) -> DataFrame:
    """A table as the source shows it: one row per change, without load ids."""
    raw = s.stored(f"raw_{name}")
    return raw.filter("_load_id = 1").drop("_load_id") if "_load_id" in raw.columns else raw


# ------------------------------------------------------------------ scans and loads
for _name in schemas.RAW:
    _BUILDS[f"scan_{_name}"] = lambda s, n=_name: s.fresh(f"raw_{n}")


@registered
def extract_incremental(s: Star) -> DataFrame:
    return ingest.extract_incremental(_source(s, "product"), "updated_at", CUT)[0]


@registered
def drop_boundary(s: Star) -> DataFrame:
    source = _source(s, "product")
    rows, _ = ingest.extract_incremental(source, "updated_at", CUT)
    # Some of the boundary rows are in RAW already.
    raw = source.filter((F.col("updated_at") < at(CUT)) | (F.col("brand_id") <= 12))
    return ingest.drop_boundary(rows, raw, ["id"], "updated_at", CUT)


@registered
def append_loads(s: Star) -> DataFrame:
    """Two loads by cursor; the second sees everything and adds what is new."""
    path, source = new_folder(s.spark, "append"), _source(s, "employee")
    early = source.filter("updated_at <= timestamp_ntz'2024-01-15 00:00:00'")
    for load_id, rows in [(1, early), (2, source)]:
        ingest.load_appended(rows, path, schemas.RAW["employee"], ["id"], load_id)
    return ingest.read_raw(s.spark, path, schemas.RAW["employee"])


@registered
def replace_table(s: Star) -> DataFrame:
    path, bridge = new_folder(s.spark, "replace"), s.stored("raw_promotion_product")
    ingest.replace_table(bridge.filter("promotion_id < 5"), path)
    ingest.replace_table(bridge, path)
    return s.spark.read.schema(bridge.schema).parquet(path)


@registered
def latest_product(s: Star) -> DataFrame:
    return history.latest_state(s.stored("raw_product"), ["id"]).drop("_load_id")


@registered
def guarded_changes(s: Star) -> DataFrame:
    now = history.latest_state(s.stored("raw_product"), ["id"]).drop("_load_id")
    events = now.filter("unit_cost < 950").select(
        "id",
        F.col("unit_cost").alias("old_cost"),
        F.col("unit_price").alias("old_price"),
        (F.col("unit_cost") + 100).cast("decimal(12,2)").alias("new_cost"),
    )
    guards = {"unit_cost": "old_cost", "unit_price": "old_price"}
    return apply_changes(now, events, "id", guards, {"unit_cost": "new_cost"}).select("id", "unit_cost", "unit_price")


@registered
def explode_lines(s: Star) -> DataFrame:
    line = F.transform(
        F.sequence(F.lit(1), F.col("payment_method_id").cast("int")),
        lambda i: F.struct((F.col("store_id") + i).alias("product_id"), (i * 2).alias("quantity")),
    )
    headers = s.stored("stg_sales_transaction").select("transaction_id", line.alias("lines"))
    return facts.explode_lines(headers)


@registered
def upsert_snapshot(s: Star) -> DataFrame:
    """A keyed table sliced by store: rows change, move between slices, and arrive."""
    tx = s.stored("stg_sales_transaction").select("transaction_id", "store_id", "employee_id", "transaction_ts")
    table = SnapshotTable(s.spark, new_folder(s.spark, "upsert"), slice_by="store_id")
    table.replace(tx.filter("transaction_ts < timestamp_ntz'2025-01-01 00:00:00'"))
    changed = tx.filter("transaction_ts >= timestamp_ntz'2024-06-01 00:00:00'")
    moved = F.when(F.col("employee_id") < 100, F.col("store_id") + 1).otherwise(F.col("store_id"))
    table.upsert(changed.withColumn("store_id", moved), ["transaction_id"])
    return table.read()


# ------------------------------------------------------------------ staging, history, dimensions
for _name in [
    *(f"stg_{n}" for n in schemas.REPLACED),
    "stg_product",
    "stg_employee",
    "stg_sales_transaction",
    "dim_store",
    "dim_payment_method",
    "dim_promotion",
    "dim_product",
    "dim_employee",
    "fct_sales",
    "fct_sales_enriched",
    "employee_daily_store",
]:
    _BUILDS[_name] = lambda s, n=_name: s.fresh(n)
_BUILDS["stg_completed_items"] = lambda s: s.fresh("stg_sales_transaction_item")
_BUILDS["scd2_product"] = lambda s: s.fresh("product_history")
_BUILDS["scd2_employee"] = lambda s: s.fresh("employee_history")
_BUILDS["headcount_monthly"] = lambda s: s.fresh("fct_store_headcount_monthly")
_BUILDS["dim_date"] = lambda s: reports.sold_calendar(s.stored("fct_sales"), s.fresh("dim_date"))
_BUILDS["dim_time"] = lambda s: reports.sold_clock(s.stored("fct_sales"), s.fresh("dim_time"))


def _pit_product(s: Star, limits: Limits) -> DataFrame:
    joined = pit_join(
        s.lines(), s.stored("product_history"), "product_id", "transaction_ts", ["valid_from", "unit_cost"], limits=limits
    )
    return joined.select("transaction_id", "line_number", "product_id", "valid_from", "unit_cost")


@registered
def pit_product(s: Star) -> DataFrame:
    return _pit_product(s, s.limits)


@registered
def pit_product_merged(s: Star) -> DataFrame:
    """The same join by the path for version tables that are too large to send."""
    return _pit_product(s, replace(s.limits, versions_per_key=0))


def _history(s: Star, name: str) -> MaintainedHistory:
    key, tracked, type1 = history.HISTORIES[name]
    return MaintainedHistory(s.spark, new_folder(s.spark, f"{name}-history"), key, tracked, type1, limits=s.limits)


@registered
def scd2_maintained(s: Star) -> DataFrame:
    """The product history after three loads; the second brings rows that are older than stored ones."""
    rows, kept = staging.stage_product(s.stored("raw_product")), _history(s, "product")
    early, late = F.col("updated_at") < at(CUT), (F.col("product_id") % 3 == 0) & (F.col("updated_at") < at(LATE))
    for load, part in enumerate([early & ~late, late, ~early]):
        kept.merge(rows.filter(part), str(load))
    return kept.versions()


@registered
def headcount_incremental(s: Star) -> DataFrame:
    """The monthly snapshot after two nights; the second computes the months that new rows touch."""
    people, fact = _history(s, "employee"), nightly.fact_table(s.spark, new_folder(s.spark, "months-fact"))
    months = MonthlyHeadcount(s.spark, new_folder(s.spark, "months"), tz=s.tz)
    rows, sales = history.named_employees(staging.stage_employee(s.stored("raw_employee"))), s.stored("fct_sales")
    early, sold = F.col("updated_at") < at(datetime(2024, 1, 15)), F.col("transaction_ts") < at(CUT)
    for staff, lines, day in [(early, sold, date(2025, 3, 10)), (~early, ~sold, AS_OF)]:
        people.merge(rows.filter(staff))
        fact.upsert(sales.filter(lines), nightly.FACT_KEYS)
        months.refresh(people, fact, s.stored("dim_store"), s.stored("dim_date"), day)
    return months.read(AS_OF)


@registered
def employees_without_pii(s: Star) -> DataFrame:
    return dims.drop_pii(dims.tag_pii(s.stored("dim_employee"), "dim_employee"))


# ------------------------------------------------------------------ facts
@registered
def fct_sales_incremental(s: Star) -> DataFrame:
    """The fact loaded in two runs, the second from the watermark of the first."""
    table, raws = nightly.fact_table(s.spark, new_folder(s.spark, "incremental")), _sales_raws(s)
    for part in [{n: df.filter(F.col("updated_at") < at(CUT)) for n, df in raws.items()}, raws]:
        nightly.run_fct_sales(_fact_run(s, part, s.dims()), table)
    return table.read().drop("sale_month")


def _fact_run(s: Star, raws: dict[str, DataFrame], dimensions: dict[str, DataFrame]) -> Star:
    views = ("raw_sales_transaction", "raw_sales_transaction_item", "stg_sales_transaction")
    run = Star(s.spark, lambda n: raws[n], AS_OF, tz=s.tz, limits=s.limits, views=views)
    for name, df in dimensions.items():
        run.use(name, df)
    return run


def _sales_raws(s: Star) -> dict[str, DataFrame]:
    return {n: s.stored(f"raw_{n}") for n in ("sales_transaction", "sales_transaction_item")}


@registered
def full_refresh(s: Star) -> DataFrame:
    """A fact that was loaded up to some day, replaced as a whole."""
    table, raws = nightly.fact_table(s.spark, new_folder(s.spark, "refresh")), _sales_raws(s)
    nightly.run_fct_sales(_fact_run(s, {n: df.filter(F.col("updated_at") < at(CUT)) for n, df in raws.items()}, s.dims()), table)
    nightly.run_fct_sales(_fact_run(s, raws, s.dims()), table, mode="full")
    return table.read().drop("sale_month")


@registered
def late_rows_repaired(s: Star) -> DataFrame:
    """Sales of products that the dimension lacks wait on -2 and are repaired when the products arrive."""
    table, raws = nightly.fact_table(s.spark, new_folder(s.spark, "repair")), _sales_raws(s)
    few = s.dims() | {"dim_product": s.stored("dim_product").filter("product_id % 2 = 0 or product_id < 0")}
    nightly.run_fct_sales(_fact_run(s, raws, few), table)
    loads.repair_unknown(table, lambda: s.stored("fct_sales"))
    return table.read().drop("sale_month")


@registered
def night_committed(s: Star) -> DataFrame:
    """What readers see while a second night has loaded its fact and has not published: the first night's fact."""
    root, sales = new_folder(s.spark, "nights"), s.stored("fct_sales")
    table, published = nightly.fact_table(s.spark, root), nightly.nights(s.spark, root)
    early = F.col("source_updated_at") < at(CUT)
    table.upsert(sales.filter(early), nightly.FACT_KEYS)
    published.publish({"fct_sales": list(table.directories().values())}, "1")
    table.upsert(sales.filter(~early), nightly.FACT_KEYS)
    return published.read("fct_sales").drop("sale_month")


@registered
def materialized_table(s: Star) -> DataFrame:
    """A staging view kept as a table, bucketed by its key."""
    return materialize(s.fresh("stg_product"), "table", f"stg_product_{uuid.uuid4().hex[:8]}", bucket_by=(4, ["product_id"]))


@registered
def headcount_movements(s: Star) -> DataFrame:
    return headcount.movements(s.stored("employee_daily_store"))


@registered
def movement_counts(s: Star) -> DataFrame:
    return headcount.count_by_kind(headcount.movements(s.stored("employee_daily_store")))


@registered
def employed_by_day(s: Star) -> DataFrame:
    """Staff per day by both meanings of employed: without and with the last working day."""
    people = s.stored("employee_history").filter("is_current")
    return headcount.employed_by_day(people, dims.DATE_START, AS_OF)


@registered
def promotion_use(s: Star) -> DataFrame:
    """Lines per promotion that were sold while it was running, and outside its dates."""
    runs = s.fresh("stg_promotion").select("promotion_id", "start_date", "end_date")
    lines = s.lines().join(broadcast_if_small(runs), "promotion_id")
    running = facts.promo_active(F.col("start_date"), F.col("end_date"), local_date("transaction_ts"))
    return lines.groupBy("promotion_id", running.alias("running")).agg(F.count(F.lit(1)).alias("lines"))


@registered
def closing_recount(s: Star) -> DataFrame:
    return headcount.recount(s.stored("employee_history"), dims.DATE_START, AS_OF)


@registered
def receipt_facts(s: Star) -> DataFrame:
    return facts.receipts(s.stored("fct_sales"))


@registered
def unknown_key_rows(s: Star) -> DataFrame:
    waiting = facts.unknown_rows(s.stored("fct_sales"))
    flags = [F.count_if(F.col(f"{d}_key") == -2).alias(f"{d}_unknown") for d in suites.FACT_DIMS]
    return waiting.agg(F.count(F.lit(1)).alias("rows"), *flags)


@registered
def pinned_cost(s: Star) -> DataFrame:
    return history.wrong_pins(s.stored("fct_sales"), s.stored("dim_product")).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("bad_rows"))


@registered
def what_if_cost(s: Star) -> DataFrame:
    changed = facts.what_if_cost(s.stored("fct_sales"), Decimal("0.05"))
    margins = reports.what_if_margin(changed, "store_key")
    stores = broadcast_if_small(s.stored("dim_store").select("store_key", "store_name"))
    return margins.join(stores, "store_key").drop("store_key").withColumns({c: F.round(c, 6) for c in ["gross_margin", "new_gross_margin"]})


@registered
def promotion_coverage(s: Star) -> DataFrame:
    gaps = facts.promotion_coverage(s.fresh("stg_promotion_product"), s.fresh("stg_promotion"), s.lines())
    return gaps.groupBy("promotion_id", "full_date").agg(F.count(F.lit(1)).alias("products_without_sale"))


# ------------------------------------------------------------------ metrics and reports
def _metric(name: str) -> Build:
    sales = metrics.model_of(metrics.METRICS[name]) is metrics.SALES
    grain = "month" if sales else "quarter"
    return lambda s: metrics.query(_marts(s), [name], by=["store_name"], grain=grain)


for _name in metrics.METRICS:
    _BUILDS[f"metric_{_name}"] = _metric(_name)


@registered
def metric_closing_headcount_by_quarter(s: Star) -> DataFrame:
    return metrics.query(_marts(s), ["opening_headcount", "closing_headcount"], grain="quarter")


@registered
def metric_transaction_count_rollup(s: Star) -> DataFrame:
    """Distinct receipts from stored rollups: in total by four grains, by store and month, by category and quarter."""
    rollups = Rollups.build(s.stored("fct_sales_enriched"), limits=s.limits)
    asked = [(None, g) for g in ("day", "month", "quarter", "year")] + [("store_name", "month"), ("category_name", "quarter")]
    parts = []
    for by, grain in asked:
        found = rollups.query(["transaction_count", "quantity_sold"], [by] if by else [], grain)
        member = F.col(by) if by else F.lit(None).cast("string")
        parts.append(found.select(F.lit(grain).alias("grain"), "period", member.alias("member"), "transaction_count", "quantity_sold"))
    return quality.stack(parts)


@registered
def metric_models_valid(s: Star) -> DataFrame:
    return metrics.check_models(_marts(s))


@registered
def metric_headcount_total(s: Star) -> DataFrame:
    return metrics.query(_marts(s), ["opening_headcount", "closing_headcount", "joiners"], by=["store_name"])


@registered
def metrics_side_by_side(s: Star) -> DataFrame:
    return metrics.query(_marts(s), ["net_revenue", "closing_headcount"], by=["store_name"], grain="year")


@registered
def metric_catalog(s: Star) -> DataFrame:
    values = metrics.catalog_values(s.spark, _marts(s))
    return values.select("metric", "type", "table", "expression", F.round("value", 3).alias("value"))


for _name in [
    "revenue_by_month",
    "revenue_by_category",
    "revenue_by_store",
    "profit_by_month",
    "revenue_per_employee",
]:
    _BUILDS[f"report_{_name}"] = lambda s, n=_name: getattr(reports, n)(_marts(s))


@registered
def report_promotion_impact_top20(s: Star) -> DataFrame:
    return reports.promotion_impact(_marts(s), 20)


@registered
def report_filtered(s: Star) -> DataFrame:
    """Dashboard filters: a store and a time range."""
    where = (F.col("store_name") == "NATION_3") & F.col("full_date").between(date(2022, 1, 1), date(2023, 12, 31))
    return metrics.query(_marts(s), ["net_revenue", "transaction_count"], ["category_name"], "year", where)


@registered
def report_profit_by_cashier(s: Star) -> DataFrame:
    return reports.profit_by_cashier(s.stored("fct_sales"), s.stored("dim_employee"))


@registered
def report_receipts_by_day_part(s: Star) -> DataFrame:
    return reports.receipts_by_day_part(s.stored("fct_sales"), s.stored("dim_time"))


@registered
def reconcile_totals(s: Star) -> DataFrame:
    return reports.reconcile_totals(s.stored("fct_sales"), s.stored("fct_sales_enriched"))


@registered
def gross_profit_by_store(s: Star) -> DataFrame:
    """Flagship: history, point-in-time join and fact in one plan, summed by store."""
    sums = s.fresh("fct_sales").groupBy("store_key").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("net_amount").alias("net_revenue"), F.sum("gross_profit").alias("profit")
    )
    names = broadcast_if_small(s.stored("dim_store").select("store_key", "store_name"))
    return sums.join(names, "store_key").select("store_name", "lines", "net_revenue", "profit")


# ------------------------------------------------------------------ quality
@registered
def raw_expectations(s: Star) -> DataFrame:
    return quality.stack([suites.raw_checks(s.stored(f"raw_{t}"), t) for t in suites.RAW_RULES])


@registered
def raw_expectations_observed(s: Star) -> DataFrame:
    """The same rules measured by the appends of two loads, and by a stream, without a scan of RAW."""
    found = []
    for name in schemas.APPENDED:
        rules, path, rows = quality.Watched(name, suites.RAW_RULES[name]()), new_folder(s.spark, "watched"), s.stored(f"raw_{name}")
        if name == "employee":
            found += loads.ingest_watched(_stream(s, name), path, new_folder(s.spark, "stream-state"), rules)
            continue
        for load_id, part in enumerate([F.col("updated_at") < at(CUT), F.col("updated_at") >= at(CUT)]):
            ingest.append_raw(rules.watch(rows.filter(part).drop("_load_id")), path, load_id)
        found += rules.results()
    return quality.sum_watched(quality.watched_results(s.spark, found), min_rows=1)


@registered
def nightly_checks(s: Star) -> DataFrame:
    """Everything a night checks after its gates: marts, histories, source rules, freshness."""
    lines, headers = s.stored("stg_sales_transaction_item"), s.stored("stg_sales_transaction")
    checked = nightly.mart_checks(s, _marts(s), lines, headers)
    return checked.unionByName(nightly.source_checks(lambda n: s.stored(f"raw_{n}"), staging_relationships(s), AS_OF))


@registered
def source_rules(s: Star) -> DataFrame:
    return suites.check_source_rules({n: s.stored(f"raw_{n}") for n in schemas.RAW})


@registered
def freshness(s: Star) -> DataFrame:
    return quality.stack([quality.freshness(s.stored(f"raw_{t}"), t, NOW) for t in schemas.APPENDED])


@registered
def relationships_orphans(s: Star) -> DataFrame:
    return suites.fact_relationships(s.stored("fct_sales"), s.dims())


@registered
def staging_relationships(s: Star) -> DataFrame:
    stg = {n: s.fresh(f"stg_{n}") for n in ["store", "payment_method", "promotion"]}
    stg["sales_transaction"] = s.stored("stg_sales_transaction")
    stg["sales_transaction_item"] = s.stored("stg_sales_transaction_item")
    return suites.staging_relationships(stg)


@registered
def staging_keys(s: Star) -> DataFrame:
    return suites.staging_keys({n: s.fresh(f"stg_{n}") for n in suites.STAGING_KEYS})


@registered
def scd2_checks_product(s: Star) -> DataFrame:
    return suites.check_scd2(
        s.stored("product_history"),
        "product_history",
        "product_id",
        ["category_id", "brand_id", "unit_price", "unit_cost"],
        ["product_sku", "product_name"],
        source=s.fresh("stg_product"),
        limits=s.limits,
    )


@registered
def scd2_checks_employee(s: Star) -> DataFrame:
    type1 = ["employee_name", "salary", "address", "start_date", "end_date"]
    return suites.check_scd2(
        s.stored("employee_history"), "employee_history", "employee_id", ["store_id"], type1, gapless=True, limits=s.limits
    )


@registered
def fact_rules(s: Star) -> DataFrame:
    return suites.fact_rules(s.stored("fct_sales"))


@registered
def dim_rules(s: Star) -> DataFrame:
    return suites.dim_rules(s.dims())


@registered
def contract_nulls(s: Star) -> DataFrame:
    return suites.contract_checks(_marts(s))


@registered
def row_count_matches(s: Star) -> DataFrame:
    return suites.row_count_matches(
        s.stored("fct_sales"), s.stored("stg_sales_transaction_item"), s.stored("stg_sales_transaction")
    )


@registered
def enriched_matches(s: Star) -> DataFrame:
    return suites.enriched_matches(s.stored("fct_sales"), s.stored("fct_sales_enriched"))


@registered
def headcount_checks(s: Star) -> DataFrame:
    return suites.check_headcount(
        s.stored("fct_store_headcount_monthly"),
        s.stored("employee_history"),
        s.stored("fct_sales"),
        s.stored("dim_store"),
        s.stored("dim_date"),
        AS_OF,
    )


@registered
def revenue_differences(s: Star) -> DataFrame:
    """Store months and totals on which snapshot and fact differ, as rules."""
    snap = "fct_store_headcount_monthly"
    found = suites.revenue_differences(s.stored(snap), s.stored("fct_sales"), s.stored("dim_store"), s.stored("dim_date"))
    return quality.stack(
        [
            quality.report(snap, "revenue by store and month", found.filter("level = 'key'")),
            quality.report(snap, "revenue in total", found.filter("level = 'total'")),
        ]
    )


@registered
def status_changes(s: Star) -> DataFrame:
    return quality.report("sales_transaction", "status never changes", suites.status_changes(s.stored("raw_sales_transaction")))


@registered
def status_distribution(s: Star) -> DataFrame:
    return quality.distribution(history.dedupe_copies(s.stored("raw_sales_transaction")), "status")


@registered
def distinct_tuples(s: Star) -> DataFrame:
    return quality.distinct_tuples(s.stored("product_history"), "product_id", ["unit_price", "unit_cost"])


@registered
def unique_copies(s: Star) -> DataFrame:
    """Keys that occur more than once in RAW: boundary copies and versions."""
    return quality.unique(s.stored("raw_sales_transaction_item"), ["transaction_id", "line_number"])


@registered
def fingerprint(s: Star) -> DataFrame:
    columns = ["transaction_id", "store_id", "employee_id", "payment_method_id"]
    return quality.fingerprint(s.fresh("stg_sales_transaction"), columns)


@registered
def table_differences(s: Star) -> DataFrame:
    """Keys on which two written snapshots of the headers differ: rows missing, added and changed here and there."""
    tx = s.stored("stg_sales_transaction").select("transaction_id", "store_id", "employee_id", "transaction_ts")
    paths = [new_folder(s.spark, "differences") for _ in range(2)]
    tx.filter("transaction_id % 997 <> 5").repartitionByRange(8, "transaction_id").sortWithinPartitions("transaction_id").write.parquet(paths[0])
    changed = F.when(F.col("transaction_id").between(3000, 3100), F.col("store_id") + 1).otherwise(F.col("store_id"))
    later = tx.filter("transaction_id % 1009 <> 7").withColumn("store_id", changed)
    later.repartitionByRange(8, "transaction_id").sortWithinPartitions("transaction_id").write.parquet(paths[1])
    one, two = (s.spark.read.schema(tx.schema).parquet(p) for p in paths)
    return differences.table_differences(one, two, "transaction_id", rows=500)


@registered
def sql_surface(s: Star) -> DataFrame:
    """A small star in Spark SQL alone: receipts with their local day, keys, discount and promotion, summed by store and label."""
    create_functions(s.spark, "tb_")
    views = {"lines": s.lines(), "promotions": s.fresh("stg_promotion"), "stores": s.fresh("stg_store"), "people": s.stored("employee_history")}
    names = {k: f"sql_surface_{k}_{uuid.uuid4().hex[:8]}" for k in views}
    for k, df in views.items():
        df.createOrReplaceTempView(names[k])
    return s.spark.sql(
        f"""
        WITH people AS (SELECT employee_id, MIN(start_date) AS first_day, MAX(end_date) AS last_day FROM {names["people"]} WHERE is_current GROUP BY employee_id),
        sold AS (
          SELECT tb_surrogate_key(ARRAY(CAST(l.store_id AS STRING))) AS store_key,
                 CASE WHEN l.promotion_id IS NULL THEN tb_no_promotion_key()
                      WHEN p.promotion_id IS NULL THEN tb_unknown_key()
                      ELSE tb_surrogate_key(ARRAY(CAST(l.promotion_id AS STRING))) END AS promotion_key,
                 tb_promo_label(p.type, p.amount) AS promotion_label,
                 tb_yyyymmdd(tb_local_date(l.transaction_ts)) AS date_key,
                 tb_sells_on(e.first_day, e.last_day, tb_local_date(l.transaction_ts)) AS by_staff,
                 l.quantity, CAST(l.quantity * l.regular_price AS DECIMAL(18,2)) AS gross_amount,
                 tb_discount(l.quantity, l.regular_price, p.type, p.amount) AS discount_amount
          FROM {names["lines"]} l LEFT JOIN {names["promotions"]} p ON p.promotion_id = l.promotion_id
          LEFT JOIN people e ON e.employee_id = l.employee_id)
        SELECT s.store_name, d.store_key, d.promotion_key, d.promotion_label, MIN(d.date_key) AS first_date_key, SUM(d.quantity) AS quantity,
               COUNT_IF(d.by_staff) AS staff_lines, SUM(d.gross_amount) AS gross_amount, SUM(d.discount_amount) AS discount_amount
        FROM sold d JOIN {names["stores"]} s ON tb_surrogate_key(ARRAY(CAST(s.store_id AS STRING))) = d.store_key
        GROUP BY ALL
        """
    )


@registered
def fct_sales_bucketed(s: Star) -> DataFrame:
    """The fact from RAW headers and lines that are stored in buckets of the receipt, so that they meet where they lie."""
    return facts.fct_sales(bucketed_lines(s), s.dims(), s.tz, s.limits)


def bucketed_lines(s: Star, buckets: int = 8) -> DataFrame:
    """Headers joined to copy-free lines, both from tables bucketed and sorted by receipt."""
    tables = {}
    for name in ("sales_transaction", "sales_transaction_item"):
        label = f"bucketed_{name}_{uuid.uuid4().hex[:8]}"
        tables[name] = materialize(s.stored(f"raw_{name}"), "table", label, bucket_by=(buckets, ["transaction_id"]))
    tx = staging.stage_sales_transaction(tables["sales_transaction"])
    return facts.headers_lines(tx, history.dedupe_copies(tables["sales_transaction_item"]))


@registered
def invalid_promo_pairs(s: Star) -> DataFrame:
    return suites.invalid_promo_pairs(s.stored("stg_sales_transaction_item"), s.stored("raw_promotion_product"))


@registered
def bad_sellers(s: Star) -> DataFrame:
    people = s.stored("employee_history").filter("is_current")
    return suites.bad_sellers(s.stored("stg_sales_transaction"), people).select(
        "transaction_id", "store_id", "employee_id", "home", "sale_day"
    )


@registered
def sales_integrity(s: Star) -> DataFrame:
    return suites.check_sales(
        s.stored("stg_sales_transaction"),
        s.stored("stg_sales_transaction_item"),
        s.stored("employee_history").filter("is_current"),
        s.stored("product_history").filter("is_current"),
        s.fresh("stg_promotion"),
        s.fresh("stg_store"),
        s.fresh("stg_payment_method"),
    )


# ------------------------------------------------------------------ analyses
@registered
def rolling_median_threshold(s: Star) -> DataFrame:
    daily = s.stored("fct_sales_enriched").groupBy("store_name", "full_date").agg(F.sum("net_amount").alias("net_revenue"))
    return reports.anomaly(daily, "store_name", "full_date", "net_revenue", floor=100000)


@registered
def business_hours(s: Star) -> DataFrame:
    until = F.col("transaction_ts") + F.make_dt_interval(hours=(F.col("store_id") * 3).cast("int"))
    spans = s.stored("stg_sales_transaction").select("transaction_id", "transaction_ts", until.alias("until_ts"))
    return reports.open_intervals(spans, "transaction_ts", "until_ts", LOCAL_TZ).select(
        "transaction_id", "open_from", "open_to"
    )


@registered
def price_revision(s: Star) -> DataFrame:
    # Some brands have no new percent; their cost stays.
    pct = F.when(F.col("brand_id") % 7 != 0, (F.col("brand_id") - 13).cast("decimal(12,2)") * F.lit(Decimal("0.01")))
    priced = F.when(F.col("unit_cost") > 1000, (F.col("brand_id") - 9).cast("decimal(12,2)") * F.lit(Decimal("0.01")))
    now = history.latest_state(s.stored("raw_product"), ["id"]).select("id", "brand_id", "unit_cost", "unit_price")
    out = reports.revise_prices(now.withColumns({"cost_pct": pct, "price_pct": priced}), "cost_pct", "price_pct")
    return out.select("id", "unit_cost", "unit_price", "new_unit_cost", "new_unit_price")


@registered
def latest_transactions(s: Star) -> DataFrame:
    tx = s.stored("stg_sales_transaction").select("transaction_id", "store_id", "transaction_ts")
    return reports.latest_n(tx, "transaction_id", 50)


@registered
def pick_products(s: Star) -> DataFrame:
    return reports.pick_k(s.stored("product_history").filter("is_current").select("product_id", "unit_cost"), "product_id", 5, 7)


# ------------------------------------------------------------------ streams
def _stream(s: Star, name: str) -> DataFrame:
    s.stored(f"raw_{name}")
    return loads.read_files(s.spark, f"{s.root}/raw_{name}", schemas.RAW[name])


@registered
def stream_ingest(s: Star) -> DataFrame:
    """Files to RAW by a stream, run twice: the second run finds nothing new."""
    path, checkpoint = new_folder(s.spark, "stream-raw"), new_folder(s.spark, "stream-state")
    for _ in range(2):
        loads.ingest_stream(_stream(s, "employee"), path, checkpoint)
    return s.spark.read.schema(schemas.RAW["employee"]).parquet(path)


@registered
def stream_dedupe(s: Star) -> DataFrame:
    path, checkpoint = new_folder(s.spark, "stream-clean"), new_folder(s.spark, "stream-state")
    clean = loads.dedupe_stream(_stream(s, "employee").drop("_load_id"), ["id", "updated_at"], "updated_at", "40 days")
    loads.ingest_stream(clean, path, checkpoint)
    return s.spark.read.schema(clean.schema).parquet(path)


@registered
def stream_upsert_fact(s: Star) -> DataFrame:
    """Lines and headers arrive as two streams, the lines first, and end in the sales fact."""
    table = nightly.fact_table(s.spark, new_folder(s.spark, "stream-fact"))
    all_dims, landed = s.dims(), loads.LandedStreams(s.spark, new_folder(s.spark, "stream-landed"), "transaction_id")

    def to_fact(tables: dict[str, DataFrame]) -> DataFrame:
        tx = staging.stage_sales_transaction(tables["sales_transaction"].drop("_load_id"))
        items = history.dedupe_copies(tables["sales_transaction_item"])
        return facts.fct_sales(facts.headers_lines(tx, items), all_dims, s.tz).withColumn("sale_month", facts.sale_month())

    for name in ("sales_transaction_item", "sales_transaction"):
        state = new_folder(s.spark, "stream-state")
        landed.upsert(_stream(s, name), name, schemas.RAW, to_fact, table, nightly.FACT_KEYS, state)
    return table.read().drop("sale_month")


@registered
def stream_headers_lines(s: Star) -> DataFrame:
    """Two streams joined in state: most headers come with their lines, some later, some after the delay, some never.

    The delay spans the given history, because all of it arrives at once; a heartbeat of both streams ends the waiting.
    """
    table = SnapshotTable(s.spark, new_folder(s.spark, "stream-joined"), mark="mark")
    folders = {n: new_folder(s.spark, f"stream-{n}") for n in ("sales_transaction", "sales_transaction_item")}
    state, delay = new_folder(s.spark, "stream-state"), "20000 days"
    lines, headers = s.stored("raw_sales_transaction_item"), s.stored("raw_sales_transaction")
    turn = F.col("transaction_id") % 10

    def arrive(name: str, df: DataFrame) -> None:
        df.write.mode("append").parquet(folders[name])

    def run() -> None:
        streams = {n: loads.read_files(s.spark, folder, schemas.RAW[n]) for n, folder in folders.items()}
        joined = loads.join_lines_headers(streams["sales_transaction_item"], streams["sales_transaction"], delay)
        loads.upsert_stream(joined, table, nightly.FACT_KEYS, state, "mark")

    def heartbeat(df: DataFrame, number: int) -> DataFrame:
        late = F.lit(datetime(2200, 1, 1)).cast("timestamp_ntz")
        return df.limit(1).withColumns({"transaction_id": F.lit(number).cast("bigint"), "updated_at": late})

    arrive("sales_transaction_item", lines)
    arrive("sales_transaction", headers.filter(turn > 2))
    run()
    arrive("sales_transaction", headers.filter(turn == 2))
    run()
    arrive("sales_transaction_item", heartbeat(lines, -1))
    arrive("sales_transaction", heartbeat(headers, -2))
    run()
    arrive("sales_transaction", headers.filter(turn == 1))
    run()
    loads.repair_alone(table, s.spark.read.schema(headers.schema).parquet(folders["sales_transaction"]), nightly.FACT_KEYS)
    return table.read().drop("mark")


@registered
def stream_pit_join(s: Star) -> DataFrame:
    """Sales headers arrive as a stream and find the seller version valid at the sale."""
    table = SnapshotTable(s.spark, new_folder(s.spark, "stream-pit"))

    def joined(batch: DataFrame) -> DataFrame:
        sales = batch.filter("status = 'completed'").select("transaction_id", "employee_id", "transaction_ts")
        return loads.stream_pit_join(
            sales, lambda: s.stored("dim_employee"), "employee_id", "transaction_ts", ["employee_key"]
        )

    state = new_folder(s.spark, "stream-state")
    loads.upsert_stream(_stream(s, "sales_transaction"), table, ["transaction_id"], state, "updated_at", joined)
    return table.read()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: lambda spark, sf_dir, b=build: present(b(star(spark, sf_dir))) for name, build in _BUILDS.items()}
