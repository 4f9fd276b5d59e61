"""Metric layer: definitions that compile to one groupBy().agg() per semantic model."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.functions.columns import period, ratio
from tillbook.operators.quality import check_rows, not_null, report, stack, unique

SEMI_ADDITIVE_WARNING = "A level, not a flow: added up over stores; over a longer period the edge month alone is counted."


@dataclass(frozen=True)
class Measure:
    name: str
    agg: str = "sum"
    expr: str | None = None
    # (time dimension, "max" or "min"): over a period only its last or first month counts.
    non_additive: tuple[str, str] | None = None

    @property
    def column(self) -> str:
        return self.expr or self.name


@dataclass(frozen=True)
class SemanticModel:
    name: str
    table: str
    entity: tuple[str, ...]
    time: str
    dimensions: tuple[str, ...]
    measures: dict[str, Measure]


@dataclass(frozen=True)
class Metric:
    name: str
    label: str
    description: str
    kind: str = field(init=False, default="")


@dataclass(frozen=True)
class Simple(Metric):
    measure: str
    kind = "simple"


@dataclass(frozen=True)
class Ratio(Metric):
    numerator: str
    denominator: str
    kind = "ratio"


@dataclass(frozen=True)
class Derived(Metric):
    """SQL expression over other metrics by name."""

    expr: str
    inputs: tuple[str, ...]
    kind = "derived"


def _measures(*items: Measure) -> dict[str, Measure]:
    return {m.name: m for m in items}


# The semantic models and metrics.
SALES = SemanticModel(
    "sales",
    "fct_sales_enriched",
    ("transaction_id", "line_number"),
    "full_date",
    ("store_name", "product_name", "category_name", "brand_name", "promotion_label", "payment_method_name"),
    _measures(
        Measure("net_amount"),
        Measure("gross_amount"),
        Measure("discount_amount"),
        Measure("gross_profit"),
        Measure("quantity"),
        Measure("transactions", "count_distinct", "transaction_id"),
    ),
)
HEADCOUNT = SemanticModel(
    "store_headcount",
    "fct_store_headcount_monthly",
    ("store_id", "month_start"),
    "month_start",
    ("store_name", "is_month_closed"),
    _measures(
        Measure("closing_headcount", non_additive=("month_start", "max")),
        Measure("opening_headcount", non_additive=("month_start", "min")),
        Measure("employee_months", expr="average_headcount"),
        Measure("store_net_revenue", expr="net_revenue"),
        Measure("joiners"),
        Measure("leavers"),
    ),
)
MODELS = (SALES, HEADCOUNT)

METRICS: dict[str, Metric] = {
    m.name: m
    for m in (
        Simple("net_revenue", "Net revenue", "Revenue after promotion discounts and coupons.", "net_amount"),
        Simple("gross_revenue", "Gross revenue", "Revenue at regular price, before discounts.", "gross_amount"),
        Simple("discount_amount", "Promotion discount", "Promotion discount, without coupons.", "discount_amount"),
        Simple("gross_profit", "Gross profit", "Net revenue minus the cost valid at the sale.", "gross_profit"),
        Simple("quantity_sold", "Quantity sold", "Units sold.", "quantity"),
        Simple("transaction_count", "Transactions", "Distinct receipts, not lines.", "transactions"),
        Ratio("gross_margin", "Gross margin", "Profit over net revenue, sums first.", "gross_profit", "net_revenue"),
        Derived(
            "average_basket_value",
            "Average basket value",
            "Net revenue per receipt.",
            "net_revenue / nullif(transaction_count, 0)",
            ("net_revenue", "transaction_count"),
        ),
        Simple("closing_headcount", "Closing headcount", "Staff at the end of the period.", "closing_headcount"),
        Simple("opening_headcount", "Opening headcount", "Staff at the start of the period.", "opening_headcount"),
        Simple("employee_months", "Employee-months", "Average headcount summed over store-months.", "employee_months"),
        Simple("store_net_revenue", "Net revenue (snapshot)", "Net revenue by store and month.", "store_net_revenue"),
        Simple("joiners", "Joiners", "Staff who started in the period.", "joiners"),
        Simple("leavers", "Leavers", "Staff who left in the period.", "leavers"),
        Ratio(
            "revenue_per_employee",
            "Revenue per employee per month",
            "Net revenue over employee-months, sums first.",
            "store_net_revenue",
            "employee_months",
        ),
    )
}


class MetricError(ValueError):
    """A metric definition or request that cannot be answered."""


def base_metrics(metric: Metric) -> list[Simple]:
    """The simple metrics a metric is computed from."""
    if isinstance(metric, Simple):
        return [metric]
    names = (metric.numerator, metric.denominator) if isinstance(metric, Ratio) else metric.inputs
    return [b for n in names for b in base_metrics(METRICS[n])]


def model_of(metric: Metric) -> SemanticModel:
    owners = {m.name: m for b in base_metrics(metric) for m in MODELS if b.measure in m.measures}
    if len(owners) != 1:
        raise MetricError(f"{metric.name} must read one semantic model, not {sorted(owners)}")
    return next(iter(owners.values()))


def validate_metric(metric: Metric) -> None:
    if not metric.label or not metric.description:
        raise MetricError(f"{metric.name} needs a label and a description")
    model = model_of(metric)
    if not isinstance(metric, Simple):
        for b in base_metrics(metric):
            if model.measures[b.measure].non_additive:
                raise MetricError(f"{metric.name} builds on the semi-additive measure {b.measure}")


def validate_model(model: SemanticModel, df: DataFrame) -> None:
    """Every column a model names must exist on its table."""
    used = {*model.entity, model.time, *model.dimensions, *(m.column for m in model.measures.values())}
    missing = used - set(df.columns)
    if missing:
        raise MetricError(f"{model.name} uses unknown columns: {sorted(missing)}")


def check_models(tables: dict[str, DataFrame]) -> DataFrame:
    """Validation of models and metrics on their tables: definitions raise, rows are counted.

    (table, rule, severity, bad_rows): entities are unique, time and dimensions are filled.
    """
    for m in METRICS.values():
        validate_metric(m)
    parts = []
    for model in MODELS:
        df = tables[model.table]
        validate_model(model, df)
        parts.append(check_rows(df, model.table, [not_null(c) for c in (*model.entity, model.time, *model.dimensions)]))
        parts.append(report(model.table, "unique entity", unique(df, list(model.entity))))
    return stack(parts)


def query(
    tables: dict[str, DataFrame],
    metrics: list[str],
    by: list[str] = (),
    grain: str | None = None,
    where: Column | str | None = None,
    order: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Metrics by dimensions and time grain. `period` holds the time; one aggregate pass per model."""
    wanted = [METRICS[m] for m in metrics]
    for m in wanted:
        validate_metric(m)
    keys = [*(["period"] if grain else []), *by]
    results = []
    for model in MODELS:
        mine = [m for m in wanted if model_of(m) is model]
        if mine:
            results.append(_query_model(tables[model.table], model, mine, list(by), grain, where))
    out = results[0] if len(results) == 1 else _side_by_side(results, keys, metrics)
    out = out.select(*keys, *metrics)
    if order:
        ties = [F.col(k).asc_nulls_last() for k in keys]
        out = out.orderBy(F.col(order).desc_nulls_last(), *ties)
    return out.limit(limit) if limit else out


def _query_model(df, model, metrics, by, grain, where) -> DataFrame:
    unknown = set(by) - set(model.dimensions)
    if unknown:
        raise MetricError(f"{model.name} has no dimension {sorted(unknown)}")
    validate_model(model, df)
    if where is not None:
        df = df.filter(where)
    keys = list(by)
    if grain:
        df = df.withColumn("period", period(model.time, grain))
        keys = ["period", *keys]
    base = {b.name: model.measures[b.measure] for m in metrics for b in base_metrics(m)}
    df = _with_edges(df, base, grain)
    sums = df.groupBy(*keys).agg(*[_aggregate(m).alias(name) for name, m in base.items()])
    outer = {}
    for m in metrics:
        if isinstance(m, Ratio):
            outer[m.name] = ratio(F.col(m.numerator), F.col(m.denominator))
        elif isinstance(m, Derived):
            outer[m.name] = F.expr(_spell(m.expr, {n: f"CAST({n} AS DOUBLE)" for n in m.inputs}))
    return sums.withColumns(outer) if outer else sums


def _with_edges(df: DataFrame, base: dict[str, Measure], grain: str | None) -> DataFrame:
    """Add the first and last month of each period, over all stores, for semi-additive measures."""
    windows = {m.non_additive for m in base.values() if m.non_additive}
    if not windows:
        return df
    picks = {f"_{w}_{time}": (F.max if w == "max" else F.min)(time) for time, w in sorted(windows)}
    if grain:
        # One row per period of the calendar.
        edges = df.groupBy("period").agg(*[v.alias(k) for k, v in picks.items()])
        return df.join(F.broadcast(edges), "period")
    return df.withColumns({k: df.agg(v).scalar() for k, v in picks.items()})


def _aggregate(m: Measure) -> Column:
    value = F.col(m.column)
    if m.agg == "count_distinct":
        return F.count_distinct(value)
    if m.non_additive:
        time, w = m.non_additive
        value = F.when(F.col(time) == F.col(f"_{w}_{time}"), value)
    return F.sum(value)


def _side_by_side(results: list[DataFrame], keys: list[str], metrics: list[str]) -> DataFrame:
    """Full outer merge on the group keys: stack, then keep the one value each metric has."""
    stacked = results[0]
    for r in results[1:]:
        stacked = stacked.unionByName(r, allowMissingColumns=True)
    return stacked.groupBy(*keys).agg(*[F.max(m).alias(m) for m in metrics])


def expression(metric: Metric) -> str:
    """SQL text of a metric on its own table."""
    model = model_of(metric)
    if isinstance(metric, Simple):
        m = model.measures[metric.measure]
        return f"COUNT(DISTINCT {m.column})" if m.agg == "count_distinct" else f"{m.agg.upper()}({m.column})"
    if isinstance(metric, Ratio):
        top, bottom = (expression(METRICS[n]) for n in (metric.numerator, metric.denominator))
        return f"CAST({top} AS DOUBLE) / CAST(NULLIF({bottom}, 0) AS DOUBLE)"
    return _spell(metric.expr, {n: expression(METRICS[n]) for n in metric.inputs}).replace("nullif", "NULLIF")


def _spell(text: str, names: dict[str, str]) -> str:
    """Replace whole metric names in an expression."""
    return re.sub("|".join(rf"\b{n}\b" for n in names), lambda m: names[m.group(0)], text)


def catalog(spark: SparkSession) -> DataFrame:
    """One row per metric."""
    rows = []
    for m in METRICS.values():
        model = model_of(m)
        semi = any(model.measures[b.measure].non_additive for b in base_metrics(m))
        warning = SEMI_ADDITIVE_WARNING if semi else None
        rows.append((m.name, m.label, m.kind, model.table, expression(m), m.description, warning))
    return spark.createDataFrame(
        rows,
        "metric string, label string, type string, table string, expression string, description string, "
        "warning string",
    )


def catalog_values(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """Catalog with the current total of each metric."""
    names = list(METRICS)
    totals = query(tables, names)
    pairs = F.array(
        *[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names]
    )
    return catalog(spark).join(F.broadcast(totals.select(F.inline(pairs))), "metric")
