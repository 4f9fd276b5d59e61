"""The layers from RAW to marts, each written once to the shared folder and read back by the next.

Writing a layer ends its lineage: a lost executor costs a task of one layer, and a mart never recomputes
staging. `fresh(name)` is the layer's own DataFrame over its stored inputs, `stored(name)` the table.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from tillbook import schemas
from tillbook.functions.columns import LOCAL_TZ
from tillbook.operators import dims, facts, headcount, history, staging
from tillbook.operators.quality import assert_shape
from tillbook.operators.scale import DEFAULT, Limits
from tillbook.session import new_folder, passing, pin, store, tidy


class Star:
    def __init__(
        self,
        spark: SparkSession,
        raw: Callable[[str], DataFrame],
        as_of: date,
        root: str | None = None,
        tz: str = LOCAL_TZ,
        limits: Limits = DEFAULT,
        views: tuple[str, ...] = (),
    ):
        """`raw(name)` gives a RAW table; `as_of` is the last report day, fixed once per run.

        Layers named in `views` are not written: filters of a later layer reach their sources.
        """
        tidy(spark)
        self.views = views
        self.spark, self.raw, self.as_of, self.tz, self.limits = spark, raw, as_of, tz, limits
        self.root = root or new_folder(spark, "star")
        self._tables: dict[str, DataFrame] = {}

    def fresh(self, name: str) -> DataFrame:
        if name.startswith("raw_"):
            return self.raw(name.removeprefix("raw_"))
        df = _LAYERS[name](self)
        if name in schemas.MART:
            assert_shape(df, schemas.MART[name], name)
        return df

    def stored(self, name: str) -> DataFrame:
        if name in self.views:
            return self.fresh(name)
        if name not in self._tables:
            with passing(self.spark):
                df, path = self.fresh(name), f"{self.root}/{name}"
                if name == "fct_sales":
                    # Pinned, so that the shuffles of the joins are gone before the rebalance writes its own.
                    df = pin(df.withColumn("sale_month", facts.sale_month()), "fact-rows")
                    store(df.hint("rebalance", "sale_month"), path, ("sale_month",))
                else:
                    store(df, path)
            self._tables[name] = self.spark.read.schema(df.schema).parquet(path)
        return self._tables[name]

    def held(self, name: str) -> DataFrame:
        """A layer where it is written already, else its own DataFrame: for layers that are cheaper to compute than to keep."""
        return self._tables[name] if name in self._tables else self.fresh(name)

    def use(self, name: str, df: DataFrame) -> None:
        """Take a layer that was written elsewhere, such as the incrementally loaded fact."""
        self._tables[name] = df

    def dims(self) -> dict[str, DataFrame]:
        return {n: self.stored(n) for n in schemas.MART if n.startswith("dim_")}

    def lines(self) -> DataFrame:
        """Headers joined to copy-free lines. The join itself drops lines of other headers.

        Lines are dealt out by receipt once, which serves both the removal of copies and the join.
        """
        items = history.dedupe_copies(self.stored("raw_sales_transaction_item").repartition("transaction_id"))
        return facts.headers_lines(self.stored("stg_sales_transaction"), items)

    def build(self, without: tuple[str, ...] = ()) -> None:
        """Write every layer but `without`. Layers of one level need only the levels before, so they run side by side."""
        dimensions = [n for n in schemas.MART if n.startswith("dim_")]
        levels = [
            [f"raw_{n}" for n in schemas.RAW],
            ["stg_sales_transaction", "product_history", "employee_history"],
            [*dimensions, "employee_daily_store"],
            ["fct_sales"],
            ["fct_sales_enriched", "fct_store_headcount_monthly"],
        ]
        with ThreadPoolExecutor(4) as pool:
            for level in levels:
                list(pool.map(self.stored, [n for n in level if n not in without]))


def _replaced(name: str):
    return lambda s: staging.stage_replaced(s.stored(f"raw_{name}"), name)


def _stg_item(s: Star) -> DataFrame:
    return staging.stage_sales_transaction_item(
        s.stored("raw_sales_transaction_item"), s.stored("stg_sales_transaction")
    )


_LAYERS: dict[str, Callable[[Star], DataFrame]] = {
    **{f"stg_{n}": _replaced(n) for n in schemas.REPLACED},
    "stg_product": lambda s: staging.stage_product(s.stored("raw_product")),
    "stg_employee": lambda s: staging.stage_employee(s.stored("raw_employee")),
    "stg_sales_transaction": lambda s: staging.stage_sales_transaction(s.stored("raw_sales_transaction")),
    "stg_sales_transaction_item": _stg_item,
    "product_history": lambda s: history.product_history(
        s.fresh("stg_product"), s.limits, s.stored("raw_product").withColumnRenamed("id", "product_id")
    ),
    "employee_history": lambda s: history.employee_history(
        s.fresh("stg_employee"), s.limits, s.stored("raw_employee").withColumnRenamed("id", "employee_id")
    ),
    "employee_daily_store": lambda s: headcount.daily_state(
        s.stored("employee_history"), dims.DATE_START, s.as_of, s.tz
    ),
    "dim_store": lambda s: dims.dim_store(s.fresh("stg_store")),
    "dim_payment_method": lambda s: dims.dim_payment_method(s.fresh("stg_payment_method")),
    "dim_promotion": lambda s: dims.dim_promotion(s.fresh("stg_promotion")),
    "dim_product": lambda s: dims.dim_product(
        s.stored("product_history"), s.fresh("stg_category"), s.fresh("stg_brand")
    ),
    "dim_employee": lambda s: dims.dim_employee(s.stored("employee_history")),
    "dim_date": lambda s: dims.dim_date(s.spark),
    "dim_time": lambda s: dims.dim_time(s.spark),
    "fct_sales": lambda s: facts.fct_sales(s.lines(), s.dims(), s.tz, s.limits),
    "fct_sales_enriched": lambda s: facts.enrich(s.stored("fct_sales"), s.dims(), s.limits),
    "fct_store_headcount_monthly": lambda s: headcount.headcount_monthly(
        s.held("employee_daily_store"), s.stored("dim_store"), s.stored("fct_sales"), s.stored("dim_date"), s.as_of
    ),
}
