"""Staging: rename, prune, remove copies, keep completed sales."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.operators.history import dedupe_copies
from tillbook.sources.tables import select_renamed

# The columns staging keeps and their names.
KEPT = {
    "store": {
        "id": "store_id",
        "store_name": "store_name",
        "address": "address",
        "phone_number": "phone_number",
        "created_at": "created_at",
        "updated_at": "updated_at",
    },
    "category": {"id": "category_id", "category_name": "category_name"},
    "brand": {"id": "brand_id", "brand_name": "brand_name"},
    "payment_method": {"id": "payment_method_id", "method": "method"},
    "promotion": {
        "id": "promotion_id",
        "type": "type",
        "amount": "amount",
        "start_date": "start_date",
        "end_date": "end_date",
    },
    "promotion_product": {"product_id": "product_id", "promotion_id": "promotion_id"},
}


def stage_replaced(raw: DataFrame, name: str) -> DataFrame:
    """A table that is reloaded whole has no copies: a projection is enough."""
    return select_renamed(raw, KEPT[name])


def stage_product(raw: DataFrame) -> DataFrame:
    return dedupe_copies(raw).withColumnRenamed("id", "product_id")


def stage_employee(raw: DataFrame) -> DataFrame:
    return dedupe_copies(raw).withColumnRenamed("id", "employee_id")


def only_completed(tx: DataFrame) -> DataFrame:
    return tx.filter(F.col("status") == "completed").drop("status")


def stage_sales_transaction(raw: DataFrame) -> DataFrame:
    return dedupe_copies(only_completed(raw))


def lines_of(items: DataFrame, tx: DataFrame) -> DataFrame:
    """Lines whose header is in `tx`."""
    return items.join(tx.select("transaction_id"), "transaction_id", "left_semi")


def stage_sales_transaction_item(raw: DataFrame, stg_tx: DataFrame) -> DataFrame:
    return dedupe_copies(lines_of(raw, stg_tx))
