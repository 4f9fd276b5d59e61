"""Stored rollups of the sales mart that answer counts of distinct receipts exactly, by bitmaps.

A receipt gets a number once: its month and its place in the month. A rollup holds, for each group of its
dimensions and its grain, sums of the additive measures and one bitmap for each bucket of receipt numbers; receipts
of a month share buckets, so a group has few of them. Bitmaps of finer groups are united by OR, so a receipt that
stands in two categories or on two lines counts once, at any coarser grain. `Rollups.query` takes the stored
rollup with the fewest rows that has the asked dimensions and a grain that nests into the asked one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.functions.columns import period
from tillbook.operators.scale import DEFAULT, Limits, numbered
from tillbook.plans.metrics import MetricError
from tillbook.session import pin, unpin

# A finer grain nests into a coarser one; a week nests into none but itself.
NESTS = {
    "day": ("day", "week", "month", "quarter", "year", None),
    "week": ("week", None),
    "month": ("month", "quarter", "year", None),
    "quarter": ("quarter", "year", None),
    "year": ("year", None),
}
SUMS = {"net_revenue": "net_amount", "gross_revenue": "gross_amount", "gross_profit": "gross_profit", "quantity_sold": "quantity"}
COUNT = "transaction_count"
MONTH_BITS = 40


@dataclass(frozen=True)
class Rollup:
    by: tuple[str, ...]
    grain: str

    @property
    def name(self) -> str:
        return "-".join([*self.by, self.grain])


# Stores by day, categories by month, and both together by quarter.
STORED = (Rollup(("store_name",), "day"), Rollup(("category_name",), "month"), Rollup(("store_name", "category_name"), "quarter"))


def receipt_numbers(wide: DataFrame, limits: Limits = DEFAULT) -> DataFrame:
    """transaction_id and a number that is dense within the month of the receipt's first day."""
    receipts = wide.groupBy("transaction_id").agg(F.min("full_date").alias("_day"))
    month = (F.year("_day") * 12 + F.month("_day")).cast("bigint")
    placed = numbered(receipts.withColumn("_month", F.coalesce(month, F.lit(0).cast("bigint"))), ["_month"], ["_day", "transaction_id"], "_n", limits)
    return placed.select("transaction_id", (F.shiftleft(F.col("_month"), MONTH_BITS) + F.col("_n").cast("bigint")).alias("receipt"))


class Rollups:
    def __init__(self, spark: SparkSession, stored: dict[Rollup, DataFrame]):
        self.spark, self.stored = spark, stored
        self.sizes = {r: df.count() for r, df in stored.items()}

    @classmethod
    def build(cls, wide: DataFrame, rollups: tuple[Rollup, ...] = STORED, limits: Limits = DEFAULT) -> Rollups:
        """Write the rollups of the enriched fact; receipts are numbered and joined to their lines once.

        Lines of a bucket lie together, so a bitmap is begun by few tasks: each begun one is shuffled at its full length.
        """
        numbers = receipt_numbers(wide, limits)
        names = sorted({c for r in rollups for c in r.by})
        lines = wide.select("transaction_id", "full_date", *names, *SUMS.values()).join(numbers, "transaction_id").drop("transaction_id")
        lines = pin(lines.withColumn("bucket", F.bitmap_bucket_number("receipt")).hint("rebalance", "bucket"), "receipt-lines")
        stored = {}
        for r in rollups:
            found = lines.groupBy(*r.by, period("full_date", r.grain).alias("period"), "bucket").agg(
                F.bitmap_construct_agg(F.bitmap_bit_position("receipt")).alias("receipts"), *[F.sum(c).alias(m) for m, c in SUMS.items()]
            )
            stored[r] = pin(found, f"rollup-{r.name}")
        unpin(lines)
        return cls(wide.sparkSession, stored)

    def choose(self, by: list[str], grain: str | None) -> Rollup:
        """The stored rollup with the fewest rows that answers; an error if none does."""
        fit = [r for r in self.stored if set(by) <= set(r.by) and grain in NESTS[r.grain]]
        if not fit:
            raise MetricError(f"no stored rollup answers {by} by {grain}")
        return min(fit, key=lambda r: (self.sizes[r], r.name))

    def query(self, metrics: list[str], by: list[str] = (), grain: str | None = None) -> DataFrame:
        """Metrics by dimensions and grain, as metrics.query gives them from the fact."""
        unknown = set(metrics) - {*SUMS, COUNT}
        if unknown:
            raise MetricError(f"rollups hold no {sorted(unknown)}")
        rows = self.stored[self.choose(list(by), grain)]
        keys = [*(["period"] if grain else []), *by]
        rows = rows.withColumn("period", period("period", grain)) if grain else rows.drop("period")
        united = rows.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("receipts").alias("receipts"), *[F.sum(m).alias(m) for m in SUMS])
        counted = F.sum(F.bitmap_count("receipts")).alias(COUNT)
        out = united.groupBy(*keys).agg(counted, *[F.sum(m).alias(m) for m in SUMS])
        return out.select(*keys, *metrics)
