"""Where two snapshots of a table differ, without joining them.

Both sides are summed to a digest per range of the key. Only ranges whose digests differ are split and read again,
down to ranges of few rows, and only the rows of those meet in a join. A digest is a count and two sums of row
hashes, which no exchange of rows between ranges leaves alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillbook.functions.columns import is_distinct
from tillbook.operators.scale import RANGES, in_ranges, merge_ranges
from tillbook.session import pin

SPLIT = 256
ROWS = 50_000


def unequal_rows(one: DataFrame, two: DataFrame) -> DataFrame:
    """Distinct rows that one table holds more often than the other; each side is computed once."""
    sides = one.withColumn("_side", F.lit(1)).unionByName(two.withColumn("_side", F.lit(-1)))
    return sides.groupBy(*one.columns).agg(F.sum("_side").alias("_side")).filter("_side <> 0").drop("_side")


def row_hashes(columns: list[str]) -> tuple[Column, Column]:
    """Two hashes of a row; NULLs are told apart by position."""
    marks = [F.col(c).isNull() for c in columns]
    return F.xxhash64(*columns, *marks), F.xxhash64(*marks, *reversed(columns))


def range_digests(df: DataFrame, key: str, columns: list[str], lo: int, width: int) -> DataFrame:
    """piece, n, a, b: count and sums of row hashes of each piece of the key range; partial sums combine map-side."""
    a, b = (F.sum(h.cast("decimal(38,0)")) for h in row_hashes(columns))
    piece = F.floor((F.col(key) - F.lit(lo)) / F.lit(width)).alias("piece")
    return df.groupBy(piece).agg(F.count(F.lit(1)).alias("n"), a.alias("a"), b.alias("b"))


def differing_ranges(one: DataFrame, two: DataFrame, key: str, columns: list[str], rows: int = ROWS) -> list[tuple[int, int]]:
    """Key ranges that hold all differing rows; each holds at most `rows` rows of a side, or a single key."""
    ends = one.select(key).unionAll(two.select(key)).agg(F.min(key), F.max(key)).first()
    if ends[0] is None:
        return []
    open_, found = [(int(ends[0]), int(ends[1]))], []
    while open_:
        later = []
        for lo, hi in open_:
            width = (hi - lo) // SPLIT + 1
            sides = [range_digests(df.filter(F.col(key).between(lo, hi)), key, columns, lo, width) for df in (one, two)]
            left, right = (side.select("piece", *[F.col(c).alias(f"{c}{i}") for c in ("n", "a", "b")]) for i, side in enumerate(sides))
            unlike = is_distinct("n0", "n1") | is_distinct("a0", "a1") | is_distinct("b0", "b1")
            # At most SPLIT rows come back for a range.
            for r in left.join(right, "piece", "full").filter(unlike).collect():
                part = (lo + r["piece"] * width, min(hi, lo + (r["piece"] + 1) * width - 1))
                small = max(r["n0"] or 0, r["n1"] or 0) <= rows or part[0] == part[1]
                (found if small else later).append(part)
        open_ = later
    return merge_ranges(found, RANGES) if len(found) > RANGES else sorted(found)


def table_differences(one: DataFrame, two: DataFrame, key: str, more_keys: list[str] = (), rows: int = ROWS) -> DataFrame:
    """key columns and difference ('only first', 'only second', 'changed') of every key that differs.

    Keys must be unique in both; the first key is a whole number. Rows with a NULL in it are left out.
    """
    keys = [key, *more_keys]
    rest = [c for c in one.columns if c not in keys]
    ranges = differing_ranges(one, two, key, [*keys, *rest], rows)
    near = in_ranges(key, ranges)
    left, right = (df.filter(near).select(*keys, F.struct(*[F.col(c) for c in rest]).alias(f"_row{i}")) for i, df in enumerate((one, two)))
    kind = (
        F.when(F.col("_row1").isNull(), "only first")
        .when(F.col("_row0").isNull(), "only second")
        .when(is_distinct("_row0", "_row1"), "changed")
    )
    return left.join(right, keys, "full").select(*keys, kind.alias("difference")).filter("difference is not null")
