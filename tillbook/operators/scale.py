"""Size checks before a broadcast, and splitting of hot keys before a window.

AQE splits skewed joins by itself but never a window: all rows of one key go to one task. The helpers
here cut a hot key into consecutive time segments, run the window per (key, segment) and hand the edge
rows from one segment to the next through a small table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from tillbook.session import pin


@dataclass(frozen=True)
class Limits:
    broadcast_rows: int = 1_000_000
    broadcast_bytes: int = 64 * 1024 * 1024
    versions_per_key: int = 256
    rows_per_task: int = 5_000_000
    max_segments: int = 100_000


DEFAULT = Limits()

# A key is cut at most at these many quantiles; binary search below takes 12 steps.
_QUANTILES = 4095
_STEPS = [2048, 1024, 512, 256, 128, 64, 32, 16, 8, 4, 2, 1]


def _width(df: DataFrame) -> Column:
    """Bytes of one row: 8 per fixed field, the real length plus 8 per text field."""
    total = F.lit(0)
    for field in df.schema.fields:
        total = total + 8
        if isinstance(field.dataType, (StringType, BinaryType)):
            total = total + F.coalesce(F.octet_length(F.col(field.name)), F.lit(0))
    return total


def fits_broadcast(
    df: DataFrame, limits: Limits = DEFAULT, per_key: tuple[list[str], int] | None = None
) -> bool:
    """Measure rows and bytes in one pass over the columns that would be sent.

    `per_key` also bounds the rows of one key: a hash join tries all of them for each probing row.
    """
    keys, most = per_key or ([], limits.broadcast_rows)
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum(_width(df)).alias("size"))
    rows, size, longest = groups.agg(F.sum("n"), F.sum("size"), F.max("n")).first()
    if not rows:
        return True
    return rows <= limits.broadcast_rows and size <= limits.broadcast_bytes and longest <= most


def broadcast_if_small(df: DataFrame, limits: Limits = DEFAULT) -> DataFrame:
    """Hint only what was measured; a larger side is left to the planner and to AQE skew join."""
    return F.broadcast(df) if fits_broadcast(df, limits) else df


# ------------------------------------------------------------------ sets of touched keys
RANGES = 64


def key_ranges(keys: DataFrame, key: str, most: int = RANGES) -> list[tuple[int, int]]:
    """At most `most` ranges that hold every value of a whole-number key, separated by its widest gaps.

    The driver sees the least and greatest key of each of 16 x `most` equal pieces of the whole range, no more.
    """
    lo, hi = keys.agg(F.min(key), F.max(key)).first()
    if lo is None:
        return []
    width = (hi - lo) // (16 * most) + 1
    piece = F.floor((F.col(key) - F.lit(lo)) / width)
    pieces = keys.groupBy(piece.alias("piece")).agg(F.min(key).alias("lo"), F.max(key).alias("hi"))
    return merge_ranges([(r["lo"], r["hi"]) for r in pieces.collect()], most)


def merge_ranges(pieces: list[tuple[int, int]], most: int) -> list[tuple[int, int]]:
    """Join neighbours until `most` ranges are left, the closest first."""
    if not pieces:
        return []
    pieces = sorted(pieces)
    gaps = sorted(range(1, len(pieces)), key=lambda i: pieces[i][0] - pieces[i - 1][1], reverse=True)
    starts = sorted([0, *gaps[: most - 1]])
    ends = [*starts[1:], len(pieces)]
    return [(pieces[a][0], pieces[b - 1][1]) for a, b in zip(starts, ends, strict=True)]


def in_ranges(key: str, ranges: list[tuple[int, int]]) -> Column:
    """A filter that Parquet evaluates on the statistics of its row groups: the whole range, then its parts."""
    if not ranges:
        return F.lit(False)
    whole = F.col(key).between(ranges[0][0], ranges[-1][1])
    if len(ranges) == 1:
        return whole
    found = F.lit(False)
    for lo, hi in ranges:
        found = found | F.col(key).between(lo, hi)
    return whole & found


# ------------------------------------------------------------------ hot keys
def hot_groups(df: DataFrame, keys: list[str], limits: Limits = DEFAULT) -> DataFrame | None:
    """(keys, pieces) for groups above the row limit, or None when no group is.

    The limit grows with the table so that the pieces of all hot groups together never exceed
    2 x max_segments, which bounds what is broadcast.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    total, largest = counts.agg(F.sum("_rows"), F.max("_rows")).first()
    if not largest:
        return None
    limit = max(limits.rows_per_task, -(-total // limits.max_segments))
    if largest <= limit:
        return None
    hot = counts.filter(F.col("_rows") > limit).withColumn("pieces", F.ceil(F.col("_rows") / limit).cast("int"))
    return pin(hot.drop("_rows"), "hot-groups")


def time_cuts(df: DataFrame, keys: list[str], at: str, limits: Limits = DEFAULT) -> DataFrame | None:
    """(keys, cuts): ascending cut points of `at`, a time or a number, that split every hot key evenly."""
    hot = hot_groups(df, keys, limits)
    if hot is None:
        return None
    marks = [i / (_QUANTILES + 1) for i in range(1, _QUANTILES + 1)]
    sketch = (
        df.select(*keys, at)
        .join(F.broadcast(hot), keys)
        .groupBy(*keys, "pieces")
        .agg(F.percentile_approx(at, marks, 50_000).alias("q"))
    )
    pieces = F.least(F.col("pieces"), F.lit(_QUANTILES + 1))
    chosen = F.transform(
        F.sequence(F.lit(1), pieces - 1),
        lambda i: F.get(F.col("q"), (F.floor(i * (_QUANTILES + 1) / pieces) - 1).cast("int")),
    )
    return pin(sketch.select(*keys, F.array_distinct(chosen).alias("_cuts")), "time-cuts")


def with_segment(df: DataFrame, cuts: DataFrame | None, keys: list[str], at: str) -> DataFrame:
    """Add _segment: 0 for ordinary keys, else the number of cuts at or before `at`.

    Without cuts the table is returned as it is: no key needs splitting.
    """
    if cuts is None:
        return df

    def advance(pos: Column, step: Column) -> Column:
        nxt = pos + step
        reached = (nxt <= F.size("_cuts")) & (F.get(F.col("_cuts"), nxt - 1) <= F.col(at))
        return F.when(reached, nxt).otherwise(pos)

    steps = F.array(*[F.lit(s) for s in _STEPS])
    segment = F.when(F.col("_cuts").isNull(), 0).otherwise(F.aggregate(steps, F.lit(0), advance))
    return df.join(F.broadcast(cuts), keys, "left").withColumn("_segment", segment).drop("_cuts")


def group_of(keys: list[str], cuts: DataFrame | None) -> list[str]:
    return list(keys) if cuts is None else [*keys, "_segment"]


def numbered(df: DataFrame, keys: list[str], order: list[str], name: str, limits: Limits = DEFAULT) -> DataFrame:
    """Add a gap-free number per key in the given order; a hot key is cut along the first order column."""
    cuts = time_cuts(df, keys, order[0], limits)
    base = with_segment(df, cuts, keys, order[0])
    inside = Window.partitionBy(*group_of(keys, cuts)).orderBy(*order)
    out = base.withColumn(name, F.row_number().over(inside))
    if cuts is None:
        return out
    sizes = base.join(F.broadcast(cuts.select(*keys)), keys, "left_semi").groupBy(*keys, "_segment").count()
    earlier = Window.partitionBy(*keys).orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, "_segment", F.sum("count").over(earlier).alias("_before"))
    out = out.join(F.broadcast(offsets), [*keys, "_segment"], "left")
    number = (F.col(name) + F.coalesce("_before", F.lit(0))).cast("bigint")
    return out.withColumn(name, number).drop("_segment", "_before")


def neighbours(
    df: DataFrame,
    keys: list[str],
    at: str,
    prev: list[str] = (),
    nxt: list[str] = (),
    cuts: DataFrame | None = None,
) -> DataFrame:
    """Add structs _prev and _next with the given columns of the rows before and after, per key.

    NULL struct = no such row. With cuts, _segment stays on the result for a further call. `cuts` comes from time_cuts on the same keys; the row next to a segment
    border is taken from the neighbouring non-empty segment of the key.
    """
    base = df if "_segment" in df.columns else with_segment(df, cuts, keys, at)
    inside = Window.partitionBy(*group_of(keys, cuts)).orderBy(at)
    out = base.withColumns(
        {
            **({"_prev": F.lag(F.struct(*prev)).over(inside)} if prev else {}),
            **({"_next": F.lead(F.struct(*nxt)).over(inside)} if nxt else {}),
        }
    )
    if cuts is None:
        return out
    edges = (
        base.join(F.broadcast(cuts.select(*keys)), keys, "left_semi")
        .groupBy(*keys, "_segment")
        .agg(
            *([F.max_by(F.struct(*prev), at).alias("_last")] if prev else []),
            *([F.min_by(F.struct(*nxt), at).alias("_first")] if nxt else []),
        )
    )
    along = Window.partitionBy(*keys).orderBy("_segment")
    carried = edges.select(
        *keys,
        "_segment",
        *([F.lag("_last").over(along).alias("_before")] if prev else []),
        *([F.lead("_first").over(along).alias("_after")] if nxt else []),
    )
    out = out.join(F.broadcast(carried), [*keys, "_segment"], "left")
    if prev:
        out = out.withColumn("_prev", F.coalesce("_prev", "_before")).drop("_before")
    if nxt:
        out = out.withColumn("_next", F.coalesce("_next", "_after")).drop("_after")
    return out
