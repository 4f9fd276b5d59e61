"""Point-in-time join: the one version of a key that is valid at an instant."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillbook.operators.scale import DEFAULT, Limits, fits_broadcast, group_of, hot_groups, time_cuts, with_segment
from tillbook.session import pin


_SPREAD = 1024


def pit_join(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    ts: str,
    take: list[str],
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    limits: Limits = DEFAULT,
) -> DataFrame:
    """Left join each fact row to the version with valid_from <= ts < valid_to; NULLs on a miss.

    A version ends where the next one of its key begins, so of overlapping versions the latest start counts and
    both paths give the same rows. A measured small table with short histories is broadcast and
    the range is a residual of the hash join: no fact shuffle. Everything else is an ordered merge of
    versions and facts, linear in both, where a quadratic key join would stall on a long history.
    """
    carried = [c for c in dict.fromkeys(take) if c not in (key, valid_from, valid_to)]
    slim = versions.select(key, valid_from, valid_to, *carried)
    if fits_broadcast(slim, limits, per_key=([key], limits.versions_per_key)):
        following = Window.partitionBy(key).orderBy(valid_from, F.struct(valid_to, *take))  # at most versions_per_key rows
        ended = F.least(valid_to, F.coalesce(F.lead(valid_from).over(following), F.col(valid_to)))
        v, f = slim.withColumn(valid_to, ended).alias("v"), facts.alias("f")
        on = (
            (F.col(f"f.{key}") == F.col(f"v.{key}"))
            & (F.col(f"f.{ts}") >= F.col(f"v.{valid_from}"))
            & (F.col(f"f.{ts}") < F.col(f"v.{valid_to}"))
        )
        return f.join(F.broadcast(v), on, "left").select("f.*", *[f"v.{c}" for c in take])
    # The merge reads its facts twice, to count busy keys and to merge; their plan runs once.
    kept = pin(facts, "pit-facts")
    out = _merge(kept, slim, key, ts, take, valid_from, valid_to, limits)
    out.merged_from = kept
    return out


def _merge(facts, slim, key, ts, take, valid_from, valid_to, limits) -> DataFrame:
    payload = F.struct(F.col(valid_to).alias("_to"), *take)
    joinable = F.col(key).isNotNull() & F.col(ts).isNotNull()

    # Long histories are cut in time, so one key's versions spread over tasks.
    cuts = time_cuts(slim, [key], valid_from, limits)
    v = slim.filter(F.col(key).isNotNull()).select(key, F.col(valid_from).alias("_at"), payload.alias("_version"))
    v = with_segment(v, cuts, [key], "_at").withColumn("_spread", F.lit(0))
    f = facts.select(key, F.col(ts).alias("_at"), F.struct(*facts.columns).alias("_fact"), joinable.alias("_joinable"))
    # Facts that can have no version run in the same pass, spread by their own hash.
    f = with_segment(f, cuts, [key], "_at")
    f = f.withColumn("_spread", F.when(F.col("_joinable"), 0).otherwise(F.pmod(F.xxhash64("_fact"), F.lit(_SPREAD)).cast("int")))

    # Facts of a busy group are salted by their own hash; the group's versions go to every salt.
    group = group_of([key], cuts)
    busy = hot_groups(f.filter("_joinable").select(*group), group, limits)
    if busy is not None:
        spread = F.coalesce("pieces", F.lit(1))
        f = f.join(F.broadcast(busy), group, "left")
        f = f.withColumn("_salt", F.pmod(F.xxhash64("_fact"), spread).cast("int")).drop("pieces")
        v = v.join(F.broadcast(busy), group, "left")
        v = v.withColumn("_salt", F.explode(F.sequence(F.lit(0), spread - 1))).drop("pieces")
        group = [*group, "_salt"]
    group = [*group, "_spread"]

    # A version at the very instant of a sale comes first: the interval start is inclusive.
    before = (
        Window.partitionBy(*group)
        .orderBy("_at", F.col("_fact").isNotNull(), "_version")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    merged = (
        f.unionByName(v, allowMissingColumns=True)
        .withColumn("_version", F.last("_version", ignorenulls=True).over(before))
        .filter(F.col("_fact").isNotNull())
    )
    if cuts is not None:
        merged = _carry_over(merged, v, cuts, key)
    live = F.col("_joinable") & (F.col("_at") < F.col("_version._to"))
    return merged.select("_fact.*", *[F.when(live, F.col(f"_version.{c}")).alias(c) for c in take])


def _carry_over(merged: DataFrame, v: DataFrame, cuts: DataFrame, key: str) -> DataFrame:
    """Facts at the head of a segment take the last version of the segments before it."""
    ends = (
        v.join(F.broadcast(cuts.select(key)), key, "left_semi")
        .groupBy(key, "_segment")
        .agg(F.max_by("_version", "_at").alias("_end"))
    )
    every = cuts.select(key, F.explode(F.sequence(F.lit(0), F.size("_cuts"))).alias("_segment"))
    earlier = Window.partitionBy(key).orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)
    carried = every.join(ends, [key, "_segment"], "left").select(
        key, "_segment", F.last("_end", ignorenulls=True).over(earlier).alias("_carried")
    )
    out = merged.join(F.broadcast(carried), [key, "_segment"], "left")
    return out.withColumn("_version", F.coalesce("_version", "_carried")).drop("_carried")
