import pytest
from pyspark.sql import functions as F

from conftest import money, rows, ts
from tillbook.operators.history import dedupe_copies, latest_state, product_history, scd2, wrong_pins
from tillbook.operators.pit import pit_join
from tillbook.operators.scale import Limits, hot_groups, numbered, time_cuts, with_segment
from tillbook.plans.suites import check_scd2, overlaps, validity_gaps

START, END = ts("1900-01-01"), ts("9999-12-31")
# Small limits push every key down the split path.
TINY = Limits(broadcast_rows=0, versions_per_key=0, rows_per_task=5)


def changes(spark):
    data = [
        (1, money("10.00"), "a", ts("2024-01-01"), 1),
        (1, money("10.00"), "a", ts("2024-01-01"), 2),
        (1, money("12.00"), "a", ts("2024-01-05"), 2),
        (1, money("12.00"), "b", ts("2024-01-07"), 3),
        (1, money("10.00"), "b", ts("2024-01-09"), 4),
        (2, None, "x", ts("2024-01-01"), 1),
        (2, money("5.00"), "x", ts("2024-01-03"), 2),
    ]
    return spark.createDataFrame(
        data, "id bigint, price decimal(12,2), name string, updated_at timestamp_ntz, _load_id bigint"
    )


EXPECTED = [
    (1, money("10.00"), "b", START, ts("2024-01-05"), False),
    (1, money("12.00"), "b", ts("2024-01-05"), ts("2024-01-09"), False),
    (1, money("10.00"), "b", ts("2024-01-09"), END, True),
    (2, None, "x", START, ts("2024-01-03"), False),
    (2, money("5.00"), "x", ts("2024-01-03"), END, True),
]
COLUMNS = ["id", "price", "name", "valid_from", "valid_to", "is_current"]


def versions(spark, limits=Limits()):
    return scd2(dedupe_copies(changes(spark)), "id", "updated_at", ["price"], ["name"], limits)


def test_versions_follow_the_worked_case(spark):
    assert rows(versions(spark), *COLUMNS) == sorted(EXPECTED, key=repr)


def test_copies_collapse_and_versions_stay(spark):
    assert dedupe_copies(changes(spark)).count() == 6


def test_latest_state_takes_the_newest_row(spark):
    got = latest_state(changes(spark), ["id"]).select("id", "price", "name")
    assert rows(got) == [(1, money("10.00"), "b"), (2, money("5.00"), "x")]


def hot_changes(spark, n=3000):
    """One key holds a third of all rows; prices repeat, so many rows are no change points."""
    rows_ = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).alias("product_id"),
        (F.floor(F.col("id") / 7) % 5).cast("decimal(12,2)").alias("unit_price"),
        F.when(F.col("id") % 11 < 5, None).otherwise(F.col("id") % 2).cast("bigint").alias("brand_id"),
        F.concat(F.lit("name "), F.col("id").cast("string")).alias("product_name"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id") * F.col("id"))).alias(
            "updated_at"
        ),
    )
    return rows_


def test_a_hot_key_is_cut_into_even_segments(spark):
    df = hot_changes(spark)
    limits = Limits(rows_per_task=100)
    cuts = time_cuts(df, ["product_id"], "updated_at", limits)
    segments = with_segment(df, cuts, ["product_id"], "updated_at").filter("product_id = 0")
    sizes = [r["count"] for r in segments.groupBy("_segment").count().collect()]
    assert sum(sizes) == df.filter("product_id = 0").count()
    assert len(sizes) >= 10 and max(sizes) <= 200


def test_split_history_equals_the_plain_one(spark):
    df = hot_changes(spark)
    plain = scd2(df, "product_id", "updated_at", ["unit_price", "brand_id"], ["product_name"])
    for per_task in (5, 200):
        split = scd2(
            df, "product_id", "updated_at", ["unit_price", "brand_id"], ["product_name"], Limits(rows_per_task=per_task)
        )
        assert rows(split) == rows(plain)


def test_numbers_of_a_cut_key_have_no_gap(spark):
    df = hot_changes(spark).select("product_id", "updated_at", F.xxhash64("product_name").alias("v"))
    df = df.withColumn("bucket", F.pmod("v", F.lit(60)))
    plain, split = (
        numbered(df, ["product_id"], ["bucket", "updated_at"], "n", limits).withColumn("n", F.col("n").cast("bigint"))
        for limits in (Limits(), Limits(rows_per_task=50))
    )
    assert rows(split) == rows(plain)


def test_segment_without_change_points_is_bridged(spark):
    same = spark.range(200).select(
        F.lit(1).alias("k"),
        F.when(F.col("id").isin(0, 190), F.col("id")).otherwise(F.lit(0)).alias("v"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(days=F.col("id").cast("int"))).alias("t"),
    )
    plain, split = (scd2(same, "k", "t", ["v"], [], limits) for limits in (Limits(), TINY))
    assert rows(split) == rows(plain)
    assert split.count() == 3


def sales(spark):
    cases = [
        (1, 1, ts("2024-01-05 00:00:00")),
        (2, 1, ts("2024-01-04 23:59:59.999999")),
        (3, 99, ts("2024-01-05")),
        (4, None, ts("2024-01-05")),
        (5, 1, None),
        (6, 1, ts("2030-01-01")),
        (7, 2, ts("2024-01-02")),
    ]
    return spark.createDataFrame(cases, "sale bigint, id bigint, sold_at timestamp_ntz")


def test_point_in_time_boundaries_on_both_paths(spark):
    expected = [
        (1, ts("2024-01-05"), money("12.00")),
        (2, START, money("10.00")),
        (3, None, None),
        (4, None, None),
        (5, None, None),
        (6, ts("2024-01-09"), money("10.00")),
        (7, START, None),
    ]
    for limits in (Limits(), Limits(versions_per_key=1), TINY):
        got = pit_join(sales(spark), versions(spark), "id", "sold_at", ["valid_from", "price"], limits=limits)
        assert rows(got, "sale", "valid_from", "price") == sorted(expected, key=repr)


def test_point_in_time_join_of_hot_keys_equals_the_broadcast_one(spark):
    history = scd2(hot_changes(spark), "product_id", "updated_at", ["unit_price"], ["product_name"])
    # A third of the sales are of one product, and many of them at the same instant.
    facts = spark.range(4000).select(
        F.col("id").alias("sale"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 45).alias("product_id"),
        F.when(F.col("id") % 5 == 0, F.lit("2024-01-20").cast("timestamp_ntz"))
        .otherwise(F.lit("2023-12-30").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id") * 2500))
        .alias("sold_at"),
    )
    take = ["valid_from", "unit_price"]
    plain = rows(pit_join(facts, history, "product_id", "sold_at", take, limits=Limits(versions_per_key=10_000)))
    assert len(plain) == 4000
    for limits in (
        Limits(versions_per_key=1),
        Limits(versions_per_key=1, rows_per_task=7),
    ):
        assert rows(pit_join(facts, history, "product_id", "sold_at", take, limits=limits)) == plain


def test_gaps_between_versions_give_no_match(spark):
    gapped = spark.createDataFrame(
        [(1, ts("2024-01-01"), ts("2024-01-02"), 7), (1, ts("2024-01-05"), ts("2024-01-06"), 8)],
        "id bigint, valid_from timestamp_ntz, valid_to timestamp_ntz, v int",
    )
    sale = spark.createDataFrame([(1, ts("2024-01-03")), (1, ts("2024-01-05"))], "id bigint, sold_at timestamp_ntz")
    for limits in (Limits(), TINY):
        got = pit_join(sale, gapped, "id", "sold_at", ["v"], limits=limits)
        assert rows(got, "sold_at", "v") == [(ts("2024-01-03"), None), (ts("2024-01-05"), 8)]


def test_pieces_of_hot_groups_are_bounded(spark):
    df = spark.range(10_000).select((F.col("id") % 100).alias("k"))
    limits = Limits(rows_per_task=1, max_segments=50)
    # 100 rows per key, limit raised to 10000 / 50 = 200: nothing is split.
    assert hot_groups(df, ["k"], limits) is None
    pieces = hot_groups(df.withColumn("k", F.col("k") % 10), ["k"], limits)
    assert pieces.agg(F.sum("pieces")).first()[0] <= 2 * limits.max_segments


def by_rule(df):
    return {r["rule"]: r["bad_rows"] for r in df.collect()}


def history_checks(history, source=None, limits=Limits()):
    return by_rule(check_scd2(history, "h", "id", ["price"], ["name"], source, gapless=True, limits=limits))


def test_history_checks_pass_on_built_history(spark):
    source = changes(spark)
    for limits in (Limits(), Limits(rows_per_task=1)):
        assert set(history_checks(versions(spark), source, limits).values()) == {0}


def test_history_checks_see_broken_history(spark):
    good = versions(spark)
    broken = good.withColumn("valid_to", F.when(F.col("is_current"), F.col("valid_to")).otherwise(F.col("valid_to") + F.expr("interval 1 day")))
    assert history_checks(broken)["no overlap"] == 3
    assert history_checks(broken)["no gap"] == 3
    assert history_checks(good.withColumn("is_current", F.lit(False)))["single current"] == 2
    assert history_checks(good.withColumn("is_current", F.lit(False)))["open end means current"] == 2
    assert history_checks(good.filter("valid_from > timestamp_ntz'1900-01-01 00:00:00'"))["first version from 1900"] == 2
    assert history_checks(good.withColumn("price", F.lit(1)))["no identical adjacent"] == 3
    assert history_checks(good.withColumn("valid_to", F.col("valid_from")))["valid range"] == 5
    assert history_checks(good.withColumn("name", F.col("valid_from").cast("string")))["type 1 consistent"] == 2
    assert history_checks(good.union(good))["unique version"] == 5
    assert history_checks(good.filter("id = 1"), changes(spark))["complete"] == 1


def test_overlaps_and_gaps(spark):
    good = versions(spark)
    later = F.expr("valid_to + interval 1 day")
    broken = good.withColumn("valid_to", F.when(F.col("is_current"), F.col("valid_to")).otherwise(later))
    earlier = good.withColumn("valid_to", F.when(F.col("is_current"), F.col("valid_to")).otherwise(F.expr("valid_to - interval 1 hour")))
    for limits in (Limits(), Limits(rows_per_task=1)):
        assert overlaps(good, "id", limits).isEmpty() and validity_gaps(good, "id", limits).isEmpty()
        assert overlaps(broken, "id", limits).count() == 3
        assert overlaps(earlier, "id", limits).isEmpty() and validity_gaps(earlier, "id", limits).count() == 3


def test_product_history_tracks_every_column(spark):
    base = (1, "SKU", 5, 6, "n", money(9), money(4), ts("2020-01-01"))
    def row(i, **kw):
        names = ["product_id", "product_sku", "category_id", "brand_id", "product_name", "unit_price", "unit_cost", "created_at"]
        values = dict(zip(names, base)) | kw
        return (*[values[n] for n in names], ts(f"2024-01-0{i}"))
    data = [row(1), row(2, category_id=50), row(3, category_id=50, brand_id=60), row(4, category_id=50, brand_id=60, unit_price=money(8)),
            row(5, category_id=50, brand_id=60, unit_price=money(8), unit_cost=money(3)),
            row(6, category_id=50, brand_id=60, unit_price=money(8), unit_cost=money(3), product_sku="NEW")]
    df = spark.createDataFrame(
        data,
        "product_id bigint, product_sku string, category_id bigint, brand_id bigint, product_name string, "
        "unit_price decimal(12,2), unit_cost decimal(12,2), created_at timestamp_ntz, updated_at timestamp_ntz",
    )
    got = product_history(df)
    assert got.count() == 5
    assert {r["product_sku"] for r in got.collect()} == {"NEW"}


@pytest.mark.parametrize("per_key", [256, 0])
def test_overlapping_versions_give_one_row_on_both_paths(spark, per_key):
    """The latest start counts; after its end the earlier version does not come back."""
    data = [
        (1, ts("2024-01-01"), ts("2024-01-10"), "long"),
        (1, ts("2024-01-05"), ts("2024-01-07"), "inner"),
        (2, ts("2024-01-01"), ts("2024-01-03"), "tie a"),
        (2, ts("2024-01-01"), ts("2024-01-09"), "tie b"),
        (None, ts("2024-01-01"), ts("2024-01-09"), "no key"),
    ]
    versions = spark.createDataFrame(data, "id bigint, valid_from timestamp_ntz, valid_to timestamp_ntz, v string")
    when = [(1, "2024-01-02"), (1, "2024-01-05"), (1, "2024-01-08"), (2, "2024-01-02"), (2, "2024-01-05"), (3, "2024-01-02"), (None, "2024-01-02")]
    sale = spark.createDataFrame([(i, ts(t)) for i, t in when] + [(1, None)], "id bigint, at timestamp_ntz")
    got = rows(pit_join(sale, versions, "id", "at", ["v"], limits=Limits(versions_per_key=per_key)), "id", "at", "v")
    expected = ["long", "inner", None, "tie b", "tie b", None, None, None]
    assert got == sorted(((i, t, v) for (i, t), v in zip([(i, ts(t)) for i, t in when] + [(1, None)], expected)), key=repr)


def test_wrong_pins(spark):
    fct = spark.createDataFrame([(1, money(5)), (2, money(6)), (-2, None)], "product_key bigint, unit_cost decimal(12,2)")
    dim = spark.createDataFrame([(1, money(5)), (2, money(7)), (-2, None)], "product_key bigint, unit_cost decimal(12,2)")
    assert rows(wrong_pins(fct, dim), "product_key") == [(2,)]


