from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import day, money, rows, ts
from tillbook.functions import columns as C
from tillbook.operators.dims import dim_date, dim_promotion, dim_time, drop_pii, pii_columns, tag_pii
from tillbook.plans import reports


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()["v"]


def lit(value, kind):
    return F.lit(value).cast(kind)


# The worked cases of the step rule.
@pytest.mark.parametrize(
    ("value", "pct", "step", "expected"),
    [(3000, "0.01", 100, 3100), (3000, "-0.01", 100, 2900), (100, "-0.01", 100, 0), (0, "-0.05", 100, 0), (50000, "0.04", 1000, 52000)],
)
def test_shift_by_pct(spark, value, pct, step, expected):
    shifted = C.shift_by_pct(lit(value, "decimal(12,2)"), lit(pct, "decimal(4,2)"), step)
    assert one(spark, shifted) == expected


def test_shift_without_a_percent_or_a_value(spark):
    money_of = lambda v: lit(v, "decimal(12,2)")
    assert one(spark, C.shift_by_pct(money_of(1234), lit(None, "decimal(4,2)"), 100)) == 1234
    assert one(spark, C.shift_by_pct(money_of(None), lit("0.05", "decimal(4,2)"), 100)) is None
    data = [(1, money(1000), money(2000), None, None), (2, money(1000), money(2000), money("0.10"), None)]
    df = spark.createDataFrame(data, "id bigint, unit_cost decimal(12,2), unit_price decimal(12,2), c decimal(4,2), p decimal(4,2)")
    assert rows(reports.revise_prices(df, "c", "p"), "id", "new_unit_cost", "new_unit_price") == [
        (1, money(1000), money(2000)),
        (2, money(1100), money(2000)),
    ]


def test_round_to_step_takes_the_even_multiple_on_ties(spark):
    assert [one(spark, C.round_to_step(lit(v, "decimal(12,2)"), 100)) for v in (150, 250, 251)] == [200, 200, 300]
    assert one(spark, C.ceil_to_step(lit("100.01", "decimal(12,2)"), 100)) == 200


def test_null_rules(spark):
    null = F.lit(None).cast("int")
    assert one(spark, C.is_distinct(null, F.lit(1))) is True
    assert one(spark, C.is_distinct(null, null)) is False
    assert one(spark, C.greatest_strict(F.lit(1), null)) is None
    assert one(spark, C.greatest_strict(F.lit(1), F.lit(2))) == 2
    assert one(spark, C.least_strict(F.lit(1), F.lit(2))) == 1
    assert one(spark, C.ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, C.ratio(F.lit(1), F.lit(4))) == 0.25


def test_local_time(spark):
    late = lit("2024-01-01 17:30:00", "timestamp_ntz")
    assert one(spark, C.local_date(late)) == day("2024-01-02")
    assert one(spark, C.hhmm(C.to_local(late))) == 30
    assert one(spark, C.local_day_end(lit("2024-01-01", "date"))) == ts("2024-01-01 17:00:00")
    assert one(spark, C.yyyymmdd(lit("2024-03-09", "date"))) == 20240309


def test_literals_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert one(spark, C.at(ts("2024-03-10 02:30:00")).cast("string")) == "2024-03-10 02:30:00"
        assert one(spark, C.seconds_between(C.at(ts("2024-03-09 23:00:00")), C.at(ts("2024-03-10 04:00:01")))) == 18001
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_month_boundaries_are_counted(spark):
    assert one(spark, C.month_starts_between(lit("2020-01-31", "date"), lit("2020-02-01", "date"))) == 1
    assert one(spark, C.month_starts_between(lit("2019-12-01", "date"), lit("2021-01-31", "date"))) == 13


def test_periods_are_dates(spark):
    d = lit("2024-05-17", "date")
    got = [one(spark, C.period(d, g)) for g in ("day", "month", "quarter", "year")]
    assert got == [day("2024-05-17"), day("2024-05-01"), day("2024-04-01"), day("2024-01-01")]


def test_last_working_day_counts_only_for_staffing(spark):
    start, end = lit("2024-01-01", "date"), lit("2024-01-10", "date")
    on = lit("2024-01-10", "date")
    assert one(spark, C.employed_on(start, end, on)) is False
    assert one(spark, C.employed_on(start, end, on, inclusive_end=True)) is True
    assert one(spark, C.employed_on(start, F.lit(None).cast("date"), on)) is True
    assert one(spark, C.employed_on(F.lit(None).cast("date"), end, on)) is False


@pytest.mark.parametrize(
    ("kind", "amount", "quantity", "price", "expected"),
    [
        ("percentage", "12.50", 3, "10.10", "3.787500"),
        ("fixed_amount", "5.00", 3, "10.00", "15.000000"),
        ("fixed_amount", "50.00", 3, "10.00", "30.000000"),
        (None, None, 3, "10.00", "0.000000"),
        ("other", "5.00", 3, "10.00", "0.000000"),
    ],
)
def test_discount(spark, kind, amount, quantity, price, expected):
    got = C.discount(F.lit(quantity), lit(price, "decimal(12,2)"), lit(kind, "string"), lit(amount, "decimal(12,2)"))
    assert one(spark, got) == money(expected)


def test_promotion_labels(spark):
    data = [(1, "percentage", money("20.00")), (2, "percentage", money("12.50")), (3, "fixed_amount", money("5000.00"))]
    stg = spark.createDataFrame(
        [(*r, day("2024-01-01"), day("2024-02-01")) for r in data],
        "promotion_id bigint, type string, amount decimal(12,2), start_date date, end_date date",
    )
    labels = {r["promotion_id"]: r["promotion_label"] for r in dim_promotion(stg).collect()}
    assert labels == {1: "20% off", 2: "12.50% off", 3: "5,000 VND off", -1: "No promotion", -2: "Unknown"}


def test_surrogate_keys_never_meet_reserved_keys(spark):
    keys = spark.range(5000).select(C.surrogate_key("id").alias("k"))
    assert keys.filter("k < 0").count() == 0
    assert keys.distinct().count() == 5000


def test_calendar_and_clock(spark):
    dates = {r["date_key"]: r for r in dim_date(spark).collect()}
    assert len(dates) == 4019 and dates[-2]["full_date"] is None and dates[-2]["day_name"] == "Unknown"
    d = dates[20240229]
    assert (d["month_name"], d["day_name"], d["day_of_week"], d["week_of_year"], d["is_weekend"]) == ("February", "Thursday", 4, 9, False)
    times = {r["time_key"]: r for r in dim_time(spark).collect()}
    assert len(times) == 1441 and times[1435]["time_of_day"] == "14:35:00"
    parts = [times[k]["day_part"] for k in (559, 600, 1159, 1200, 1759, 1800, 2159, 2200, 0)]
    assert parts == ["Night", "Morning", "Morning", "Afternoon", "Afternoon", "Evening", "Evening", "Night", "Night"]
    assert [times[k]["hour_12"] for k in (0, 30, 1200, 1300)] == [12, 12, 12, 1]
    assert [times[k]["am_pm"] for k in (1159, 1200)] == ["AM", "PM"]


def opening(spark, start, end):
    df = spark.createDataFrame([(ts(start), ts(end))], "a timestamp_ntz, b timestamp_ntz")
    return rows(reports.open_intervals(df, "a", "b", C.LOCAL_TZ), "open_from", "open_to")


def test_opening_hours(spark):
    hours = timedelta(hours=7)
    utc = lambda text: str(ts(text) - hours)
    assert opening(spark, utc("2024-01-10 20:00"), utc("2024-01-11 09:00")) == [
        (ts("2024-01-10 20:00"), ts("2024-01-10 22:00")),
        (ts("2024-01-11 07:00"), ts("2024-01-11 09:00")),
    ]
    assert opening(spark, utc("2024-01-10 22:30"), utc("2024-01-11 06:00")) == []
    assert opening(spark, utc("2024-01-10 12:00"), utc("2024-01-10 12:00")) == []


def test_revised_cost_never_passes_the_price(spark):
    df = spark.range(400).select(
        F.col("id"),
        (F.col("id") * 137 % 9000).cast("decimal(12,2)").alias("unit_cost"),
        (F.col("id") * 137 % 9000 + F.col("id") % 5 * 700).cast("decimal(12,2)").alias("unit_price"),
        (F.col("id") % 101 - 50).cast("decimal(5,2)").alias("c"),
        F.when(F.col("id") % 2 == 0, (F.col("id") % 97 - 48).cast("decimal(5,2)")).alias("p"),
    ).withColumns({"c": F.col("c") * F.lit(money("0.01")), "p": F.col("p") * F.lit(money("0.01"))})
    got = reports.revise_prices(df, "c", "p")
    assert got.filter("new_unit_cost > new_unit_price or new_unit_cost < 0 or new_unit_price < 0").count() == 0
    assert got.filter("p is not null and new_unit_price < unit_cost").count() == 0
    assert got.filter("p is null and new_unit_price != unit_price").count() == 0


def test_pii_tags_travel_and_drop(spark):
    df = spark.createDataFrame([(1, money(5), "here")], "employee_id bigint, salary decimal(12,2), address string")
    tagged = tag_pii(df, "dim_employee")
    assert [f.name for f in tagged.schema.fields if f.metadata.get("pii")] == pii_columns("dim_employee")
    assert drop_pii(tagged).columns == ["employee_id"]


def test_rolling_median_needs_a_full_window(spark):
    data = [("w", day("2024-01-01") + timedelta(days=i), float(i)) for i in range(20)]
    got = reports.anomaly(spark.createDataFrame(data, "w string, d date, v double"), "w", "d", "v", floor=1.0)
    out = {r["d"].day: r for r in got.collect()}
    assert out[14]["median_before"] is None and out[14]["is_above"] is False
    assert out[15]["median_before"] == 6.5 and out[15]["threshold"] == 13.0 and out[15]["is_above"] is True


def test_picks_are_stable(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    first, again = (rows(reports.pick_k(df.repartition(n), "k", 5, seed=7)) for n in (2, 5))
    assert first == again
    assert first != rows(reports.pick_k(df, "k", 5, seed=8))
