from datetime import date, timedelta

from pyspark.sql import functions as F

from conftest import day, money, rows, ts
from tillbook.operators.headcount import daily_state, headcount_monthly, movements, recount
from tillbook.plans import metrics
from tillbook.plans.suites import check_headcount, revenue_differences

OPEN, CLOSE = "1900-01-01", "9999-12-31"
# The worked case of end-of-day states.
HISTORY = [
    (1, 1, "2020-02-01", None, OPEN, CLOSE),
    (2, 1, "2019-05-01", "2020-02-01", OPEN, CLOSE),
    (3, 1, "2019-05-01", None, OPEN, "2020-02-01 16:30:00"),
    (3, 2, "2019-05-01", None, "2020-02-01 16:30:00", CLOSE),
    (4, 1, "2019-05-01", None, OPEN, "2020-02-01 17:30:00"),
    (4, 2, "2019-05-01", None, "2020-02-01 17:30:00", CLOSE),
    (5, 1, "2019-05-01", "2020-01-31", OPEN, "2020-02-01 05:00:00"),
    (5, 2, "2019-05-01", "2020-01-31", "2020-02-01 05:00:00", CLOSE),
    (6, 1, "2020-02-01", None, OPEN, "2020-02-01 03:00:00"),
    (6, 2, "2020-02-01", None, "2020-02-01 03:00:00", CLOSE),
]
# Fixed values: (employee, day, employed at its end, store) of the worked case.
STATES = [
    (1, "2020-01-31", False, 1),
    (1, "2020-02-01", True, 1),
    (1, "2020-02-02", True, 1),
    (2, "2020-01-31", True, 1),
    (2, "2020-02-01", False, 1),
    (2, "2020-02-02", False, 1),
    (3, "2020-01-31", True, 1),
    (3, "2020-02-01", True, 2),
    (3, "2020-02-02", True, 2),
    (4, "2020-01-31", True, 1),
    (4, "2020-02-01", True, 1),
    (4, "2020-02-02", True, 2),
    (5, "2020-01-31", False, 1),
    (5, "2020-02-01", False, 2),
    (5, "2020-02-02", False, 2),
    (6, "2020-01-31", False, 1),
    (6, "2020-02-01", True, 2),
    (6, "2020-02-02", True, 2),
]
DAYS = [date(2020, 1, 31), date(2020, 2, 1), date(2020, 2, 2)]


def history(spark):
    data = [(e, s, day(a), day(b) if b else None, ts(f), ts(t)) for e, s, a, b, f, t in HISTORY]
    return spark.createDataFrame(
        data,
        "employee_id bigint, store_id bigint, start_date date, end_date date, valid_from timestamp_ntz, valid_to timestamp_ntz",
    )


def test_state_at_the_end_of_each_local_day(spark):
    got = daily_state(history(spark), date(2020, 2, 1), date(2020, 2, 2))
    held = {(e, day(d)): (employed, store) for e, d, employed, store in STATES}
    expected = [(e, d, *state, *held.get((e, d - timedelta(days=1)), (None, None))) for (e, d), state in held.items()]
    assert rows(got) == sorted(expected, key=repr)


def test_a_version_that_starts_at_local_midnight_holds_the_day_before(spark):
    # 17:00 UTC is local midnight; the day that ends at that instant sees the new version.
    data = [
        (1, 1, day("2019-01-01"), None, ts(OPEN), ts("2020-02-01 17:00:00")),
        (1, 2, day("2019-01-01"), None, ts("2020-02-01 17:00:00"), ts(CLOSE)),
    ]
    got = daily_state(spark.createDataFrame(data, history(spark).schema), date(2020, 2, 1), date(2020, 2, 2))
    assert rows(got, "calendar_date", "store_id") == [(DAYS[0], 1), (DAYS[1], 2), (DAYS[2], 2)]


def test_days_equal_the_join_of_employees_days_and_versions(spark, star):
    """The per-version day ranges against a plain range join, on all employees of the folder."""
    hist, as_of = star.stored("employee_history"), star.as_of
    got = star.stored("employee_daily_store").select("employee_id", "calendar_date", "store_id")
    days = spark.range((as_of - date(2020, 1, 1)).days + 2).select(
        F.date_add(F.lit("2019-12-31").cast("date"), F.col("id").cast("int")).alias("calendar_date")
    )
    end = F.date_add("calendar_date", 1).cast("timestamp_ntz") - F.expr("interval 7 hours")
    brute = hist.join(F.broadcast(days), (end >= F.col("valid_from")) & (end < F.col("valid_to")))
    brute = brute.select("employee_id", "calendar_date", "store_id")
    assert got.exceptAll(brute).count() == 0 and brute.exceptAll(got).count() == 0


def snapshot_inputs(spark):
    data = [
        (1, "2019-12-31", True, 1, None, None),
        (3, "2019-12-31", True, 1, None, None),
        (2, "2020-01-05", True, 2, False, 2),
        (3, "2020-01-20", False, 1, True, 1),
        (1, "2020-01-31", True, 1, True, 1),
        (2, "2020-01-31", True, 2, True, 2),
        (1, "2020-02-10", True, 2, True, 1),
        (1, "2020-02-15", True, 2, True, 2),
        (2, "2020-02-15", True, 2, True, 2),
    ]
    daily = spark.createDataFrame(
        [(e, day(d), *rest) for e, d, *rest in data],
        "employee_id bigint, calendar_date date, is_employed boolean, store_id bigint, prev_is_employed boolean, prev_store_id bigint",
    )
    stores = spark.createDataFrame(
        [(101, 1, "Store 1"), (102, 2, "Store 2"), (103, 3, "Store 3"), (-2, -2, "Unknown")],
        "store_key bigint, store_id bigint, store_name string",
    )
    fct = spark.createDataFrame(
        [(101, 20200115, money("100.00")), (102, 20200210, money("30.00")), (102, 20200214, money("20.00"))],
        "store_key bigint, date_key int, net_amount decimal(20,6)",
    )
    dates = spark.createDataFrame(
        [(20200115, day("2020-01-15")), (20200210, day("2020-02-10")), (20200214, day("2020-02-14"))],
        "date_key int, full_date date",
    )
    return daily, stores, fct, dates


def snapshot(spark):
    daily, stores, fct, dates = snapshot_inputs(spark)
    return headcount_monthly(daily, stores, fct, dates, date(2020, 2, 15), date(2020, 1, 1))


def test_monthly_snapshot_worked_case(spark):
    jan, feb = day("2020-01-01"), day("2020-02-01")
    expected = [
        (1, jan, 2, 1, 0, 1, 0, 0, 1.5, 100.0, True),
        (2, jan, 0, 1, 1, 0, 0, 0, 0.5, 0.0, True),
        (3, jan, 0, 0, 0, 0, 0, 0, 0.0, 0.0, True),
        (1, feb, 1, 0, 0, 0, 0, 1, 0.5, 0.0, False),
        (2, feb, 1, 2, 0, 0, 1, 0, 1.5, 50.0, False),
        (3, feb, 0, 0, 0, 0, 0, 0, 0.0, 0.0, False),
    ]
    got = snapshot(spark).select(
        "store_id", "month_start", "opening_headcount", "closing_headcount", "joiners", "leavers", "transfers_in",
        "transfers_out", F.col("average_headcount").cast("double"), F.col("net_revenue").cast("double"), "is_month_closed",
    )
    assert rows(got) == sorted(expected, key=repr)
    assert {r["as_of_date"] for r in snapshot(spark).collect()} == {date(2020, 2, 15)}


def test_metrics_on_the_worked_case(spark):
    t = {"fct_store_headcount_monthly": snapshot(spark), "fct_sales_enriched": None}
    by_month = metrics.query(t, ["revenue_per_employee"], by=["store_name"], grain="month")
    got = {(r["store_name"], r["period"].month): r["revenue_per_employee"] for r in by_month.collect()}
    assert got[("Store 2", 2)] == 50 / 1.5
    assert got[("Store 3", 1)] is None
    total = metrics.query(t, ["revenue_per_employee", "closing_headcount", "opening_headcount"], by=["store_name"])
    per_store = {r["store_name"]: r for r in total.collect()}
    assert per_store["Store 2"]["revenue_per_employee"] == 25.0
    assert per_store["Store 2"]["closing_headcount"] == 2
    assert per_store["Store 1"]["opening_headcount"] == 2
    quarter = metrics.query(t, ["closing_headcount", "opening_headcount"], grain="quarter").collect()
    assert [(r["closing_headcount"], r["opening_headcount"]) for r in quarter] == [(2, 2)]


def test_first_day_is_no_movement(spark):
    daily, *_ = snapshot_inputs(spark)
    got = rows(movements(daily), "employee_id", "store_id", "movement")
    assert got == [(1, 1, "transfer_out"), (1, 2, "transfer_in"), (2, 2, "joiner"), (3, 1, "leaver")]


def test_recount_from_history_matches_the_daily_table(spark, star):
    snap = star.stored("fct_store_headcount_monthly")
    counted = recount(star.stored("employee_history"), date(2020, 1, 1), star.as_of)
    closing = snap.filter("closing_headcount > 0").select("store_id", "month_start", "closing_headcount")
    assert rows(closing) == rows(counted)


def broken_rules(star, snap):
    checks = check_headcount(
        snap, star.stored("employee_history"), star.stored("fct_sales"), star.stored("dim_store"), star.stored("dim_date"), star.as_of
    )
    return {r["rule"] for r in checks.collect() if r["bad_rows"]}


def test_headcount_checks_pass_and_fail(star):
    snap = star.stored("fct_store_headcount_monthly")
    assert broken_rules(star, snap) == set()
    assert "complete" in broken_rules(star, snap.filter("month_start != date'2021-05-01'"))
    assert "closed flag" in broken_rules(star, snap.withColumn("is_month_closed", F.lit(True)))
    assert "closing = history" in broken_rules(star, snap.withColumn("closing_headcount", F.col("closing_headcount") + 1))
    more = snap.withColumn("closing_headcount", F.col("closing_headcount") + 1)
    assert {"closing = opening + flows", "opening = previous closing"} <= broken_rules(star, more)
    assert "revenue = fct_sales" in broken_rules(star, snap.withColumn("net_revenue", F.col("net_revenue") + 1))


def test_revenue_differences_see_both_directions(spark):
    daily, stores, fct, dates = snapshot_inputs(spark)
    assert revenue_differences(snapshot(spark), fct, stores, dates).count() == 0
    lost = snapshot(spark).filter("store_id != 1")
    levels = [r["level"] for r in revenue_differences(lost, fct, stores, dates).collect()]
    assert sorted(levels) == ["key", "total"]
