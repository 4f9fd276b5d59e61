"""History and snapshot that are kept up to date instead of rebuilt."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tillbook.operators import headcount, history, staging
from tillbook.operators.scale import Limits
from tillbook.plans import nightly
from tillbook.plans.months import MonthlyHeadcount, months_between, runs_of
from tillbook.session import new_folder
from tillbook.sources.histories import MaintainedHistory
from tillbook.sources.snapshots import WriterConflict

SCHEMA = "k bigint, updated_at timestamp_ntz, v string, name string, extra int"
START = datetime(2024, 1, 1)


def changes(spark, data):
    return spark.createDataFrame([(k, START + timedelta(hours=h), v, name, 0) for k, h, v, name in data], SCHEMA)


def kept_history(spark, **more):
    return MaintainedHistory(spark, new_folder(spark, "history"), "k", ["v"], ["name"], buckets=4, **more)


def same(a, b) -> bool:
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("limits", [Limits(), Limits(rows_per_task=20, broadcast_rows=0)])
@pytest.mark.parametrize("seed", [1, 2])
def test_loads_in_any_order_equal_a_rebuild(spark, seed, limits):
    rng = random.Random(seed)
    data = [(rng.choice([1, 1, 1, 2, 3, 4, 5, 6, 7]), h, rng.choice("ab"), rng.choice("xyz")) for h in range(120)]
    data.append((8, 1, None, None))
    rng.shuffle(data)
    held = kept_history(spark, limits=limits)
    for at_row in range(0, len(data), 40):
        held.merge(changes(spark, data[max(0, at_row - 5) : at_row + 40]))  # some rows come again
    whole = history.scd2(changes(spark, data), "k", "updated_at", ["v"], ["name"])
    assert rows(held.versions(), *whole.columns) == rows(whole)


def test_a_late_row_splits_its_version(spark):
    held = kept_history(spark)
    held.merge(changes(spark, [(1, 0, "a", "n"), (1, 8, "a", "n"), (1, 20, "b", "n")]))
    assert held.versions().count() == 2
    held.merge(changes(spark, [(1, 4, "c", "old name")]))
    assert [r[2] for r in sorted(rows(held.versions(), "valid_from", "name", "v"))] == ["a", "c", "a", "b"]
    assert {r[0] for r in rows(held.versions(), "name")} == {"n"}, "the latest name stays on every version"


def test_rows_of_other_keys_are_copied_where_they_lie(spark):
    held = kept_history(spark)
    held.merge(changes(spark, [(k, 0, "a", "n") for k in range(40)]))
    before = held.table.directories()
    stored, keys = held.table.read(), changes(spark, [(1, 0, "", "")]).select("k")
    plan = held.kept(stored, keys)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan and "BroadcastHashJoin" in plan
    held.merge(changes(spark, [(1, 5, "b", "n")]))
    after = held.table.directories()
    assert sum(before[s] != after[s] for s in before) == 1, "slices without a changed key keep their files"
    assert held.versions().count() == 41


def test_ties_and_repeated_batches_change_nothing(spark):
    held = kept_history(spark)
    assert held.merge(changes(spark, [(1, 0, "a", "n")]), "b1")
    assert not held.merge(changes(spark, [(1, 9, "z", "n")]), "b1")
    assert not held.merge(changes(spark, []), "b2")
    with pytest.raises(ValueError, match="repeat"):
        held.merge(changes(spark, [(1, 0, "b", "n")]))
    assert rows(held.versions(), "k", "v") == [(1, "a")]


def test_a_merge_on_an_old_state_fails(spark, monkeypatch):
    path_of, other = kept_history(spark), None
    path_of.merge(changes(spark, [(1, 0, "a", "n")]))
    other = MaintainedHistory(spark, path_of.table.path, "k", ["v"], ["name"], buckets=4)
    rewrite = path_of.table.rewrite

    def late(*args, **named):
        other.merge(changes(spark, [(1, 3, "c", "n")]))
        rewrite(*args, **named)

    monkeypatch.setattr(path_of.table, "rewrite", late)
    with pytest.raises(WriterConflict):
        path_of.merge(changes(spark, [(1, 2, "b", "n")]))
    assert sorted(r[0] for r in rows(other.versions(), "v")) == ["a", "c"]


def test_only_differing_keys_are_named(spark):
    held = kept_history(spark)
    held.merge(changes(spark, [(k, 0, "a", "n") for k in range(20)]))
    since = held.table.version()
    held.merge(changes(spark, [(3, 5, "a", "n"), (4, 5, "b", "n"), (30, 0, "a", "n")]))
    before, after = held.differing(since)
    assert {r[0] for r in rows(after, "k")} == {4, 30} and {r[0] for r in rows(before, "k")} == {4}
    assert held.differing(held.table.version()) is None


# ------------------------------------------------------------------ months
def test_runs():
    d = date.fromisoformat
    assert months_between(d("2023-12-15"), d("2024-02-01")) == [d("2023-12-01"), d("2024-01-01"), d("2024-02-01")]
    assert runs_of([d("2024-01-01"), d("2023-12-01"), d("2024-03-01")]) == [(d("2023-12-01"), d("2024-01-01")), (d("2024-03-01"),) * 2]
    assert runs_of([]) == []


@pytest.fixture(scope="module")
def night(star, spark):
    """History, fact and snapshot up to an early day."""
    key, tracked, type1 = history.HISTORIES["employee"]
    people = MaintainedHistory(spark, new_folder(spark, "people"), key, tracked, type1, buckets=8)
    fact = nightly.fact_table(spark, new_folder(spark, "fact"))
    months = MonthlyHeadcount(spark, new_folder(spark, "months"))
    staff = history.named_employees(staging.stage_employee(star.stored("raw_employee")))
    people.merge(staff.filter("employee_id % 10 <> 7"))
    fact.replace(star.stored("fct_sales").filter("transaction_id % 100 <> 1"))
    first = months.refresh(people, fact, star.stored("dim_store"), star.stored("dim_date"), date(2026, 5, 20))
    assert first == months_between(date(2020, 1, 1), date(2026, 5, 20))
    return people, fact, months, staff


def expected(star, people, fact, as_of):
    daily = headcount.daily_state(people.versions(), date(2020, 1, 1), as_of)
    return headcount.headcount_monthly(daily, star.stored("dim_store"), fact.read(), star.stored("dim_date"), as_of)


def test_closed_months_keep_their_files(star, spark, night):
    people, fact, months, staff = night
    first_day = date(2026, 5, 20)
    assert same(months.read(first_day), expected(star, people, fact, first_day))

    # one old sale that came late, and one employee whose history begins in January 2024
    late = star.stored("fct_sales").filter("transaction_id % 100 = 1").orderBy("transaction_ts", "line_number").limit(1)
    fact.upsert(late, nightly.FACT_KEYS)
    sold = late.select(F.floor(F.col("date_key") / 100).cast("string")).first()[0]
    one = staff.filter("employee_id % 10 = 7").select(F.min("employee_id")).first()[0]
    people.merge(staff.filter(F.col("employee_id") == one).withColumn("end_date", F.lit(date(2024, 2, 20))))
    before = months.table.directories()
    as_of = date(2026, 7, 2)
    dirty = months.refresh(people, fact, star.stored("dim_store"), star.stored("dim_date"), as_of)
    after = months.table.directories()
    rewritten = {s for s in after if before.get(s) != after[s]}
    assert rewritten == {f"{m:%Y%m%d}" for m in dirty}
    assert {f"{sold}01", "20260501", "20260601", "20260701"} <= rewritten
    others = rewritten - {f"{sold}01", "20260501", "20260601", "20260701"}
    assert others <= {"20231201", "20240101", "20240201", "20240301"}, "months in which that employee worked"
    assert same(months.read(as_of), expected(star, people, fact, as_of))
    assert months.refresh(people, fact, star.stored("dim_store"), star.stored("dim_date"), as_of) == [date(2026, 7, 1)]


def test_a_new_store_touches_every_month(star, spark, night):
    people, fact, months, _ = night
    stores = star.stored("dim_store")
    more = stores.unionByName(stores.filter("store_id = 1").withColumns({"store_id": F.lit(991).cast("long"), "store_key": F.lit(991).cast("long")}))
    day = date(2026, 7, 3)
    assert months.refresh(people, fact, more, star.stored("dim_date"), day) == months_between(date(2020, 1, 1), day)
    assert months.read(day).filter("store_id = 991").count() == len(months_between(date(2020, 1, 1), day))
