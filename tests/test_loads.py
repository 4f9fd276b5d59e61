

import pytest
from pyspark.sql import functions as F

from conftest import day, money, rows, ts
from tillbook import schemas
from tillbook.functions import columns as C
from tillbook.operators import facts, history
from tillbook.operators.quality import ContractError, QualityError, stack
from tillbook.plans import nightly, suites
from tillbook.plans.star import Star
from tillbook.session import new_folder
from tillbook.sources import ingest
from tillbook.sources.snapshots import SnapshotTable, StaleChange, WriterConflict, apply_changes
from tillbook.sources.tables import materialize, read_table, spine
from tillbook.streaming import loads

FACT_COLUMNS = schemas.MART["fct_sales"].names


def same(a, b) -> bool:
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def items(spark, data):
    return spark.createDataFrame(
        [(i, v, ts(t)) for i, v, t in data], "id bigint, v int, updated_at timestamp_ntz"
    )


def test_cursor_keeps_the_boundary_and_moves_on(spark):
    src = items(spark, [(1, 1, "2024-01-01"), (2, 1, "2024-01-02"), (3, 1, "2024-01-03")])
    everything, last = ingest.extract_incremental(src, "updated_at", None)
    assert everything.count() == 3 and last == ts("2024-01-03")
    later, last = ingest.extract_incremental(src, "updated_at", ts("2024-01-02"))
    assert rows(later, "id") == [(2,), (3,)] and last == ts("2024-01-03")
    nothing, last = ingest.extract_incremental(src, "updated_at", ts("2025-01-01"))
    assert nothing.isEmpty() and last == ts("2025-01-01")


def test_cursor_filter_reaches_the_scan(spark):
    src = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = ingest.extract_incremental(src, "ts", ts("2024-01-15"))[0]._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2024-01-15T00:00)]" in plan


def test_boundary_rows_are_dropped_but_never_merged(spark):
    raw = items(spark, [(1, 1, "2024-01-01"), (2, 1, "2024-01-02")])
    again = items(spark, [(2, 1, "2024-01-02"), (3, 1, "2024-01-02"), (2, 9, "2024-01-03")])
    kept = ingest.drop_boundary(again, raw, ["id"], "updated_at", ts("2024-01-02"))
    assert rows(kept, "id", "v") == [(2, 9), (3, 1)]


def employee(spark, ids, updated):
    row = lambda i: (i, 1, "F", "L", day("1990-01-01"), None, None, day("2020-01-01"), None, money(1), ts(updated), ts(updated))
    return spark.createDataFrame([row(i) for i in ids], schemas.SOURCE["employee"])


def test_a_repeated_load_changes_nothing(spark):
    path, schema = new_folder(spark, "t"), schemas.RAW["employee"]
    first, second = employee(spark, [1, 2], "2024-01-01"), employee(spark, [1, 2], "2024-01-01").union(employee(spark, [1], "2024-01-02"))
    ingest.load_appended(first, path, schema, ["id"], 1)
    for _ in range(2):
        ingest.load_appended(second, path, schema, ["id"], 2)
    got = rows(ingest.read_raw(spark, path, schema), "id", "updated_at", "_load_id")
    assert got == [(1, ts("2024-01-01"), 1), (1, ts("2024-01-02"), 2), (2, ts("2024-01-01"), 1)]


@pytest.mark.parametrize("repeated", [1, 2])
def test_a_repeated_load_never_loses_a_version(spark, repeated):
    """Loads 1 and 2, then one of them again after the source moved on and forgot its old rows."""
    path, schema = new_folder(spark, "t"), schemas.RAW["employee"]
    nights = [
        (1, employee(spark, [1, 2], "2024-01-01")),
        (2, employee(spark, [1], "2024-01-02")),
        (repeated, employee(spark, [3], "2024-01-03")),
        (3, employee(spark, [3], "2024-01-03").union(employee(spark, [4], "2024-01-04"))),
    ]
    for load_id, source in nights:
        ingest.load_appended(source, path, schema, ["id"], load_id)
    got = rows(ingest.read_raw(spark, path, schema), "id", "updated_at")
    assert got == [(1, ts("2024-01-01")), (1, ts("2024-01-02")), (2, ts("2024-01-01")), (3, ts("2024-01-03")), (4, ts("2024-01-04"))]


def test_a_failed_replace_leaves_the_old_table(spark):
    path = new_folder(spark, "t")
    ingest.replace_table(keyed(spark, [(1, 1, "a")]), path)
    with pytest.raises(Exception, match="no"):
        ingest.replace_table(keyed(spark, [(2, 1, "b")]).withColumn("v", F.raise_error(F.lit("no")).cast("string")), path)
    assert rows(spark.read.parquet(path)) == [(1, 1, "a")]
    ingest.replace_table(keyed(spark, [(3, 1, "c")]), path)
    assert rows(spark.read.parquet(path)) == [(3, 1, "c")]


def keyed(spark, data):
    return spark.createDataFrame(data, "k bigint, month int, v string")


def test_upsert_moves_rows_between_slices_and_drops_empty_ones(spark):
    table = SnapshotTable(spark, new_folder(spark, "t"), slice_by="month")
    table.upsert(keyed(spark, [(1, 1, "a"), (2, 2, "b"), (3, 3, "c")]), ["k"])
    before = table.directories()
    table.upsert(keyed(spark, [(2, 3, "moved"), (4, 4, "new")]), ["k"])
    assert rows(table.read()) == [(1, 1, "a"), (2, 3, "moved"), (3, 3, "c"), (4, 4, "new")]
    after = table.directories()
    assert after["1"] == before["1"], "an untouched slice keeps its files"
    assert set(after) == {"1", "3", "4"}


def test_watermark_comes_from_live_slices(spark):
    schema = "k bigint, month int, changed timestamp_ntz"
    table = SnapshotTable(spark, new_folder(spark, "t"), slice_by="month", mark="changed")
    assert table.high_water() is None
    table.upsert(spark.createDataFrame([(1, 1, ts("2024-01-01")), (2, 2, ts("2024-01-09"))], schema), ["k"])
    assert table.high_water() == ts("2024-01-09") == ingest.high_water(table.read(), "changed")
    # The newest row moves to another slice; its old slice is gone and counts no more.
    table.upsert(spark.createDataFrame([(2, 1, ts("2024-01-10"))], schema), ["k"])
    assert table.high_water() == ts("2024-01-10") == ingest.high_water(table.read(), "changed")
    assert set(table.directories()) == {"1"}


def test_a_stored_row_with_a_later_mark_stays(spark):
    schema = "k bigint, v string, changed timestamp_ntz"
    table = SnapshotTable(spark, new_folder(spark, "t"), mark="changed")
    table.upsert(spark.createDataFrame([(1, "new", ts("2024-01-09")), (2, "a", ts("2024-01-01"))], schema), ["k"])
    late = [(1, "old", ts("2024-01-05")), (2, "b", ts("2024-01-01")), (3, "c", ts("2023-01-01"))]
    table.upsert(spark.createDataFrame(late, schema), ["k"])
    assert rows(table.read(), "k", "v") == [(1, "new"), (2, "b"), (3, "c")]
    table.upsert(spark.createDataFrame([(1, "unmarked", None)], schema), ["k"])
    assert rows(table.read(), "k", "v") == [(1, "new"), (2, "b"), (3, "c")]


def test_of_two_writers_the_second_fails(spark):
    path = new_folder(spark, "t")
    one, two = SnapshotTable(spark, path), SnapshotTable(spark, path)
    one.replace(keyed(spark, [(1, 1, "a")]))
    version = two._next()
    one.upsert(keyed(spark, [(2, 1, "b")]), ["k"])
    with pytest.raises(WriterConflict):
        two._write(keyed(spark, [(3, 1, "c")]), version, None, [])
    assert rows(two.read()) == [(1, 1, "a"), (2, 1, "b")]
    two.upsert(keyed(spark, [(3, 1, "c")]), ["k"])
    assert rows(one.read()) == [(1, 1, "a"), (2, 1, "b"), (3, 1, "c")]


def test_no_write_is_lost_between_two_writers(spark, monkeypatch):
    """B begins while A has written its rows but not its log file; only one of them may succeed on that version."""
    path = new_folder(spark, "t")
    one, two = SnapshotTable(spark, path), SnapshotTable(spark, path)
    one.replace(keyed(spark, [(1, 1, "first")]))
    commit = one._commit

    def late(version, rows_):
        two.upsert(keyed(spark, [(2, 1, "b")]), ["k"])
        commit(version, rows_)

    monkeypatch.setattr(one, "_commit", late)
    with pytest.raises(WriterConflict):
        one.upsert(keyed(spark, [(3, 1, "a")]), ["k"])
    assert rows(two.read()) == [(1, 1, "first"), (2, 1, "b")]
    monkeypatch.setattr(one, "_commit", commit)
    one.upsert(keyed(spark, [(3, 1, "a")]), ["k"])  # after the conflict the table is free for the next write
    assert rows(two.read()) == [(1, 1, "first"), (2, 1, "b"), (3, 1, "a")]


def test_a_writer_lost_before_its_commit_blocks_nobody(spark, monkeypatch):
    table = SnapshotTable(spark, new_folder(spark, "t"))
    table.replace(keyed(spark, [(1, 1, "a")]))
    lost = SnapshotTable(spark, table.path)
    monkeypatch.setattr(lost, "_commit", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        lost.upsert(keyed(spark, [(2, 1, "b")]), ["k"])
    table.upsert(keyed(spark, [(3, 1, "c")]), ["k"])
    assert rows(table.read()) == [(1, 1, "a"), (3, 1, "c")] and table.version() == 2


def test_full_refresh_checks_its_keys(spark):
    table = SnapshotTable(spark, new_folder(spark, "t"))
    with pytest.raises(ValueError, match="repeat"):
        table.replace(keyed(spark, [(1, 1, "a"), (1, 1, "b")]), keys=["k"])
    assert not table.exists()


def test_a_batch_is_applied_once_and_reruns_add_nothing(spark):
    table = SnapshotTable(spark, new_folder(spark, "t"))
    table.upsert(keyed(spark, [(1, 1, "a")]), ["k"], batch="b1")
    table.upsert(keyed(spark, [(1, 1, "other")]), ["k"], batch="b1")
    assert rows(table.read()) == [(1, 1, "a")]
    for _ in range(2):
        table.upsert(keyed(spark, [(1, 1, "x"), (2, 1, "y")]), ["k"])
    assert rows(table.read()) == [(1, 1, "x"), (2, 1, "y")]


def test_a_failed_write_leaves_the_table_as_it_was(spark):
    table = SnapshotTable(spark, new_folder(spark, "t"))
    table.replace(keyed(spark, [(1, 1, "a")]))
    bad = keyed(spark, [(2, 1, "b")]).withColumn("v", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        table.replace(bad)
    assert rows(table.read()) == [(1, 1, "a")] and table.version() == 1


def test_shape_changes_and_repeated_keys_stop_an_upsert(spark):
    table = SnapshotTable(spark, new_folder(spark, "t"))
    table.replace(keyed(spark, [(1, 1, "a")]))
    with pytest.raises(ContractError, match="extra"):
        table.upsert(keyed(spark, [(1, 1, "b")]).withColumn("extra", F.lit(1)), ["k"])
    with pytest.raises(ContractError, match="v"):
        table.upsert(keyed(spark, [(1, 1, "b")]).withColumn("v", F.lit(1)), ["k"])
    with pytest.raises(ContractError, match="k: double is not bigint"):
        table.upsert(keyed(spark, [(1, 1, "b")]).withColumn("k", F.col("k").cast("double")), ["k"])
    with pytest.raises(ValueError, match="repeat"):
        table.upsert(keyed(spark, [(5, 1, "b"), (5, 1, "c")]), ["k"])
    assert rows(table.read()) == [(1, 1, "a")]


def test_a_stale_change_cancels_all_changes(spark):
    target = spark.createDataFrame([(1, 10, 20), (2, 11, 21)], "id bigint, cost int, price int")
    def events(*data):
        return spark.createDataFrame(data, "id bigint, old_cost int, new_cost int")
    args = ("id", {"cost": "old_cost"}, {"cost": "new_cost"})
    assert rows(apply_changes(target, events((1, 10, 15)), *args)) == [(1, 15, 20), (2, 11, 21)]
    with pytest.raises(StaleChange):
        apply_changes(target, events((1, 10, 15), (2, 99, 16)), *args)
    with pytest.raises(StaleChange):
        apply_changes(target, events((3, 1, 2)), *args)


def test_nested_headers_become_lines(spark):
    headers = spark.createDataFrame(
        [(7, "s", [(1, 2), (3, 4)])], "transaction_id bigint, store string, lines array<struct<product_id:int,quantity:int>>"
    )
    assert rows(facts.explode_lines(headers)) == [(7, "s", 1, 1, 2), (7, "s", 2, 3, 4)]


def test_spine_and_materialize(spark):
    assert rows(spine(spark, 3)) == [(0,), (1,), (2,)]
    assert materialize(spine(spark, 4), "view", "v_spine").count() == 4
    with pytest.raises(ValueError):
        materialize(spine(spark, 4), "other", "x")
    # Two tables bucketed on the join key meet without a shuffle.
    for name in ("bucketed_a", "bucketed_b"):
        materialize(spine(spark, 1000), "table", name, bucket_by=(4, ["i"]))
    joined = spark.table("bucketed_a").hint("merge").join(spark.table("bucketed_b"), "i")
    assert joined.count() == 1000
    plan = joined._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_scan_uses_the_declared_schema(spark):
    path = new_folder(spark, "scan")
    employee(spark, [1], "2024-01-01").write.parquet(f"{path}/employee.parquet")
    assert [f.dataType for f in read_table(spark, path, "employee").schema] == [f.dataType for f in schemas.SOURCE["employee"]]


# ------------------------------------------------------------------ the incremental fact
def slice_star(star, spark, keep):
    raws = {n: star.stored(f"raw_{n}").filter(keep) for n in ("sales_transaction", "sales_transaction_item")}
    out = Star(spark, lambda n: raws[n], star.as_of)
    for name, df in star.dims().items():
        out.use(name, df)
    return out


def test_incremental_runs_equal_a_full_refresh(star, spark):
    table = nightly.fact_table(spark, new_folder(spark, "fact"))
    nightly.run_fct_sales(slice_star(star, spark, "updated_at < timestamp_ntz'2024-06-01 00:00:00'"), table)
    partial = table.read().count()
    whole = slice_star(star, spark, "true")
    nightly.run_fct_sales(whole, table)
    full = star.stored("fct_sales").select(FACT_COLUMNS)
    assert 0 < partial < full.count()
    assert same(table.read().select(FACT_COLUMNS), full)
    nightly.run_fct_sales(whole, table)
    assert table.read().count() == full.count(), "a second run adds no rows"
    nightly.run_fct_sales(whole, table, mode="full")
    assert same(table.read().select(FACT_COLUMNS), full)


def test_slice_from_the_watermark_equals_a_filter_on_the_join(star):
    lines, tx = history.dedupe_copies(star.stored("raw_sales_transaction_item")), star.stored("stg_sales_transaction")
    mark = ts("2024-03-01")
    got = facts.incremental_slice(lines, tx, mark)
    assert same(got, facts.headers_lines(tx, lines).filter(F.col("source_updated_at") >= C.at(mark)))
    assert facts.incremental_slice(lines, tx, None).count() == facts.headers_lines(tx, lines).count()


def test_late_dimension_rows_are_repaired_by_a_refresh(star, spark):
    late = Star(spark, star.raw, star.as_of)
    for name, df in star.dims().items():
        late.use(name, df)
    late.use("stg_sales_transaction", star.stored("stg_sales_transaction"))
    late.use("raw_sales_transaction_item", star.stored("raw_sales_transaction_item"))
    late.use("dim_product", star.stored("dim_product").filter("product_id % 2 = 0 or product_id = -2"))
    table = nightly.fact_table(spark, new_folder(spark, "fact"))
    nightly.run_fct_sales(late, table)
    unknown = table.read().filter("product_key = -2")
    assert unknown.count() > 0 and unknown.filter("unit_cost is not null or gross_profit is not null").isEmpty()
    complete = lambda: star.stored("fct_sales")
    before, after = loads.repair_unknown(table, complete)
    assert before > after == facts.unknown_rows(star.stored("fct_sales")).count()
    assert table.read().filter("product_key = -2").isEmpty()


def test_nightly_runs(star, spark):
    """Two nights over a growing source: the second adds what is new and every error rule holds."""
    root = new_folder(spark, "nightly")

    def source(cut):
        def read(name):
            df = star.stored(f"raw_{name}")
            if name not in schemas.APPENDED:
                return df
            return df.filter("_load_id = 1").drop("_load_id").filter(F.col("updated_at") < C.at(ts(cut)))
        return read

    first = nightly.run_pipeline(spark, source("2024-06-01"), root, star.as_of, 1, blocking_relationships=False)
    n1 = nightly.fact_table(spark, root).read().count()
    second = nightly.run_pipeline(spark, source("2100-01-01"), root, star.as_of, 2, blocking_relationships=False)
    n2 = nightly.fact_table(spark, root).read().count()
    assert 0 < n1 < n2 == star.stored("fct_sales").count()
    # The given sales break two relationships and one source rule; everything else holds.
    known = ["relationships payment_method_id", "relationships promotion_id", "promotion pair exists"]
    for results in (first, second):
        wrong = results.filter("severity = 'error' and bad_rows > 0")
        assert wrong.filter(~F.col("rule").isin(known)).isEmpty()
        assert results.filter("rule = 'status never changes'").count() == 1
        assert results.filter("table = 'product_history'").count() > 0
    with pytest.raises(QualityError, match="relationships"):
        nightly.run_pipeline(spark, source("2100-01-01"), new_folder(spark, "nightly"), star.as_of, 1)


def test_a_tie_in_the_change_time_stops_the_night(star, spark):
    def source(name):
        df = star.stored(f"raw_{name}")
        df = df.filter("_load_id = 1").drop("_load_id") if name in schemas.APPENDED else df
        return df.union(df.limit(1).withColumn("unit_cost", (F.col("unit_cost") + 1).cast("decimal(12,2)"))) if name == "product" else df

    root = new_folder(spark, "nightly")
    with pytest.raises(QualityError, match="stg_product"):
        nightly.run_pipeline(spark, source, root, star.as_of, 1, blocking_relationships=False)
    assert not nightly.fact_table(spark, root).exists()


def test_bad_raw_stops_the_night_before_any_mart(star, spark):
    def source(name):
        df = star.stored(f"raw_{name}")
        df = df.filter("_load_id = 1").drop("_load_id") if name in schemas.APPENDED else df
        return df.withColumn("status", F.lit("refunded")) if name == "sales_transaction" else df

    root = new_folder(spark, "nightly")
    with pytest.raises(QualityError, match="status"):
        nightly.run_pipeline(spark, source, root, star.as_of, 1)
    assert not nightly.fact_table(spark, root).exists()


# ------------------------------------------------------------------ streams
def test_stream_reads_every_file_once(spark):
    folder, path, state = (new_folder(spark, n) for n in ("files", "raw", "state"))
    employee(spark, [1, 2], "2024-01-01").write.parquet(folder)
    stream = lambda: loads.read_files(spark, folder, schemas.SOURCE["employee"])
    assert loads.ingest_stream(stream(), path, state) == 2
    assert loads.ingest_stream(stream(), path, state) == 0
    employee(spark, [3], "2024-01-02").write.mode("append").parquet(folder)
    assert loads.ingest_stream(stream(), path, state) == 1
    assert spark.read.parquet(path).count() == 3


def test_stream_drops_copies(spark):
    folder, path, state = (new_folder(spark, n) for n in ("files", "clean", "state"))
    employee(spark, [1, 2, 1], "2024-01-01").write.parquet(folder)
    clean = loads.dedupe_stream(loads.read_files(spark, folder, schemas.SOURCE["employee"]), ["id"], "updated_at", "1 hour")
    loads.ingest_stream(clean, path, state)
    assert rows(spark.read.parquet(path), "id") == [(1,), (2,)]


def test_stream_upserts_by_key(spark):
    folder, state = new_folder(spark, "files"), new_folder(spark, "state")
    table = SnapshotTable(spark, new_folder(spark, "t"))
    schema = items(spark, []).schema

    def run(data):
        items(spark, data).write.mode("append").parquet(folder)
        loads.upsert_stream(loads.read_files(spark, folder, schema), table, ["id"], state, "updated_at")

    run([(1, 1, "2024-01-01"), (1, 2, "2024-01-02"), (2, 1, "2024-01-01")])
    run([(2, 5, "2024-01-03"), (3, 1, "2024-01-03")])
    assert rows(table.read(), "id", "v") == [(1, 2), (2, 5), (3, 1)]


def test_batches_out_of_order_keep_the_newest_row(spark):
    folder, state = new_folder(spark, "files"), new_folder(spark, "state")
    table = SnapshotTable(spark, new_folder(spark, "t"), mark="updated_at")
    schema = items(spark, []).schema
    for data in ([(1, 9, "2024-01-09")], [(1, 5, "2024-01-05"), (2, 1, "2024-01-01")]):
        items(spark, data).write.mode("append").parquet(folder)
        loads.upsert_stream(loads.read_files(spark, folder, schema), table, ["id"], state, "updated_at")
    assert rows(table.read(), "id", "v") == [(1, 9), (2, 1)]


def test_a_header_after_its_lines_brings_them(spark):
    """Lines 1 and 2 arrive with header 1 only; header 2 comes a batch later."""
    shape = {"head": spark.createDataFrame([], "id bigint, store int").schema, "line": spark.createDataFrame([], "id bigint, n int").schema}
    landed = loads.LandedStreams(spark, new_folder(spark, "landed"), "id")
    table = SnapshotTable(spark, new_folder(spark, "t"))
    folders, states = ({n: new_folder(spark, n) for n in shape} for _ in range(2))

    def arrive(name, data):
        spark.createDataFrame(data, shape[name]).write.mode("append").parquet(folders[name])
        stream = loads.read_files(spark, folders[name], shape[name])
        build = lambda t: t["line"].join(t["head"], "id")
        landed.upsert(stream, name, shape, build, table, ["id", "n"], states[name], needs=("head", "line"))

    arrive("head", [(1, 10)])
    arrive("line", [(1, 1), (2, 1), (2, 2)])
    assert rows(table.read(), "id", "n", "store") == [(1, 1, 10)]
    arrive("head", [(2, 20)])
    arrive("line", [(1, 2)])
    assert rows(table.read(), "id", "n", "store") == [(1, 1, 10), (1, 2, 10), (2, 1, 20), (2, 2, 20)]


def test_two_streams_of_one_table_keep_their_landed_rows(spark):
    """Checkpoints that end in the same name belong to two streams."""
    shape = spark.createDataFrame([], "id bigint, v string").schema
    landed, table = loads.LandedStreams(spark, new_folder(spark, "landed"), "id"), SnapshotTable(spark, new_folder(spark, "t"))
    for stream, data in {"p1": [(1, "x"), (2, "x")], "p2": [(1, "y")]}.items():
        folder = new_folder(spark, stream)
        spark.createDataFrame(data, shape).write.parquet(folder)
        build = lambda t: t["t"].groupBy("id").agg(F.array_join(F.sort_array(F.collect_list("v")), "").alias("vs"))
        landed.upsert(
            loads.read_files(spark, folder, shape), "t", {"t": shape}, build, table, ["id"], f"{new_folder(spark, stream)}/state", needs=("t",)
        )
    assert rows(table.read(), "id", "vs") == [(1, "xy"), (2, "x")]


def test_a_repeated_load_id_brings_its_new_rows(star, spark):
    """The source grew between two runs of one load id: the fact follows RAW."""
    root = new_folder(spark, "nightly")

    def source(cut):
        def read(name):
            df = star.stored(f"raw_{name}")
            if name not in schemas.APPENDED:
                return df
            return df.filter("_load_id = 1").drop("_load_id").filter(F.col("updated_at") < C.at(ts(cut)))

        return read

    for cut in ("2024-06-01", "2100-01-01"):
        results = nightly.run_pipeline(spark, source(cut), root, star.as_of, 1, blocking_relationships=False)
    assert nightly.fact_table(spark, root).read().count() == star.stored("fct_sales").count()
    assert results.filter("rule like 'row count%' and bad_rows > 0").isEmpty()


def test_lines_and_headers_meet_in_state(spark):
    """A header first, a line first, a header after the delay (of a sale, of a return), and one that never comes."""
    line_shape, head_shape = schemas.RAW["sales_transaction_item"], schemas.RAW["sales_transaction"]
    folders, state = {n: new_folder(spark, n) for n in ("line", "head")}, new_folder(spark, "state")
    table = SnapshotTable(spark, new_folder(spark, "t"), mark="mark")
    seen = []

    def line(i, at_day, number=1):
        return (i, number, 7, None, 1, money(10), money(0), ts(at_day), ts(at_day), 1)

    def head(i, at_day, status="completed"):
        return (i, i + 100, 5, 1, ts(at_day), status, ts(at_day), ts(at_day), 1)

    def run(lines=(), heads=()):
        for name, shape, data in (("line", line_shape, lines), ("head", head_shape, heads)):
            spark.createDataFrame(list(data), shape).coalesce(1).write.mode("append").parquet(folders[name])
        streams = [loads.read_files(spark, folders[n], s) for n, s in (("line", line_shape), ("head", head_shape))]
        loads.upsert_stream(loads.join_lines_headers(*streams, "2 days"), table, ["transaction_id", "line_number"], state, "mark")
        seen.append(rows(table.read(), "transaction_id", "line_number", "store_id") if table.exists() else [])

    run([line(2, "2024-01-01"), line(3, "2024-01-01"), line(4, "2024-01-01"), line(5, "2024-01-01"), line(6, "2024-01-01")], [head(1, "2024-01-01"), head(6, "2024-01-01", "returned")])
    assert seen[-1] == [], "lines wait for their headers, and a returned sale has none"
    run([line(1, "2024-01-02"), line(1, "2024-01-02", 2)], [head(2, "2024-01-02")])
    assert seen[-1] == [(1, 1, 101), (1, 2, 101), (2, 1, 102)]
    run([line(900, "2024-03-01")], [head(901, "2024-03-01")])  # time passes on both sides
    assert seen[-1] == [(1, 1, 101), (1, 2, 101), (2, 1, 102), (3, 1, -2), (4, 1, -2), (5, 1, -2)]
    run([], [head(3, "2024-01-01"), head(5, "2024-01-01", "cancelled")])
    assert seen[-1] == seen[-2], "a header after the delay finds no line in state"
    loads.repair_alone(table, spark.read.schema(head_shape).parquet(folders["head"]), ["transaction_id", "line_number"])
    assert rows(table.read(), "transaction_id", "line_number", "store_id") == [(1, 1, 101), (1, 2, 101), (2, 1, 102), (3, 1, 103), (4, 1, -2)]


def test_a_night_that_fails_after_its_fact_load_publishes_nothing(star, spark, monkeypatch):
    root = new_folder(spark, "nightly")

    def source(cut):
        def read(name):
            df = star.stored(f"raw_{name}")
            if name not in schemas.APPENDED:
                return df
            return df.filter("_load_id = 1").drop("_load_id").filter(F.col("updated_at") < C.at(ts(cut)))

        return read

    nightly.run_pipeline(spark, source("2024-06-01"), root, star.as_of, 1, blocking_relationships=False)
    published = nightly.nights(spark, root)
    before = {m: published.read(m).count() for m in published.published()}
    assert {"fct_sales", "fct_store_headcount_monthly", "dim_product", "dim_employee"} <= set(before)

    def broken(*_):
        raise QualityError("a mart is wrong")

    with monkeypatch.context() as broken_night:
        broken_night.setattr(nightly, "mart_checks", broken)
        with pytest.raises(QualityError, match="a mart is wrong"):
            nightly.run_pipeline(spark, source("2100-01-01"), root, star.as_of, 2, blocking_relationships=False)
    assert nightly.fact_table(spark, root).read().count() > before["fct_sales"], "the fact was loaded"
    assert {m: published.read(m).count() for m in published.published()} == before, "and nobody sees it"

    nightly.run_pipeline(spark, source("2100-01-01"), root, star.as_of, 2, blocking_relationships=False)
    assert published.read("fct_sales").count() == star.stored("fct_sales").count()
    whole = star.stored("product_history")
    assert same(nightly.maintained_history(star, root, "product").versions().select(whole.columns), whole)
    columns = [c for c in schemas.MART["fct_store_headcount_monthly"].names if c not in ("is_month_closed", "as_of_date")]
    assert same(published.read("fct_store_headcount_monthly").select(columns), star.stored("fct_store_headcount_monthly").select(columns))
    # what the appends measured is what a scan of RAW finds
    raw = nightly.raw_table(spark, root)
    scanned = stack([suites.raw_checks(raw(t), t) for t in suites.RAW_RULES])
    assert rows(nightly.raw_results(spark, root)) == rows(scanned)
    # rows whose results were lost are scanned
    ingest.append_raw(raw("employee").limit(1).drop("_load_id").withColumn("store_id", F.lit(None).cast("bigint")), f"{root}/raw/employee", 9)
    lost = nightly.raw_results(spark, root).filter("bad_rows > 0")
    assert rows(lost, "table", "rule") == [("employee", "not_null store_id")]
