"""One key holds a third of the rows: a receipt, a product, a seller, a store, a promotion.

The whole chain runs with limits so small that every split, salt and merge path is taken, and the results are
compared with DuckDB on the same skewed tables.
"""

import os
import sys
import time

import duckdb
import pytest

from conftest import SF

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import compare  # noqa: E402

from tillbook.operators.scale import Limits  # noqa: E402
from tillbook.plans import oracle, registry  # noqa: E402
from tillbook.plans.star import Star  # noqa: E402
from tillbook.sources import testdata  # noqa: E402

SKEW = {
    "lineitem": "select * replace (if(h % 3 = 0, 7, l_orderkey) as l_orderkey, if(h % 3 = 1, 5, l_partkey) as l_partkey, "
    "if(h % 3 = 2, 0.03, l_discount) as l_discount) from (select *, hash(l_orderkey, l_linenumber, l_partkey) as h from t)",
    "orders": "select * replace (if(o_orderkey % 3 = 0, 3, o_custkey) as o_custkey, if(o_orderkey = 7, 'F', o_orderstatus) as o_orderstatus) from t",
    "events": "select * replace (if(event_id % 3 = 0, 4, user_id) as user_id) from t",
}
QUERIES = [
    "scan_sales_transaction_item",
    "stg_completed_items",
    "scd2_product",
    "scd2_employee",
    "scd2_checks_product",
    "scd2_checks_employee",
    "pit_product",
    "fct_sales",
    "fct_sales_enriched",
    "employee_daily_store",
    "headcount_monthly",
    "gross_profit_by_store",
    "report_profit_by_cashier",
    "sales_integrity",
    "relationships_orphans",
]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    out = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for t in compare.TABLES:
        con.execute(f"create or replace view t as select * from read_parquet('{SF}/{t}.parquet')")
        columns = ", ".join(r[0] for r in con.execute("describe t").fetchall())
        rows = f"select {columns} from ({SKEW[t]})" if t in SKEW else "select * from t"
        con.execute(f"copy ({rows}) to '{out}/{t}.parquet' (format parquet)")
    return str(out)


@pytest.fixture(scope="module")
def con(folder):
    return compare.connect(folder)


@pytest.fixture(scope="module", params=["default", "tiny"])
def skewed(request, spark, folder):
    tiny = Limits(broadcast_rows=20, versions_per_key=2, rows_per_task=150)
    limits = Limits() if request.param == "default" else tiny
    return Star(spark, lambda n: testdata.retail_table(spark, folder, n, limits), registry.AS_OF, limits=limits)


def test_the_tables_are_skewed(con):
    shares = "select max(n) / sum(n) from (select count(*) as n from {} group by {})"
    for table, key in [("lineitem", "l_orderkey"), ("lineitem", "l_partkey"), ("events", "user_id"), ("orders", "o_custkey")]:
        assert con.execute(shares.format(table, key)).fetchall()[0][0] > 0.3


@pytest.mark.parametrize("name", QUERIES)
def test_results_hold_under_skew(skewed, con, name):
    df = registry.present(registry._BUILDS[name](skewed))
    result = compare.compare_frame(df, con, oracle.statements()[name], time.time())
    assert result.startswith("ok"), result
