import os
import sys
import tempfile
from datetime import date, datetime
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillbook.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="tillbook-warehouse-")
    session = local_session("tests", 8, "4g", **{"spark.sql.warehouse.dir": warehouse})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def star(spark):
    from tillbook.plans import registry

    return registry.star(spark, SF)


def ts(text: str) -> datetime:
    return datetime.fromisoformat(text)


def day(text: str) -> date:
    return date.fromisoformat(text)


def money(text) -> Decimal:
    return Decimal(str(text))


def rows(df, *columns) -> list[tuple]:
    """Rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
