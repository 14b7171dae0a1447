import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stayline.session import build_session, tune  # noqa: E402
from stayline.sources.projection import AfterSales  # noqa: E402

SMALL = "/root/testdata/sf0.001"
AS_OF = dt.date(1999, 12, 31)


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "6g"}
    )
    session.sparkContext.setLogLevel("OFF")
    yield tune(session)
    session.stop()


@pytest.fixture(scope="session")
def star(spark):
    return AfterSales(spark, SMALL, AS_OF)


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples."""
    return lambda df, *cols: sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())
