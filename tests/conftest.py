import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerloom import build_session  # noqa: E402
from ledgerloom.sources.catalog import Catalog  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[4]",
        4,
        **{
            "spark.ui.enabled": "false",
            "spark.sql.warehouse.dir": str(base / "warehouse"),
            "spark.checkpoint.dir": str(base / "shared"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    if not os.path.isdir(DATA):
        pytest.skip(f"no test tables at {DATA}")
    return DATA


@pytest.fixture(scope="session")
def catalog(spark, folder):
    return Catalog(spark, folder)


@pytest.fixture
def no_broadcast(spark):
    """Sizes at which nothing is small enough to broadcast by itself."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def rows(df):
    return [tuple(r) for r in df.collect()]


def ordered(df):
    return sorted(rows(df), key=repr)


def same(left, right):
    assert left.columns == right.columns
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def physical_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
