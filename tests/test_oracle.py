"""Every registered query against an independent SQL engine on the same tables."""

import duckdb
import pytest

import __spark_entry__ as entry_file
from tests.conftest import physical_plan

QUERIES = {name: q for name, q in entry_file.queries().items() if name in entry_file.QUERIES}
ORACLE = entry_file.ORACLE
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
SELECTIVE = {"big_months"}  # its limit suits larger tables
TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck(folder):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def _canonical(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in found)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


# what may pass through one task: aggregates without keys, one row per month
BOUNDED = ("HashAggregate(keys=[]", "HashAggregate(keys=[month#")
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "FullOuter", "SortAggregate", "EvalPython")


def _check_plan(df):
    plan = physical_plan(df)
    assert not [bad for bad in UNWANTED if bad in plan]
    lines = plan.splitlines()
    for number, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert any(b in lines[number + 1] for b in BOUNDED), lines[number + 1]


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_oracle(spark, folder, duck, no_broadcast, name):
    """Run as on tables too large to broadcast: first the shape of the plan, then the rows."""
    df = QUERIES[name](spark, folder)
    _check_plan(df)
    expected = duck.execute(ORACLE[name])
    types = {c[0]: str(c[1]) for c in expected.description}
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    found = [tuple(r) for r in df.collect()]
    assert _canonical(df.columns, found) == _canonical(list(types), expected.fetchall())
    assert found or name in SELECTIVE, "a query without rows checks nothing"


def test_entry_is_the_flagship(spark, folder):
    df = entry_file.entry(spark)
    assert df.columns == [
        "invoice_id", "customer_name", "invoice_date", "invoice_amount", "running_amount",
    ]
    assert df.count() > 0
