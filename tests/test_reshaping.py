import datetime

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.calendar import months_between, with_empty_months
from ledgerloom.operators.reshaping import (
    pivot_count,
    pivot_count_discovered,
    unpivot_as_text,
    unpivot_present,
)
from tests.conftest import ordered, rows


@pytest.fixture
def orders(spark):
    return spark.createDataFrame(
        [("m1", "a", 1), ("m1", "a", 2), ("m1", "b", 3), ("m2", "z", 4), ("m2", "a", None)],
        "month string, key string, id int",
    )


def test_pivot_fills_zeros_and_ignores_other_keys(orders):
    found = pivot_count(orders, "month", "key", "id", ["b", "a"])
    assert found.columns == ["month", "b", "a"]
    assert ordered(found) == [("m1", 1, 2), ("m2", 0, 0)]


def test_pivot_discovers_columns_in_order(orders):
    found = pivot_count_discovered(orders, "month", "key", "id")
    assert found.columns == ["month", "a", "b", "z"]
    assert ordered(found) == [("m1", 2, 1, 0), ("m2", 0, 0, 1)]


def test_pivot_has_as_many_columns_as_there_are_values(spark, orders):
    spark.conf.set("spark.sql.pivotMaxValues", "2")
    try:
        assert pivot_count_discovered(orders, "month", "key", "id").columns == ["month", "a", "b", "z"]
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")


def test_keys_that_differ_in_case_are_one_column(spark):
    df = spark.createDataFrame(
        [("m1", "BUILDING", 1), ("m1", "Building", 2), ("m2", "b.x", 3), ("m2", None, 4)], "month string, key string, id int"
    )
    found = pivot_count_discovered(df, "month", "key", "id")
    assert found.columns == ["month", "b.x", "BUILDING"]
    assert ordered(found) == [("m1", 0, 2), ("m2", 1, 0)]


def test_unpivot_drops_nulls(spark):
    df = spark.createDataFrame([(1, "x", None), (2, None, None), (3, "p", "q")], "id int, a string, b string")
    found = unpivot_present(df, ["id"], ["a", "b"], "line")
    assert ordered(found.select("id", "line")) == [(1, "x"), (3, "p"), (3, "q")]


def test_unpivot_mixed_types(spark):
    df = spark.createDataFrame([(1, "AFG", 4), (3, "ALB", None)], "id int, alpha string, num int")
    found = unpivot_as_text(df, ["id"], {"alpha": F.col("alpha"), "num": F.col("num")}, "code")
    assert ordered(found.select("id", "code")) == [(1, "4"), (1, "AFG"), (3, "ALB")]


def test_empty_months(spark):
    days = [datetime.date(2000, 11, 5), datetime.date(2001, 2, 1)]
    months = months_between(spark.createDataFrame([(d,) for d in days], "d date"), "d")
    assert ordered(months) == [(2000, 11), (2000, 12), (2001, 1), (2001, 2)]
    sold = spark.createDataFrame([(2000, 11, 9), (2001, 2, 1)], "year int, month int, total int")
    report = sold.filter("total > 5")
    found = with_empty_months(report, months, sold, {"total": 0})
    assert ordered(found) == [(2000, 11, 9), (2000, 12, 0), (2001, 1, 0)]


def test_no_dates_no_months(spark):
    assert rows(months_between(spark.createDataFrame([], "d date"), "d")) == []
