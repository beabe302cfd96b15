import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.joins import keep_absent, keep_present
from ledgerloom.operators.topk import first_per_group, nth_highest, page, reaches, top_with_ties
from tests.conftest import ordered, physical_plan, rows


def prices(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "id int, price int")


@pytest.mark.parametrize(
    "values,n,descending,kept",
    [
        ([5, 4, 4, 4, 1], 2, True, [0, 1, 2, 3]),
        ([5, 4, 3], 3, True, [0, 1, 2]),
        ([5, 4], 3, True, [0, 1]),
        ([5, None, None], 2, True, [0, 1, 2]),
        ([5, 4, None], 2, True, [0, 1]),
        ([1, 1, 2, 3], 1, False, [0, 1]),
        ([None, None, 1], 1, False, [0, 1]),
        ([None, 1, 1, 2], 2, False, [0, 1, 2]),
        ([], 3, True, []),
    ],
)
def test_top_with_ties(spark, values, n, descending, kept):
    found = top_with_ties(prices(spark, values), n, "price", descending)
    assert sorted(r[0] for r in rows(found)) == kept


def test_page(spark):
    df = spark.range(0, 50, 1, 7)
    by_ten = df.withColumn("ten", F.expr("nullif(id div 10, 0)"))
    for skip, fetch in ((10, 3), (49, 3), (8, 25), (0, 50), (50, 3)):
        expected = [(i,) for i in range(50)][skip : skip + fetch]
        found = page(by_ten, skip, fetch, ["ten"], ["id"])
        assert rows(found.select("id")) == expected and found.columns == by_ten.columns
    plan = physical_plan(page(by_ten, 40, 3, ["ten"], ["id"]))
    assert "TakeOrdered" not in plan and "SinglePartition" not in plan


def test_first_per_group(spark):
    df = spark.createDataFrame([(1, 9), (1, 8), (1, 7), (2, 1)], "g int, v int")
    found = first_per_group(df, 2, ["g"], F.col("v").desc())
    assert ordered(found.select("g", "v")) == [(1, 8), (1, 9), (2, 1)]


def test_nth_highest_ranks(spark):
    df = spark.createDataFrame(
        [(1, "a", 9), (1, "b", 9), (1, "c", 8), (1, "d", 7), (2, "a", 3), (3, "a", None), (3, "b", 5)],
        "g int, item string, price int",
    )

    def kept(edges):
        return ordered(df.join(edges, "g").filter(reaches("price")).select("g", "item"))

    dense = nth_highest(df.select("g", "price").distinct(), 2, ["g"], "price")
    assert kept(dense) == [(1, "a"), (1, "b"), (1, "c"), (2, "a"), (3, "a"), (3, "b")]
    plain = nth_highest(df, 2, ["g"], "price", ["item"])
    assert kept(plain) == [(1, "a"), (1, "b"), (2, "a"), (3, "a"), (3, "b")]


def test_presence_with_null_keys(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(2,), (2,), (None,)], "k int")
    assert rows(keep_present(left, right, ["k"])) == [(2,)]
    assert ordered(keep_absent(left, right, ["k"])) == [(1,), (None,)]
