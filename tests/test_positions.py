import datetime
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerloom.operators.positions import Neighbour, tile, with_neighbours, with_position
from ledgerloom.operators.running import running_by_self_join, running_by_window
from tests.conftest import ordered, physical_plan, same


def test_positions_equal_row_numbers(spark):
    rng = random.Random(3)
    df = spark.createDataFrame(
        [(i, rng.choice(["a", "b", None, "hot", "hot", "hot"])) for i in range(3000)], "id int, name string"
    ).repartition(6)
    order = [F.col("name"), F.col("id")]
    found = with_position(df, order, "p", "n")
    expected = df.select(
        "*", (F.row_number().over(Window.orderBy(*order)) - 1).cast("bigint").alias("p")
    ).withColumn("n", F.lit(3000).cast("bigint"))
    assert same(found.select("id", "name", "p", "n"), expected.select("id", "name", "p", "n"))


def test_position_of_nothing(spark):
    assert with_position(spark.range(0), [F.col("id")]).count() == 0


@pytest.mark.parametrize("block", [2, 3, 7, 1000])
@pytest.mark.parametrize("count", [0, 1, 2, 20])
def test_neighbours_equal_lead_and_lag(spark, block, count):
    df = spark.range(count).select(F.col("id").alias("p"), F.concat(F.lit("n"), "id").alias("name"))
    window = Window.orderBy("p")
    expected = df.select(
        "*",
        F.lead("p").over(window).alias("next"),
        F.lag("p").over(window).alias("prev"),
        F.lag("name", 2, "No items").over(window).alias("two"),
    )
    found = with_neighbours(
        df,
        "p",
        [Neighbour("next", "p", 1), Neighbour("prev", "p", -1), Neighbour("two", "name", -2, "No items")],
        block,
    )
    assert same(found, expected)


def test_block_shorter_than_reach_is_refused(spark):
    with pytest.raises(ValueError):
        with_neighbours(spark.range(5).toDF("p"), "p", [Neighbour("far", "p", -3)], 2)


@pytest.mark.parametrize("count,tiles", [(1, 30), (29, 30), (30, 30), (31, 30), (100, 7), (5, 2), (64, 64)])
def test_tile_equals_ntile(spark, count, tiles):
    df = spark.range(count)
    found = df.select("id", tile(F.col("id"), F.lit(count).cast("bigint"), tiles).alias("t"))
    expected = df.select("id", F.ntile(tiles).over(Window.orderBy("id")).alias("t"))
    assert same(found, expected)


def test_running_totals_agree(spark):
    rng = random.Random(5)
    months = [datetime.date(y, m, 28) for y in (1, 1999, 2000, 2001, 9999) for m in range(1, 13) if rng.random() < 0.8]
    df = spark.createDataFrame(
        [(m, rng.randint(-10**6, 10**6)) for m in months], "month date, amount bigint"
    )
    by_window = running_by_window(df, "month", "amount", "total")
    by_join = running_by_self_join(df, "month", "amount", "total")
    assert ordered(by_window) == ordered(by_join)
    total = 0
    for (month, amount), (m, running) in zip(sorted(df.collect()), sorted(map(tuple, by_window.collect()))):
        total += amount
        assert (m, running) == (month, total)
    plan = physical_plan(by_join)
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Window" not in plan
