"""Twin formulations agree; the physical plans keep their shape; hot keys are split."""

from decimal import Decimal

import pytest
from pyspark.errors import ArithmeticException
from pyspark.sql import functions as F

from ledgerloom.operators import joins
from ledgerloom.plans import listings, parameters, ranking, sales, subqueries
from ledgerloom.plans.registry import run
from ledgerloom.sources.workspace import materialize
from tests.conftest import ordered, physical_plan, rows, same

TWINS = [
    ("idle_salespeople_exists", "idle_salespeople_left_join"),
    ("min_price_items", "min_price_join"),
    ("top_payers_in", "top_payers_cte"),
    ("top_item_cities_nested", "top_item_cities_cte"),
    ("running_total_self_join", "running_total_by_month"),
    ("xml_items_source", "xml_items_shred"),
    ("customer_totals_left_join", "customer_totals_lateral"),
]


@pytest.mark.parametrize("one,other", TWINS)
def test_twins_agree(spark, folder, one, other):
    assert same(run(one, spark, folder), run(other, spark, folder))


def test_existence_plans_as_anti_join(spark, folder):
    for name in ("idle_salespeople_exists", "idle_salespeople_left_join", "suppliers_without_orders"):
        assert "LeftAnti" in physical_plan(run(name, spark, folder))


def test_date_filter_and_columns_reach_the_scan(catalog):
    df = sales.monthly_sales(
        catalog.orders.filter(F.col("order_date") >= F.lit("2000-01-01").cast("date")), catalog.lines
    )
    plan = physical_plan(df)
    assert "GreaterThanOrEqual(o_orderdate,2000-01-01T00:00)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_extendedprice:double>" in plan


def test_groups_are_limited_before_the_shuffle(spark, folder):
    plan = physical_plan(run("top2_items_per_month", spark, folder))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_listing_is_sorted(spark, folder):
    found = run("order_calendar", spark, folder).select("quarter", "third_of_year").collect()
    assert found == sorted(found)


def test_functions_in_sql(spark, catalog):
    parameters.register_functions(spark, catalog.orders, catalog.lines)
    best = parameters.best_customer(catalog.orders, catalog.lines).first()[0]
    assert spark.sql("SELECT best_customer()").first()[0] == best
    total = parameters.customer_total(catalog.orders, catalog.lines, best).first()[0]
    assert spark.sql(f"SELECT customer_total_int({best})").first()[0] == int(total)
    assert spark.sql(f"SELECT total FROM customer_sum({best})").first()[0] == total
    assert rows(parameters.customer_total(catalog.orders, catalog.lines, -1)) == [(None,)]
    assert rows(spark.sql("SELECT total FROM customer_sum(-1)")) == [(None,)]


def test_customer_without_orders_stays(spark, catalog):
    nobody = spark.createDataFrame([(-5, "nobody")], "customer_id bigint, customer_name string")
    for totals in (parameters.customer_totals, parameters.customer_totals_lateral):
        assert rows(totals(nobody, catalog.orders, catalog.lines)) == [(-5, "nobody", None)]


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """Orders and lines in which one order has a third of the lines and one customer half the orders."""
    base = str(tmp_path_factory.mktemp("hot"))
    count = 60_000
    orders = spark.range(count // 4).select(
        F.col("id").alias("order_id"),
        F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id") % 997 + 2).cast("bigint").alias("customer_id"),
        F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") % 700).cast("int")).alias("order_date"),
    )
    lines = spark.range(0, count, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % (count // 4)).cast("bigint").alias("order_id"),
        F.col("id").alias("line_number"),
        F.pmod(F.xxhash64("id"), F.lit(50)).alias("item_id"),
        (F.col("id") % 5).alias("salesperson_id"),
        (F.col("id") % 7 + 1).cast("int").alias("quantity"),
        F.pmod(F.xxhash64("id"), F.lit(1009)).cast("decimal(18,2)").alias("unit_price"),
        F.lit("2001-01-01").cast("date").alias("picking_completed"),
    )
    customers = spark.range(1, 1000).select(
        F.col("id").alias("customer_id"), F.concat(F.lit("c"), "id").alias("customer_name")
    )
    items = spark.range(50).select(
        F.col("id").alias("item_id"), F.concat(F.lit("i"), F.col("id") % 3).alias("item_name"),
        F.col("id").cast("decimal(18,2)").alias("unit_price"),
    )
    out = {}
    tables = {"orders": orders, "lines": lines, "customers": customers, "items": items}
    for name, df in tables.items():
        df.write.parquet(f"{base}/{name}")
        out[name] = spark.read.parquet(f"{base}/{name}")
    return out


@pytest.fixture
def small_partitions(spark, no_broadcast):
    """Skew thresholds brought down to the size of the fixture."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "4k",
        "spark.sql.files.maxPartitionBytes": "64k",
        "spark.sql.files.openCostInBytes": "0",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


def _final_plan(df):
    df.collect()
    return physical_plan(df).split("== Initial Plan ==")[0]


def test_hot_order_and_customer_are_split(hot, small_partitions):
    df = listings.order_calendar(hot["orders"], hot["lines"], hot["customers"], 10, 1)
    assert "skew=true" in _final_plan(df)
    expected = (
        hot["lines"].filter("unit_price > 10 OR quantity > 1").join(hot["orders"], "order_id")
        .join(hot["customers"], "customer_id").count()
    )
    assert df.count() == expected


def test_hot_customer_is_split_in_dearest_items(hot, small_partitions):
    three = hot["orders"], hot["lines"], hot["customers"]
    by_price = ranking.dearest_items_by_price(*three)
    assert "skew=true" in _final_plan(by_price)
    by_rank = ranking.dearest_items_by_rank(*three)
    assert "skew=true" in _final_plan(by_rank)

    def expected(bought, rank, condition):
        return by_price.sparkSession.sql(
            f"""
            WITH bought AS (
                SELECT DISTINCT o.customer_id, customer_name, item_id, unit_price, order_date AS invoice_date
                FROM {{orders}} AS o JOIN {{lines}} AS l ON l.order_id = o.order_id
                JOIN {{customers}} AS c ON c.customer_id = o.customer_id),
            ranked AS (SELECT *, {rank}() OVER (PARTITION BY customer_id ORDER BY unit_price DESC) AS r
                FROM (SELECT DISTINCT {bought} FROM bought))
            SELECT * FROM bought AS b WHERE EXISTS (
                SELECT 1 FROM ranked AS k WHERE k.r <= 2 AND k.customer_id = b.customer_id AND {condition})
            """,
            orders=hot["orders"], lines=hot["lines"], customers=hot["customers"],
        )

    assert same(by_price, expected("customer_id, unit_price", "dense_rank", "k.unit_price = b.unit_price"))
    assert same(by_rank, expected("customer_id, item_id, unit_price", "rank", "k.item_id = b.item_id"))


def test_hot_item_is_split_among_its_buyers(hot, small_partitions):
    lines = hot["lines"].withColumn(
        "item_id", F.when(F.col("line_number") % 3 == 0, 1).otherwise(F.col("item_id")).cast("bigint")
    )
    customers = hot["customers"].withColumn("segment", F.lit("s"))
    found = listings.buyers_of_item(hot["orders"], lines, hot["items"], customers, "i1")
    assert "skew=true" in _final_plan(found)
    wanted = [r[0] for r in hot["items"].filter("item_name = 'i1'").select("item_id").collect()]
    expected = (
        lines.filter(F.col("item_id").isin(wanted)).join(hot["orders"], "order_id")
        .join(customers, "customer_id").select("customer_id").distinct()
    )
    assert same(found.select("customer_id"), expected)


def test_hot_order_is_split_among_its_pickers(spark, hot, small_partitions, monkeypatch):
    lines = hot["lines"].withColumn("picker_id", F.col("line_number") % 11)
    customers = hot["customers"].withColumn("city_id", F.col("customer_id") % 20)
    cities = spark.range(20).select(F.col("id").alias("city_id"), F.concat(F.lit("t"), "id").alias("city_name"))
    people = spark.range(9).select(F.col("id").alias("person_id"), F.concat(F.lit("p"), "id").alias("full_name"))
    tables = hot["orders"], lines, hot["items"], customers, cities, people
    plans = []

    def seen(df, label):
        written = materialize(df, label)
        if label == "picked":
            plans.append(_final_plan(df))
        return written

    monkeypatch.setattr(subqueries, "materialize", seen)
    nested, chained = subqueries.top_item_cities_nested(*tables), subqueries.top_item_cities(*tables)
    assert len(plans) == 2 and all("skew=true" in plan for plan in plans)
    wanted = lines.join(lines.filter("item_id >= 47").select("order_id").distinct(), "order_id")
    expected = (
        wanted.join(hot["orders"], "order_id").join(customers, "customer_id").select("city_id", "picker_id").distinct()
        .join(cities, "city_id").join(people.toDF("picker_id", "name"), "picker_id", "left")
        .select("city_id", "city_name", F.coalesce("name", F.lit("--")).alias("picker"))
    )
    assert same(nested, expected) and same(chained, expected)


def test_total_of_a_customer_with_many_orders(hot, monkeypatch):
    expected = (
        hot["orders"].filter("customer_id = 1").join(hot["lines"], "order_id")
        .agg(F.sum(F.col("unit_price") * F.col("quantity"))).first()[0]
    )
    assert hot["orders"].filter("customer_id = 1").count() > joins.LISTED_KEYS
    assert parameters.customer_total(hot["orders"], hot["lines"], 1).first()[0] == expected
    monkeypatch.setattr(joins, "LISTED_KEYS", 1_000_000)
    by_value = parameters.customer_total(hot["orders"], hot["lines"], 1)
    assert "Join" not in physical_plan(by_value) and by_value.first()[0] == expected


def test_hot_order_sums_before_the_shuffle(hot):
    df = sales.monthly_sales(hot["orders"], hot["lines"])
    assert "partial_sum" in physical_plan(df)
    total = hot["lines"].agg(F.sum(F.col("unit_price") * F.col("quantity"))).first()[0]
    assert df.agg(F.sum("total_amount")).first()[0] == total


def test_large_invoices_without_salesperson_stay(spark, hot):
    people = spark.createDataFrame([(0, "zero")], "person_id bigint, full_name string")
    orders = hot["orders"].withColumn("picking_completed", F.lit(None).cast("date"))
    lines = hot["lines"].withColumn("picked_quantity", F.col("quantity")).filter("salesperson_id <> 0")
    found = subqueries.large_invoices_picked(orders, lines, people, 1)
    assert found.filter("salesperson_name IS NOT NULL OR picked_amount IS NOT NULL").isEmpty()
    assert ordered(found.select("invoice_id")) == ordered(
        lines.groupBy("order_id").agg(F.sum(F.col("unit_price") * F.col("quantity")).alias("a")).filter("a > 1").select("order_id")
    )


def test_not_exists_sees_each_salesperson_once(spark, folder, no_broadcast):
    plan = physical_plan(run("idle_salespeople_exists", spark, folder))
    assert "LeftAnti" in plan and "HashAggregate(keys=[salesperson_id" in plan


@pytest.mark.parametrize(
    "name",
    ["running_total_by_month", "running_total_self_join", "big_months_zero_filled", "slow_items_by_month_zero_filled"],
)
def test_report_and_totals_read_one_join(spark, folder, name):
    """The join of the lines was written while the query was built; what is left reads its rows."""
    assert "lineitem.parquet" not in physical_plan(run(name, spark, folder))


def test_lookups_read_no_more_than_they_need(spark, folder):
    plan = physical_plan(run("customer_total_param", spark, folder))
    assert "SortMergeJoin" not in plan and "hashpartitioning(order_id" not in plan
    assert "orders.parquet" not in physical_plan(run("suppliers_without_orders", spark, folder))


def test_int_total_overflows(spark):
    make = spark.createDataFrame
    customers = make([(1, "a")], "customer_id long, customer_name string")
    orders = make([(5, 1)], "order_id long, customer_id long")
    lines = make([(5, Decimal("3000000000.00"), 1)], "order_id long, unit_price decimal(18,2), quantity int")
    with pytest.raises(ArithmeticException):
        parameters.customer_totals_int(customers, orders, lines).collect()
