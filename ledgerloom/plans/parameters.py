"""Query functions with parameters, and their use per row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.text import sort_list
from ledgerloom.operators.joins import listed
from ledgerloom.operators.topk import top
from ledgerloom.plans.sales import line_amount
from ledgerloom.sources.tables import literal_rows
from ledgerloom.sources.workspace import materialize


def best_customer(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """The customer of the largest order."""
    amounts = lines.groupBy("order_id").agg(F.sum(line_amount()).alias("amount"))
    largest = top(amounts, 1, F.col("amount").desc(), F.col("order_id"))
    return orders.join(largest, "order_id").select("customer_id")


def customer_total(orders: DataFrame, lines: DataFrame, customer_id: int) -> DataFrame:
    """What one customer bought in total: one row, NULL if nothing."""
    own = orders.filter(F.col("customer_id") == customer_id).select("order_id")
    few = listed(own)
    if few is None:
        # written first: the orders' real size is known then, and the lines need no shuffle to meet a small set
        bought = lines.join(materialize(own, "own-orders"), "order_id", "left_semi")
    else:
        bought = lines.filter(F.col("order_id").isin(few)) if few else lines.limit(0)
    return bought.agg(F.sum(line_amount()).alias("total"))


def customer_totals(customers: DataFrame, orders: DataFrame, lines: DataFrame) -> DataFrame:
    """The same for every customer; those without orders stay, with NULL."""
    totals = (
        lines.groupBy("order_id")
        .agg(F.sum(line_amount()).alias("amount"))
        .join(orders.select("order_id", "customer_id"), "order_id")
        .groupBy("customer_id")
        .agg(F.sum("amount").alias("total"))
    )
    return customers.join(totals, "customer_id", "left").select("customer_id", "customer_name", "total")


def customer_totals_int(customers: DataFrame, orders: DataFrame, lines: DataFrame) -> DataFrame:
    """The same returned as INT: the fraction is cut off, a total beyond INT is an error."""
    totals = customer_totals(customers, orders, lines)
    return totals.select("customer_id", F.col("total").cast("int").alias("total"))


def register_functions(spark: SparkSession, orders: DataFrame, lines: DataFrame) -> None:
    """The query functions as SQL functions, over the given tables.

    ``best_customer()``, ``customer_total_int(id)`` and the table function ``customer_sum(id)``.
    """
    orders.createOrReplaceTempView("ledgerloom_orders")
    lines.createOrReplaceTempView("ledgerloom_lines")
    amount = "sum(l.unit_price * l.quantity)"
    joined = "ledgerloom_orders AS o JOIN ledgerloom_lines AS l ON l.order_id = o.order_id"
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION best_customer() RETURNS BIGINT
        RETURN (SELECT o.customer_id FROM ledgerloom_orders AS o JOIN (
            SELECT l.order_id, {amount} AS amount FROM ledgerloom_lines AS l
            GROUP BY l.order_id ORDER BY amount DESC, l.order_id LIMIT 1) AS t
            ON t.order_id = o.order_id)
        """
    )
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION customer_total_int(id BIGINT) RETURNS INT
        RETURN (SELECT CAST({amount} AS INT) FROM {joined} WHERE o.customer_id = id)
        """
    )
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION customer_sum(id BIGINT) RETURNS TABLE (total DECIMAL(38,2))
        RETURN SELECT CAST({amount} AS DECIMAL(38,2)) FROM {joined} WHERE o.customer_id = id
        """
    )


def customer_totals_lateral(customers: DataFrame, orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Totals per customer by calling the table function for each row."""
    spark = customers.sparkSession
    register_functions(spark, orders, lines)
    return spark.sql(
        """
        SELECT c.customer_id, c.customer_name, s.total
        FROM {customers} AS c, LATERAL customer_sum(c.customer_id) AS s
        """,
        customers=customers,
    )


def item_words(items: DataFrame) -> DataFrame:
    """Each item's brand, kind and name words as a comma-separated list."""
    return items.select(
        "item_id", F.concat_ws(",", "brand", "kind", F.split("item_name", " ")).alias("data")
    )


# The example lists.
EXAMPLE_LISTS = [
    (-1, "apple,pear,orange,banana,grape,kiwi"),
    (-2, "pineapple,grape,banana,apple"),
    (-3, "apricot,pear,strawberry,banana"),
    (-4, "cherry,watermelon,orange,melon,grape"),
]


def lists_to_sort(items: DataFrame) -> DataFrame:
    """The words of every item, and the example lists under negative ids."""
    examples = literal_rows(items.sparkSession, EXAMPLE_LISTS, "item_id bigint, data string")
    return item_words(items).unionByName(examples)


def sorted_lists(rows: DataFrame, column: str, separator: str = ",") -> DataFrame:
    return rows.withColumn("sorted", sort_list(F.col(column), separator))
