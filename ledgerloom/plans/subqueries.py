"""Queries that ask about other rows: existence, extremes, lookups and sums per order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.joins import distinct_keys, keep_absent
from ledgerloom.operators.topk import top, top_with_ties
from ledgerloom.plans.sales import line_amount
from ledgerloom.sources.workspace import materialize


def idle_salespeople(people: DataFrame, sales: DataFrame, day: str) -> DataFrame:
    """Salespeople without a sale on a day, as an anti-join."""
    that_day = sales.filter(F.col("order_date") == F.lit(day).cast("date")).select(
        F.col("salesperson_id").alias("person_id")
    )
    return keep_absent(people.filter("is_salesperson"), that_day, ["person_id"]).select(
        "person_id", "full_name"
    )


def idle_salespeople_not_exists(people: DataFrame, sales: DataFrame, day: str) -> DataFrame:
    """The same, as a correlated NOT EXISTS over the day's salespeople, once each.

    The right side of an anti-join cannot be split, so a busy salesperson's sales are one row before it.
    """
    that_day = distinct_keys(sales.filter(F.col("order_date") == F.lit(day).cast("date")), "salesperson_id")
    return people.sparkSession.sql(
        """
        SELECT person_id, full_name FROM {people} AS p
        WHERE is_salesperson AND NOT EXISTS (
            SELECT 1 FROM {that_day} AS s WHERE s.salesperson_id = p.person_id)
        """,
        people=people,
        that_day=that_day,
    )


_ITEM = ["item_id", "item_name", "unit_price"]


def min_price_items(items: DataFrame) -> DataFrame:
    """All items at the lowest price, which is computed once and then a constant of the filter."""
    lowest = items.agg(F.min("unit_price")).scalar()
    return items.filter(F.col("unit_price") == lowest).select(*_ITEM)


def min_price_join(items: DataFrame) -> DataFrame:
    """The same as a join to the one-row aggregate."""
    lowest = items.agg(F.min("unit_price")).toDF("unit_price")
    return items.join(F.broadcast(lowest), "unit_price").select(*_ITEM)


def min_price_one(items: DataFrame) -> DataFrame:
    return top(items.select(*_ITEM), 1, F.col("unit_price"), F.col("item_id"))


def _largest_payments(payments: DataFrame, n: int) -> DataFrame:
    rows = payments.select("customer_id", "paid_amount", "order_id")
    return top(rows, n, F.col("paid_amount").desc(), F.col("order_id")).select("customer_id")


def top_payers_in(customers: DataFrame, payments: DataFrame, n: int = 5) -> DataFrame:
    """Customers behind the largest payments; several payments of one customer give one row."""
    return customers.join(_largest_payments(payments, n), "customer_id", "left_semi").select(
        "customer_id", "customer_name"
    )


def top_payers_join(customers: DataFrame, payments: DataFrame, n: int = 5) -> DataFrame:
    return (
        _largest_payments(payments, n)
        .join(customers, "customer_id")
        .select("customer_id", "customer_name")
        .distinct()
    )


def top_item_cities(
    orders: DataFrame, lines: DataFrame, items: DataFrame, customers: DataFrame, cities: DataFrame,
    people: DataFrame, n: int = 3,
) -> DataFrame:
    """Cities that were sent one of the dearest items, and who picked the orders ('--' if nobody).

    The orders concerned are written first: their size is then known, so the lines are not shuffled
    to meet a small set. Their lines are written next: removing duplicates by the join's own key in one
    stage would keep a hot order from being split. Duplicates go before each further join.
    """
    dearest = top_with_ties(items, n, "unit_price")
    orders_with = materialize(
        distinct_keys(lines.join(dearest, "item_id", "left_semi"), "order_id"), "orders"
    )
    picked = materialize(picked_lines(lines, orders_with), "picked")
    picks = (
        picked.distinct()
        .join(orders.select("order_id", "customer_id"), "order_id")
        .select("customer_id", "picker_id")
        .distinct()
    )
    places = picks.join(customers, "customer_id").select("city_id", "picker_id").distinct()
    return _named_places(places, cities, people)


def picked_lines(lines: DataFrame, orders_with: DataFrame) -> DataFrame:
    """Order and picker of the lines of ``orders_with``, a written table, so that a hot order can be split."""
    return lines.join(orders_with, "order_id", "left_semi").select("order_id", "picker_id")


def _named_places(places: DataFrame, cities: DataFrame, people: DataFrame) -> DataFrame:
    pickers = people.select(F.col("person_id").alias("picker_id"), "full_name")
    return (
        places.join(cities, "city_id")
        .join(pickers, "picker_id", "left")
        .select("city_id", "city_name", F.coalesce("full_name", F.lit("--")).alias("picker"))
    )


def top_item_cities_nested(
    orders: DataFrame, lines: DataFrame, items: DataFrame, customers: DataFrame, cities: DataFrame,
    people: DataFrame, n: int = 3,
) -> DataFrame:
    """The same as nested IN subqueries; the n-th price is the lowest of the n first.

    The inner list of orders and their lines are written, as above: one statement would put the IN list and the
    join with the orders into one stage by the same key, where a hot order stays in one task.
    """
    spark = people.sparkSession
    orders_with = spark.sql(
        """
        SELECT DISTINCT order_id FROM {lines}
        WHERE item_id IN (
            SELECT item_id FROM {items}
            WHERE unit_price >= (
                SELECT min(unit_price) FROM (
                    SELECT unit_price FROM {items} ORDER BY unit_price DESC LIMIT :n)))
        """,
        args={"n": n}, lines=lines, items=items,
    )
    picked = spark.sql(
        "SELECT order_id, picker_id FROM {lines} WHERE order_id IN (SELECT order_id FROM {orders_with})",
        lines=lines, orders_with=materialize(orders_with.dropna(), "orders"),
    )
    return spark.sql(
        """
        SELECT cp.city_id, c.city_name, coalesce(p.full_name, '--') AS picker
        FROM (
            SELECT DISTINCT cu.city_id, s.picker_id
            FROM (SELECT DISTINCT order_id, picker_id FROM {picked}) AS s
            JOIN {orders} AS o ON o.order_id = s.order_id
            JOIN {customers} AS cu ON cu.customer_id = o.customer_id
        ) AS cp
        JOIN {cities} AS c ON c.city_id = cp.city_id
        LEFT JOIN {people} AS p ON p.person_id = cp.picker_id
        """,
        picked=materialize(picked, "picked"),
        orders=orders, customers=customers, cities=cities, people=people,
    )


def large_invoices_picked(orders: DataFrame, lines: DataFrame, people: DataFrame, above: float) -> DataFrame:
    """Orders over an amount, with salesperson, amount and the amount picked.

    The lookups and the sum over picked lines were correlated subqueries, one inside another; one
    aggregation by order gives both sums. An order whose picking is not complete has no picked sum.
    """
    totals = (
        lines.groupBy("order_id")
        .agg(
            F.sum(line_amount()).alias("total_amount"),
            F.sum(F.col("unit_price") * F.col("picked_quantity")).alias("_picked"),
            F.min("salesperson_id").alias("person_id"),
        )
        .filter(F.col("total_amount") > above)
    )
    return (
        totals.join(orders, "order_id")
        .join(people.select("person_id", "full_name"), "person_id", "left")
        .select(
            F.col("order_id").alias("invoice_id"),
            F.col("order_date").alias("invoice_date"),
            F.col("full_name").alias("salesperson_name"),
            "total_amount",
            F.when(F.col("picking_completed").isNotNull(), F.col("_picked")).alias("picked_amount"),
        )
        .orderBy(F.col("total_amount").desc(), "invoice_id")
    )
