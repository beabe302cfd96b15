"""Running totals and rankings."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import dates, text
from ledgerloom.operators.positions import Neighbour, tile, with_neighbours, with_position
from ledgerloom.operators.running import running_by_self_join, running_by_window
from ledgerloom.operators.topk import first_per_group, nth_highest, reaches
from ledgerloom.plans.sales import line_amount
from ledgerloom.sources.layouts import BucketedFacts
from ledgerloom.sources.workspace import materialize


def _invoices(orders: DataFrame, lines: DataFrame, since: str) -> DataFrame:
    amounts = lines.groupBy("order_id").agg(F.sum(line_amount()).alias("amount"))
    recent = orders.filter(F.col("order_date") >= F.lit(since).cast("date"))
    return amounts.join(recent.select("order_id", "customer_id", "order_date"), "order_id")


def _running_total(
    invoices: DataFrame, customers: DataFrame, accumulate: Callable[[DataFrame, str, str, str], DataFrame]
) -> DataFrame:
    # read by the monthly sums and by the report: written once, so that the lines are joined once
    invoices = materialize(invoices.withColumn("month", dates.month_end(F.col("order_date"))), "invoices")
    months = invoices.groupBy("month").agg(F.sum("amount").alias("month_amount"))
    running = accumulate(months, "month", "month_amount", "running_amount")
    return (
        # one row per calendar month, so its size does not follow the data
        invoices.join(F.broadcast(running), "month")
        .join(customers.select("customer_id", "customer_name"), "customer_id")
        .select(
            F.col("order_id").alias("invoice_id"),
            "customer_name",
            F.col("order_date").alias("invoice_date"),
            F.col("amount").alias("invoice_amount"),
            "running_amount",
        )
        .orderBy("invoice_id")
    )


def running_total_by_month(orders: DataFrame, lines: DataFrame, customers: DataFrame, since: str) -> DataFrame:
    """Every invoice with the sales of all months up to and including its own.

    All rows of a month share a value, so the window runs over one row per month.
    """
    return _running_total(_invoices(orders, lines, since), customers, running_by_window)


def running_total_bucketed(facts: BucketedFacts, customers: DataFrame, since: str) -> DataFrame:
    """The same from facts bucketed by order, which are joined without a shuffle."""
    parts = (_invoices(orders, lines, since) for orders, lines in facts.parts())
    return _running_total(reduce(DataFrame.unionByName, parts), customers, running_by_window)


def running_total_self_join(orders: DataFrame, lines: DataFrame, customers: DataFrame, since: str) -> DataFrame:
    """The same without a window function."""
    return _running_total(_invoices(orders, lines, since), customers, running_by_self_join)


def top_items_per_month(
    orders: DataFrame, lines: DataFrame, items: DataFrame, first_day: str, last_day: str, n: int = 2
) -> DataFrame:
    """The most sold item names of each month, by quantity."""
    period = orders.filter(
        F.col("order_date").between(F.lit(first_day).cast("date"), F.lit(last_day).cast("date"))
    ).select("order_id", dates.month_end(F.col("order_date")).alias("month_end"))
    sold = (
        lines.join(period, "order_id")
        .groupBy("month_end", "item_id")
        .agg(F.sum("quantity").alias("quantity"))
        .join(items.select("item_id", "item_name"), "item_id")
        .groupBy("month_end", F.lower("item_name").alias("_name"))
        .agg(F.sum("quantity").alias("quantity"), text.first_spelling(F.col("item_name")).alias("item_name"))
    )
    best = first_per_group(sold, n, ["month_end"], F.col("quantity").desc(), F.col("_name"))
    return best.orderBy("month_end", "_row").select("month_end", "quantity", "item_name")


def item_window_profile(items: DataFrame, tiles: int = 30) -> DataFrame:
    """Items by name: number within the first letter, counts, neighbours and a weight tile.

    Names sort without regard to case, so a letter is one stretch of the order: the number within
    a letter is the position less the letter's first position.
    """
    by_name = [F.lower("item_name"), F.col("item_name"), F.col("item_id")]
    by_weight = [F.col("weight"), F.col("item_id")]
    rows = items.select("item_id", "item_name", "brand", "unit_price", "weight", "outer_quantity")
    named = with_position(rows, by_name, "_place").withColumn(
        "_letter", text.first_letter(F.col("item_name"))
    )
    # one row per first character: at most the number of Unicode characters
    letters = named.groupBy("_letter").agg(
        F.min("_place").alias("_first"), F.count("outer_quantity").alias("letter_stock")
    )
    with_names = with_neighbours(
        named,
        "_place",
        [
            Neighbour("next_item_id", "item_id", 1),
            Neighbour("previous_item_id", "item_id", -1),
            Neighbour("item_name_two_before", "item_name", -2, "No items"),
        ],
    )
    weighed = with_position(with_names, by_weight, "_weight_place", "_rows")
    return (
        weighed.join(
            F.broadcast(letters), F.equal_null(weighed["_letter"], letters["_letter"])
        )
        .select(
            "item_id",
            "item_name",
            "brand",
            "unit_price",
            (F.col("_place") - F.col("_first") + 1).alias("row_in_letter"),
            items.agg(F.count("outer_quantity")).scalar().alias("stock"),
            "letter_stock",
            "next_item_id",
            "previous_item_id",
            "item_name_two_before",
            tile(F.col("_weight_place"), F.col("_rows"), tiles).alias("weight_group"),
            "_place",
        )
        .orderBy("_place")
        .drop("_place")
    )


def last_customer_per_salesperson(
    orders: DataFrame, lines: DataFrame, customers: DataFrame, people: DataFrame
) -> DataFrame:
    """The latest invoice of each salesperson, with its customer and amount.

    The latest date and, within it, the highest order are maxima over plain columns, so hash
    aggregation reduces a busy salesperson to one row per date before any shuffle. The result, one
    row per salesperson, is written; amounts are summed only for its orders. Their lines are written
    too: summing by the join's own key in one stage would keep a hot order from being split.
    """
    dated = lines.select("order_id", "salesperson_id").join(
        orders.select("order_id", "customer_id", "order_date"), "order_id"
    )
    latest = materialize(
        dated.groupBy("salesperson_id", "order_date")
        .agg(F.max("order_id").alias("order_id"), F.max_by("customer_id", "order_id").alias("customer_id"))
        .groupBy("salesperson_id")
        .agg(
            F.max("order_date").alias("order_date"),
            F.max_by("order_id", "order_date").alias("order_id"),
            F.max_by("customer_id", "order_date").alias("customer_id"),
        ),
        "latest",
    )
    found = materialize(
        lines.join(latest, "order_id", "left_semi").select("order_id", "unit_price", "quantity"), "found"
    )
    amounts = found.groupBy("order_id").agg(F.sum(line_amount()).alias("invoice_amount"))
    return (
        latest.join(amounts, "order_id")
        .join(customers.select("customer_id", "customer_name"), "customer_id")
        .join(people.select("person_id", "full_name"), F.col("person_id") == F.col("salesperson_id"))
        .select(
            "person_id",
            "full_name",
            "customer_id",
            "customer_name",
            F.col("order_date").alias("invoice_date"),
            "invoice_amount",
        )
    )


def _purchases(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Distinct (customer, item, price, date): what both queries below output.

    Written once, because the rank and the result each read it and would join all lines again.
    """
    bought = (
        lines.select("order_id", "item_id", "unit_price")
        .join(orders.select("order_id", "customer_id", "order_date"), "order_id")
        .select("customer_id", "item_id", "unit_price", F.col("order_date").alias("invoice_date"))
        .distinct()
    )
    return materialize(bought, "purchases")


_PURCHASE = ["customer_id", "customer_name", "item_id", "unit_price", "invoice_date"]


def dearest_items_by_price(orders: DataFrame, lines: DataFrame, customers: DataFrame, n: int = 2) -> DataFrame:
    """What each customer bought at their n highest prices (a dense rank).

    The n-th distinct price per customer is found first; a rank over all purchases of one large
    customer would run in one task. Names join these prices, one row per customer each, and the
    outcome is written: the purchases then meet a customer key once, in a join that can split it.
    """
    bought = _purchases(orders, lines)
    prices = bought.select("customer_id", "unit_price").distinct()
    edges = nth_highest(prices, n, ["customer_id"], "unit_price")
    named = materialize(
        edges.join(customers.select("customer_id", "customer_name"), "customer_id"), "edges"
    )
    return (
        bought.join(named, "customer_id")
        .filter(reaches("unit_price"))
        .select(*_PURCHASE)
        .orderBy("customer_id", "item_id", "unit_price", "invoice_date")
    )


def dearest_items_by_rank(orders: DataFrame, lines: DataFrame, customers: DataFrame, n: int = 2) -> DataFrame:
    """All purchases of the n dearest items of each customer, ties included, at any price."""
    bought = _purchases(orders, lines)
    priced = bought.select("customer_id", "item_id", "unit_price").distinct()
    edges = materialize(nth_highest(priced, n, ["customer_id"], "unit_price", ["item_id"]), "edges")
    chosen = priced.join(edges, "customer_id").filter(reaches("unit_price"))
    return (
        bought.join(chosen, ["customer_id", "item_id"], "left_semi")
        .join(customers.select("customer_id", "customer_name"), "customer_id")
        .select(*_PURCHASE)
        .orderBy("customer_id", "unit_price", "item_id", "invoice_date")
    )
