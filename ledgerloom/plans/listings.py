"""Filtered listings of items, suppliers, orders and buyers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import dates, text
from ledgerloom.operators.joins import keep_absent
from ledgerloom.operators.topk import page, top


def item_name_search(items: DataFrame, contains: str, prefix: str) -> DataFrame:
    """Items whose name contains one text or starts with another."""
    name = F.col("item_name")
    return items.filter(
        text.contains_text(name, contains) | text.starts_with_text(name, prefix)
    ).select("item_id", "item_name")


def suppliers_without_orders(suppliers: DataFrame, purchases: DataFrame) -> DataFrame:
    return keep_absent(suppliers, purchases, ["supplier_id"]).select("supplier_id", "supplier_name")


def _calendar_rows(
    orders: DataFrame, lines: DataFrame, customers: DataFrame, min_price: float, min_quantity: int
) -> DataFrame:
    """One row per qualifying line (an order repeats), with a row number to spread equal keys.

    The row number is taken at the scan: without it all lines of one order would sort as equals
    and could not be divided over tasks.
    """
    qualifying = lines.filter(
        ((F.col("unit_price") > min_price) | (F.col("quantity") > min_quantity))
        & F.col("picking_completed").isNotNull()
    ).select("order_id", F.monotonically_increasing_id().alias("_line"))
    day = F.col("order_date")
    # customers meet the orders, so that the lines are shuffled once
    named = orders.select("order_id", "customer_id", "order_date").join(
        customers.select("customer_id", "customer_name"), "customer_id"
    )
    return (
        qualifying.join(named, "order_id")
        .select(
            "order_id",
            dates.dotted_date(day).alias("dd_mm_year"),
            dates.month_name_ru(day).alias("month_name"),
            F.quarter(day).alias("quarter"),
            dates.third_of_year(day).alias("third_of_year"),
            "customer_name",
            "order_date",
            "_line",
        )
    )


def order_calendar(
    orders: DataFrame, lines: DataFrame, customers: DataFrame, min_price: float = 100, min_quantity: int = 20
) -> DataFrame:
    """Orders with an expensive or large picked line, with the calendar parts of their date."""
    rows = _calendar_rows(orders, lines, customers, min_price, min_quantity)
    return rows.orderBy("quarter", "third_of_year", "order_date", "order_id", "_line").drop(
        "order_date", "_line"
    )


def order_calendar_page(
    orders: DataFrame,
    lines: DataFrame,
    customers: DataFrame,
    skip: int = 1000,
    fetch: int = 100,
    min_price: float = 100,
    min_quantity: int = 20,
) -> DataFrame:
    """One page of the same listing."""
    rows = _calendar_rows(orders, lines, customers, min_price, min_quantity)
    leading = ["quarter", "third_of_year", "order_date"]
    return page(rows, skip, fetch, leading, ["order_id", "_line"]).drop("order_date", "_line")


def purchase_delivery(
    suppliers: DataFrame,
    purchases: DataFrame,
    contacts: DataFrame,
    methods: DataFrame,
    first_day: str,
    last_day: str,
    method_names: Sequence[str],
) -> DataFrame:
    """Finalized purchases due in a period and delivered by one of some methods.

    The method is the supplier's, so suppliers are cut down before the purchases are joined.
    """
    due = purchases.filter(
        F.col("is_finalized") & F.col("expected_date").between(F.lit(first_day).cast("date"), F.lit(last_day).cast("date"))
    )
    wanted = methods.filter(F.lower("method_name").isin(*(m.lower() for m in method_names)))
    return (
        due.join(suppliers.join(wanted, "method_id"), "supplier_id")
        .join(contacts.withColumnRenamed("person_id", "contact_id"), "contact_id")
        .select(
            "method_name",
            "expected_date",
            "supplier_name",
            F.col("full_name").alias("contact_name"),
        )
    )


def latest_sales(orders: DataFrame, lines: DataFrame, customers: DataFrame, people: DataFrame, n: int = 10) -> DataFrame:
    """The latest sales, with customer and salesperson.

    Customers meet the orders first: the lines are then shuffled once by order, not by customer too.
    """
    bought = orders.select("order_id", "order_date", "customer_id").join(
        customers.select("customer_id", "customer_name"), "customer_id"
    )
    named = (
        lines.select("order_id", "line_number", "salesperson_id")
        .join(bought, "order_id")
        .join(
            people.select(F.col("person_id").alias("salesperson_id"), "full_name"), "salesperson_id"
        )
    )
    order = [F.col("order_date").desc(), *map(F.col, ("order_id", "line_number", "salesperson_id"))]
    return top(named, n, *order).select(
        F.col("order_id").alias("invoice_id"),
        F.col("order_date").alias("invoice_date"),
        "customer_name",
        "full_name",
    )


def buyers_of_item(
    orders: DataFrame, lines: DataFrame, items: DataFrame, customers: DataFrame, item_name: str
) -> DataFrame:
    """Customers who bought an item, once each.

    A best seller is split where lines meet items; after that only distinct orders and customers go on.
    """
    wanted = items.filter(text.same_text(F.col("item_name"), item_name)).select("item_id", "item_name")
    bought = lines.join(wanted, "item_id").groupBy("order_id").agg(text.first_spelling(F.col("item_name")).alias("item_name"))
    buyers = (
        bought.join(orders.select("order_id", "customer_id"), "order_id")
        .groupBy("customer_id")
        .agg(text.first_spelling(F.col("item_name")).alias("item_name"))
    )
    return customers.join(buyers, "customer_id").select(
        "customer_id", "customer_name", "segment", "item_name"
    )
