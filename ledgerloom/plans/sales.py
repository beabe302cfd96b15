"""Monthly sales."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.calendar import months_from, with_empty_months
from ledgerloom.sources.layouts import BucketedFacts, MonthTable
from ledgerloom.sources.workspace import materialize


def line_amount() -> Column:
    return F.col("unit_price") * F.col("quantity")


def order_amounts(lines: DataFrame) -> DataFrame:
    """One row per order: its amount, the sum of its prices and its number of lines.

    Lines are summed by order before they meet the orders: the join then needs no shuffle of its
    own on this side and an order with very many lines arrives as one row.
    """
    return lines.groupBy("order_id").agg(
        F.sum(line_amount()).alias("amount"),
        F.sum("unit_price").alias("price_sum"),
        F.count("unit_price").alias("priced_lines"),
    )


def monthly_sales(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Average line price and total amount per month."""
    return _monthly_report(order_amounts(lines).join(orders.select("order_id", "order_date"), "order_id"))


def monthly_sales_bucketed(facts: BucketedFacts) -> DataFrame:
    """The same from facts bucketed by order: no line and no order is shuffled.

    Orders with very many lines are summed apart; both parts meet as one row per order.
    """
    parts = (
        order_amounts(lines).join(orders.select("order_id", "order_date"), "order_id") for orders, lines in facts.parts()
    )
    return _monthly_report(reduce(DataFrame.unionByName, parts))


def _monthly_report(amounts: DataFrame) -> DataFrame:
    return (
        amounts.groupBy(F.year("order_date").alias("year"), F.month("order_date").alias("month"))
        .agg(
            (F.sum("price_sum").cast("double") / F.sum("priced_lines")).alias("average_price"),
            F.sum("amount").alias("total_amount"),
        )
        .orderBy("year", "month")
    )


def item_quantities(sales: MonthTable, first: str, last: str) -> DataFrame:
    """Quantity and amount of each item sold from one day to another, from the folders of those months only."""
    return (
        sales.between(first, last)
        .groupBy("item_id")
        .agg(F.sum("quantity").alias("quantity"), F.sum(line_amount()).alias("total_amount"))
        .orderBy("item_id")
    )


def quarter_sales(sales: MonthTable, quarter: int, first: str, last: str) -> DataFrame:
    """Sales per month of one quarter of every year from one day to another.

    The months come from a calendar, so which folders are read is known at run time only; the calendar has one
    row per month and is broadcast, and the scan takes its folders from it.
    """
    months = months_from(sales.spark, first, last).select(F.make_date("year", "month", F.lit(1)).alias("month"))
    wanted = months.filter(F.quarter("month") == quarter)
    return (
        sales.read()
        .join(F.broadcast(wanted), "month")
        .groupBy(F.year("month").alias("year"), F.month("month").alias("month"))
        .agg(F.sum(line_amount()).alias("total_amount"), F.count("*").alias("lines"))
        .orderBy("year", "month")
    )


def _month_totals(orders: DataFrame, lines: DataFrame) -> DataFrame:
    return (
        order_amounts(lines)
        .join(orders.select("order_id", "order_date"), "order_id")
        .groupBy(F.year("order_date").alias("year"), F.month("order_date").alias("month"))
        .agg(F.sum("amount").alias("total_amount"))
    )


def big_months(
    orders: DataFrame, lines: DataFrame, above: float, span: tuple[str, str] | None = None
) -> DataFrame:
    """Months that sold more than a limit; of a ``span`` of days also its months without sales, as zeros."""
    totals = _month_totals(orders, lines)
    if span is None:
        report = totals.filter(F.col("total_amount") > above)
    else:
        totals = materialize(totals, "month-totals")
        months = months_from(orders.sparkSession, *span)
        report = with_empty_months(totals.filter(F.col("total_amount") > above), months, totals, {"total_amount": 0})
    return report.orderBy("year", "month")


def slow_items_by_month(
    orders: DataFrame, lines: DataFrame, items: DataFrame, below: int = 50, span: tuple[str, str] | None = None
) -> DataFrame:
    """Items of which fewer than a number were sold in a month.

    A ``span`` of days adds one row of zeros, without an item, per month of it that sold nothing.
    """
    cells = (
        lines.select("order_id", "item_id", "quantity", line_amount().alias("amount"))
        .join(orders.select("order_id", "order_date"), "order_id")
        .groupBy(
            F.year("order_date").alias("year"), F.month("order_date").alias("month"), "item_id"
        )
        .agg(
            F.sum("amount").alias("total_amount"),
            F.sum("quantity").alias("total_quantity"),
            F.min("order_date").alias("first_sale"),
        )
    )
    if span is not None:
        cells = materialize(cells, "month-items")
    report = (
        cells.filter(F.col("total_quantity") < below)
        .join(items.select("item_id", "item_name"), "item_id")
        .select("year", "month", "item_id", "item_name", "total_amount", "total_quantity", "first_sale")
    )
    if span is not None:
        sold = cells.select("year", "month").distinct()
        months = months_from(orders.sparkSession, *span)
        report = with_empty_months(report, months, sold, {"total_amount": 0, "total_quantity": 0})
    return report.orderBy("year", "month", "item_id")
