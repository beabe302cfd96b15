"""Pivots by month, unpivots, and the written forms of dates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import dates, text
from ledgerloom.operators.reshaping import (
    distinct_names,
    named,
    pivot_count,
    pivot_count_discovered,
    unpivot_as_text,
    unpivot_present,
)


def orders_by_month(orders: DataFrame, customers: DataFrame, key: Column | str) -> DataFrame:
    """(month, key, order_id) of every order, with something of its customer as the key."""
    key = F.col(key) if isinstance(key, str) else key
    return orders.join(customers, "customer_id").select(
        dates.month_start(F.col("order_date")).alias("month"), key.alias("key"), "order_id"
    )


def _dotted_months(counts: DataFrame) -> DataFrame:
    columns = [named(c) for c in counts.columns if c != "month"]
    return counts.orderBy("month").select(
        dates.dotted_date(F.col("month")).alias("invoice_month"), *columns
    )


def pivot_customers_by_month(orders: DataFrame, stores: DataFrame, places: Sequence[str]) -> DataFrame:
    """Number of orders per month, one column per place in the customers' names."""
    place = text.inside_parentheses(F.col("customer_name"))
    by_month = orders_by_month(orders, stores, place)
    return _dotted_months(pivot_count(by_month, "month", "key", "order_id", places))


def pivot_dynamic(orders: DataFrame, customers: DataFrame, key: str) -> DataFrame:
    """The same with one column per value found in the data, in order."""
    by_month = orders_by_month(orders, customers, key)
    return _dotted_months(pivot_count_discovered(by_month, "month", "key", "order_id"))


def pivot_column_list(orders: DataFrame, customers: DataFrame, key: str) -> DataFrame:
    """The columns that pivot would have, as one comma-separated text."""
    bought = customers.join(orders.select("customer_id").distinct(), "customer_id", "left_semi")
    names = distinct_names(bought, key).select(F.struct(F.lower(key).alias("k"), F.col(key).alias("v")).alias("name"))
    ordered = F.transform(F.array_sort(F.collect_list("name")), lambda name: name["v"])
    return names.agg(F.array_join(ordered, ", ").alias("column_list"))


def text_in_parentheses(stores: DataFrame) -> DataFrame:
    name = F.col("customer_name")
    return stores.select("customer_id", name, text.inside_parentheses(name).alias("place"))


def unpivot_addresses(customers: DataFrame, name_contains: str, address_columns: Sequence[str]) -> DataFrame:
    """The address lines of matching customers in one column; empty lines are left out."""
    matching = customers.filter(text.contains_text(F.col("customer_name"), name_contains))
    lines = unpivot_present(matching, ["customer_name"], address_columns, "address_line")
    return lines.select("customer_name", "address_line").orderBy(F.lower("customer_name"), "customer_name", "address_line")


def unpivot_codes(rows: DataFrame, ids: Sequence[str], codes: dict[str, Column]) -> DataFrame:
    """A numeric and a text code of each row, in one column."""
    return unpivot_as_text(rows, ids, codes, "code").select(*ids, "code")


def date_parts(orders: DataFrame) -> DataFrame:
    """Every order date once, in all its written forms."""
    day = F.col("order_date")
    return orders.select(day).distinct().select(
        day,
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.quarter(day).alias("quarter"),
        dates.third_of_year(day).alias("third_of_year"),
        dates.month_name_en(day).alias("month_name_en"),
        dates.month_name_ru(day).alias("month_name_ru"),
        dates.long_date_ru(day).alias("long_date_ru"),
        dates.long_date_en(day).alias("long_date_en"),
        dates.dotted_date(day).alias("dotted_date"),
        dates.month_start(day).alias("month_start"),
        dates.month_end(day).alias("month_end"),
    )
