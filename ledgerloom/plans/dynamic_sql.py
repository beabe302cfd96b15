"""Queries whose text or parameters are made by SQL itself: session variables and EXECUTE IMMEDIATE."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.operators.reshaping import cell_counts
from ledgerloom.plans.crosstabs import orders_by_month


@contextmanager
def _names(spark: SparkSession, variable_type: str, **views: DataFrame) -> Iterator[dict[str, str]]:
    """A session variable and temporary views under names of their own; taken away when the query is analysed."""
    names = {n: f"{n}_{uuid.uuid4().hex}" for n in ("value", *views)}
    for name, df in views.items():
        df.createOrReplaceTempView(names[name])
    spark.sql(f"DECLARE VARIABLE {names['value']} {variable_type}")
    try:
        yield names
    finally:
        spark.sql(f"DROP TEMPORARY VARIABLE {names['value']}")
        for name in views:
            spark.catalog.dropTempView(names[name])


def min_price_items_sql(items: DataFrame) -> DataFrame:
    """Items at the lowest price: the price goes into a variable, and from there into a statement with a parameter."""
    spark = items.sparkSession
    with _names(spark, "DECIMAL(18,2)", items=items) as n:
        spark.sql(f"SET VARIABLE {n['value']} = (SELECT min(unit_price) FROM {n['items']})")
        return spark.sql(
            f"EXECUTE IMMEDIATE 'SELECT item_id, item_name, unit_price FROM {n['items']} WHERE unit_price = ?' USING {n['value']}"
        )


def pivot_dynamic_sql(orders: DataFrame, customers: DataFrame, key: str) -> DataFrame:
    """Orders per month with a column for each name in the data; SQL writes the pivot's text from the names.

    Names are quoted in both places where they are spliced in, as text and as column. Counts per month and name are
    written first, so names and cells come from one small table.
    """
    spark = orders.sparkSession
    cells = cell_counts(orders_by_month(orders, customers, key), "month", "key", "order_id")
    with _names(spark, "STRING", cells=cells) as n:
        # a quote and a backslash inside a name are escaped in the text of the statement
        quote = r"replace(replace(folded, '\\', '\\\\'), '\'', '\\\'')"
        tick = "replace(name, '`', '``')"
        spark.sql(rf"""
            SET VARIABLE {n['value']} = (
              SELECT concat(
                'SELECT date_format(month, "dd.MM.yyyy") AS invoice_month',
                coalesce(listagg(concat(', coalesce(`', {tick}, '`, 0) AS `', {tick}, '`')) WITHIN GROUP (ORDER BY folded), ''),
                ' FROM (SELECT month, folded, cells FROM {n['cells']}) PIVOT (sum(cells) FOR folded IN (',
                coalesce(listagg(concat("'", {quote}, "' AS `", {tick}, '`'), ', ') WITHIN GROUP (ORDER BY folded), "'' AS `_`"),
                ')) ORDER BY month')
              FROM (SELECT folded, min(name) AS name FROM {n['cells']} WHERE name IS NOT NULL GROUP BY folded))
            """)
        return spark.sql(f"EXECUTE IMMEDIATE {n['value']}")
