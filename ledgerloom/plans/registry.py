"""Every query by name, bound to the star-schema tables with its parameters."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DateType, DecimalType, IntegerType, ShortType, TimestampNTZType

from ledgerloom.plans import (
    changes,
    constraints,
    crosstabs,
    documents,
    dynamic_sql,
    listings,
    parameters,
    ranking,
    sales,
    subqueries,
    upkept,
)
from ledgerloom.sources.catalog import Catalog
from ledgerloom.sources.layouts import bucket_facts, write_by_month
from ledgerloom.sources.workspace import materialize

SINCE = "1998-01-01"
# longer than the data, so that its first and last months have no sales
SPAN = ("1990-01-01", "2003-12-31")
PLACES = ["NATION_2", "NATION_7", "NATION_22", "NATION_12", "NATION_17"]


def _item_kinds(c: Catalog) -> DataFrame:
    """Items as named records with two address-like columns, one of them often empty."""
    return c.items.select(
        F.col("item_name").alias("customer_name"),
        F.col("brand").alias("address_line_1"),
        F.nullif(F.col("kind"), F.lit("PROMO")).alias("address_line_2"),
    )


def _with_new_suppliers(c: Catalog) -> DataFrame:
    """All suppliers, and some more that nothing has been ordered from yet."""
    new = c.suppliers.filter(F.col("supplier_id") % 10 == 0).withColumns(
        {
            "supplier_id": F.col("supplier_id") + 1_000_000_000,
            "supplier_name": F.concat("supplier_name", F.lit(" (new)")),
        }
    )
    return c.suppliers.unionByName(new)


def _half_in_capitals(df: DataFrame, name: str, key: str) -> DataFrame:
    """The rows with every other name in capitals."""
    return df.withColumn(name, F.when(F.col(key) % 2 == 0, F.upper(name)).otherwise(F.col(name)))


def _half_in_small_letters(df: DataFrame, name: str, key: str) -> DataFrame:
    return df.withColumn(name, F.when(F.col(key) % 2 == 0, F.lower(name)).otherwise(F.col(name)))


def _sales_by_month(c: Catalog):
    rows = c.sales.select("order_id", "item_id", "quantity", "unit_price", "order_date")
    return write_by_month(rows, "order_date")


def _plain_orders(c: Catalog) -> DataFrame:
    return c.orders.select("order_id", "customer_id", "order_date", "priority", "paid_amount")


def _merge_customers(c: Catalog):
    return changes.merge_scratch(changes.changed_customers(c.customers))


def _merge_items(c: Catalog):
    incoming = documents.price_list(c.stock_items, 13)
    return documents.merge_items(c.stock_items, documents.xml_items_source(incoming))


def _shop_with_sales_table(c: Catalog) -> constraints.Shop:
    """The shop with its sales, here a join, as the table they would be."""
    shop = constraints.shop_from(c)
    keys = shop.sales.select("id_sales", "id_service", "id_client", "id_employee")
    return replace(shop, sales=materialize(keys, "sales"))


def _defaults_applied(c: Catalog) -> DataFrame:
    """The sales as stored; a date from the clock shows as a flag, so that runs agree."""
    filled = constraints.sales_with_defaults(constraints.shop_from(c))
    by_clock = F.col("date_created") >= F.lit("2020-01-01 00:00:00").cast("timestamp_ntz")
    return filled.withColumn("defaulted", by_clock).withColumn(
        "date_created", F.when(~by_clock, F.col("date_created"))
    )


QUERIES: dict[str, Callable[[Catalog], DataFrame]] = {
    # listings
    "item_name_search": lambda c: listings.item_name_search(c.items, "RING", "Small"),
    "suppliers_without_orders": lambda c: listings.suppliers_without_orders(_with_new_suppliers(c), c.supplied),
    "order_calendar": lambda c: listings.order_calendar(c.orders, c.lines, c.customers, 90_000, 45),
    "order_calendar_page": lambda c: listings.order_calendar_page(c.orders, c.lines, c.customers),
    "purchase_delivery": lambda c: listings.purchase_delivery(
        c.suppliers, c.purchases, c.contacts, c.delivery_methods,
        "1998-01-01", "1998-01-31", ["ASIA", "EUROPE"],
    ),
    "latest_sales": lambda c: listings.latest_sales(c.orders, c.lines, c.customers, c.people),
    "buyers_of_item": lambda c: listings.buyers_of_item(
        c.orders, c.lines, _half_in_capitals(c.items, "item_name", "item_id"), c.customers, "Blue BOLT"
    ),
    # monthly sales
    "monthly_sales": lambda c: sales.monthly_sales(c.orders, c.lines),
    "big_months": lambda c: sales.big_months(c.orders, c.lines, 1_050_000_000),
    "big_months_zero_filled": lambda c: sales.big_months(c.orders, c.lines, 1_050_000_000, SPAN),
    "slow_items_by_month": lambda c: sales.slow_items_by_month(c.orders, c.lines, c.items, 5),
    "slow_items_by_month_zero_filled": lambda c: sales.slow_items_by_month(
        c.orders, c.lines, c.items, 5, SPAN
    ),
    # the same from facts laid out by order or by month
    "monthly_sales_bucketed": lambda c: sales.monthly_sales_bucketed(bucket_facts(c.orders, c.lines)),
    "running_total_bucketed": lambda c: ranking.running_total_bucketed(bucket_facts(c.orders, c.lines), c.customers, SINCE),
    "item_quantities_by_month": lambda c: sales.item_quantities(_sales_by_month(c), "1998-03-10", "1998-04-09"),
    "quarter_sales_by_month": lambda c: sales.quarter_sales(_sales_by_month(c), 3, *SPAN),
    # subqueries
    "idle_salespeople_exists": lambda c: subqueries.idle_salespeople_not_exists(c.people, c.sales, "1998-07-04"),
    "idle_salespeople_left_join": lambda c: subqueries.idle_salespeople(c.people, c.sales, "1998-07-04"),
    "min_price_items": lambda c: subqueries.min_price_items(c.items),
    "min_price_join": lambda c: subqueries.min_price_join(c.items),
    "min_price_items_sql": lambda c: dynamic_sql.min_price_items_sql(c.items),
    "min_price_one": lambda c: subqueries.min_price_one(c.items),
    "top_payers_in": lambda c: subqueries.top_payers_in(c.customers, c.orders),
    "top_payers_cte": lambda c: subqueries.top_payers_join(c.customers, c.orders),
    "top_item_cities_nested": lambda c: subqueries.top_item_cities_nested(
        c.orders, c.lines, c.items, c.customers, c.cities, c.people
    ),
    "top_item_cities_cte": lambda c: subqueries.top_item_cities(
        c.orders, c.lines, c.items, c.customers, c.cities, c.people
    ),
    "large_invoices_picked": lambda c: subqueries.large_invoices_picked(
        c.orders, c.lines, c.people, 10_000_000
    ),
    # running totals and rankings
    "running_total_self_join": lambda c: ranking.running_total_self_join(c.orders, c.lines, c.customers, SINCE),
    "running_total_by_month": lambda c: ranking.running_total_by_month(c.orders, c.lines, c.customers, SINCE),
    "top2_items_per_month": lambda c: ranking.top_items_per_month(
        c.orders, c.lines, _half_in_capitals(c.items, "item_name", "item_id"), "1998-01-01", "1998-12-31"
    ),
    "item_window_profile": lambda c: ranking.item_window_profile(c.items),
    "last_customer_per_salesperson": lambda c: ranking.last_customer_per_salesperson(
        c.orders, c.lines, c.customers, c.people
    ),
    "dearest_items_dense_rank": lambda c: ranking.dearest_items_by_price(c.orders, c.lines, c.customers),
    "dearest_items_apply": lambda c: ranking.dearest_items_by_rank(c.orders, c.lines, c.customers),
    # pivots, unpivots, dates
    "pivot_customers_by_month": lambda c: crosstabs.pivot_customers_by_month(
        c.orders, c.stores.filter("region_id = 2"), PLACES
    ),
    "pivot_dynamic": lambda c: crosstabs.pivot_dynamic(
        c.orders, _half_in_small_letters(c.customers, "segment", "customer_id"), "segment"
    ),
    "pivot_dynamic_sql": lambda c: dynamic_sql.pivot_dynamic_sql(
        c.orders, _half_in_small_letters(c.customers, "segment", "customer_id"), "segment"
    ),
    "pivot_column_list": lambda c: crosstabs.pivot_column_list(
        c.orders, _half_in_small_letters(c.customers, "segment", "customer_id"), "segment"
    ),
    "text_in_parentheses": lambda c: crosstabs.text_in_parentheses(
        c.stores.unionByName(c.customers.select("customer_id", "customer_name"), allowMissingColumns=True)
    ),
    "unpivot_addresses": lambda c: crosstabs.unpivot_addresses(
        _item_kinds(c), "Ring", ["address_line_1", "address_line_2"]
    ),
    "unpivot_codes": lambda c: crosstabs.unpivot_codes(
        c.customers,
        ["customer_id", "customer_name"],
        {"segment_code": F.col("segment"), "city_code": F.col("city_id")},
    ),
    "date_parts": lambda c: crosstabs.date_parts(c.orders),
    # table changes
    "insert_generated_key": lambda c: changes.insert_test_customers(c.customers),
    "delete_top": lambda c: changes.delete_one_test(changes.insert_test_customers(c.customers)),
    "update_top": lambda c: changes.changed_customers(c.customers),
    "delete_where": lambda c: changes.delete_renamed(changes.changed_customers(c.customers)),
    "merge_customers": lambda c: _merge_customers(c).snapshot,
    "merge_change_log": lambda c: _merge_customers(c).changes,
    "orders_changed_by_month": lambda c: upkept.orders_changed(_plain_orders(c)).table.rows(),
    "orders_changed_log": lambda c: upkept.orders_changed(_plain_orders(c)).log,
    "order_totals_kept": lambda c: upkept.order_totals_kept(_plain_orders(c)),
    "catalog_table_cycle": lambda c: changes.catalog_table_cycle(c.customers),
    "bulk_round_trip": lambda c: changes.bulk_round_trip(c.customers),
    "bulk_load_split": lambda c: changes.bulk_load_split(c.customers),
    "bulk_load_rejects": lambda c: changes.bulk_load_rejects(c.customers),
    # XML and JSON
    "xml_items_source": lambda c: documents.xml_items_source(c.stock_items),
    "xml_items_split": lambda c: documents.xml_items_split(c.stock_items),
    "xml_load_rejects": lambda c: documents.xml_load_rejects(c.stock_items),
    "xml_items_shred": lambda c: documents.xml_items_shred(c.stock_items),
    "xml_items_merge": lambda c: _merge_items(c).snapshot,
    "xml_items_merge_log": lambda c: _merge_items(c).changes,
    "xml_export_round_trip": lambda c: documents.xml_export_round_trip(c.stock_items),
    "json_fields": lambda c: documents.json_fields(c.item_fields),
    "json_tag_search": lambda c: documents.json_tag_search(c.item_fields, "ring"),
    "json_fields_variant": lambda c: documents.json_fields_variant(c.item_fields),
    "json_tag_search_variant": lambda c: documents.json_tag_search_variant(c.item_fields, "ring"),
    # query functions
    "best_customer": lambda c: parameters.best_customer(c.orders, c.lines),
    "customer_total_param": lambda c: parameters.customer_total(c.orders, c.lines, 9),
    "customer_total_int": lambda c: parameters.customer_totals_int(c.customers, c.orders, c.lines),
    "customer_totals_left_join": lambda c: parameters.customer_totals(c.customers, c.orders, c.lines),
    "customer_totals_lateral": lambda c: parameters.customer_totals_lateral(c.customers, c.orders, c.lines),
    "sort_list": lambda c: parameters.sorted_lists(parameters.lists_to_sort(c.items), "data"),
    "sort_list_spaced": lambda c: parameters.sorted_lists(parameters.lists_to_sort(c.items), "data", " "),
    # constraints
    "dq_keys": lambda c: constraints.key_violations(constraints.shop_from(c)),
    "dq_foreign_keys": lambda c: constraints.foreign_key_violations(_shop_with_sales_table(c)),
    "dq_checks": lambda c: constraints.check_violations(constraints.shop_from(c)),
    "dq_defaults": _defaults_applied,
    "dq_sales_kept": lambda c: upkept.sales_violations_kept(constraints.shop_from(c)),
}


def comparable(df: DataFrame) -> DataFrame:
    """Columns in types that every SQL engine returns alike.

    Decimals become doubles, integers bigint, dates and timestamps ISO text. Used only where results
    are compared with another engine; the query functions themselves keep their types.
    """

    def one(field):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (ByteType, ShortType, IntegerType)):
            column = column.cast("bigint")
        elif isinstance(field.dataType, (DateType, TimestampNTZType)):
            column = column.cast("string")
        return column.alias(field.name)

    return df.select(*map(one, df.schema.fields))


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return QUERIES[name](Catalog(spark, folder))
