"""The retail tables the queries are written against, bound to a star schema in parquet.

Each property is a narrow projection over a scan, so column pruning and date filters reach the
parquet reader (dates are casts of the stored timestamps, which the optimizer unwraps).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.sources.tables import read_table

MONEY = "decimal(18,2)"

STAR_SCHEMA = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
}


class Catalog:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def raw(self, name: str) -> DataFrame:
        return read_table(self.spark, self.folder, name, STAR_SCHEMA[name])

    @property
    def customers(self) -> DataFrame:
        return self.raw("customer").select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.col("c_nationkey").alias("city_id"),
            F.col("c_mktsegment").alias("segment"),
            F.col("c_acctbal").cast(MONEY).alias("credit_limit"),
        )

    @property
    def orders(self) -> DataFrame:
        """Orders, which are also the invoices and the customer payments."""
        return self.raw("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.to_date("o_orderdate").alias("order_date"),
            F.col("o_orderpriority").alias("priority"),
            F.col("o_totalprice").cast(MONEY).alias("paid_amount"),
            F.when(F.col("o_orderstatus") == "F", F.to_date("o_orderdate")).alias("picking_completed"),
        )

    @property
    def lines(self) -> DataFrame:
        """Order lines, which are also the invoice lines; lines in state F have been picked."""
        picked = F.col("l_linestatus") == "F"
        quantity = F.col("l_quantity").cast("int")
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("line_number"),
            F.col("l_partkey").alias("item_id"),
            F.col("l_suppkey").alias("salesperson_id"),
            quantity.alias("quantity"),
            F.col("l_extendedprice").cast(MONEY).alias("unit_price"),
            F.to_date("l_shipdate").alias("ship_date"),
            F.when(picked, F.to_date("l_shipdate")).alias("picking_completed"),
            F.when(picked, quantity).otherwise(0).alias("picked_quantity"),
            F.when(picked, F.col("l_suppkey")).alias("picker_id"),
        )

    @property
    def sales(self) -> DataFrame:
        """A line with the customer and date of its order: one sale by one salesperson."""
        return self.lines.join(self.orders.drop("picking_completed"), "order_id")

    @property
    def items(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("item_id"),
            F.col("p_name").alias("item_name"),
            F.col("p_brand").alias("brand"),
            F.col("p_type").alias("kind"),
            F.col("p_size").alias("weight"),
            F.nullif(F.col("p_size") % 5, F.lit(0)).alias("outer_quantity"),
            F.col("p_retailprice").cast(MONEY).alias("unit_price"),
        )

    @property
    def people(self) -> DataFrame:
        return self.raw("supplier").select(
            F.col("s_suppkey").alias("person_id"),
            F.col("s_name").alias("full_name"),
            (F.col("s_acctbal") > 0).alias("is_salesperson"),
        )

    @property
    def suppliers(self) -> DataFrame:
        """Suppliers with the delivery method of their region."""
        nations = self.raw("nation").select("n_nationkey", "n_regionkey")
        return (
            self.raw("supplier")
            .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("s_suppkey").alias("supplier_id"),
                F.col("s_name").alias("supplier_name"),
                F.col("n_regionkey").alias("method_id"),
            )
        )

    @property
    def purchases(self) -> DataFrame:
        """Orders placed with suppliers; the contact is the customer behind the order."""
        orders = self.raw("orders").select(
            F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("contact_id")
        )
        lines = self.raw("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_suppkey").alias("supplier_id"),
            F.to_date("l_shipdate").alias("expected_date"),
            (F.col("l_linestatus") == "F").alias("is_finalized"),
        )
        return lines.join(orders, "order_id")

    @property
    def supplied(self) -> DataFrame:
        """The supplier of each purchased line, without the order behind it."""
        return self.raw("lineitem").select(F.col("l_suppkey").alias("supplier_id"))

    @property
    def contacts(self) -> DataFrame:
        return self.raw("customer").select(
            F.col("c_custkey").alias("person_id"), F.col("c_name").alias("full_name")
        )

    @property
    def delivery_methods(self) -> DataFrame:
        return self.raw("region").select(
            F.col("r_regionkey").alias("method_id"), F.col("r_name").alias("method_name")
        )

    @property
    def cities(self) -> DataFrame:
        return self.raw("nation").select(
            F.col("n_nationkey").alias("city_id"),
            F.col("n_name").alias("city_name"),
            F.col("n_regionkey").alias("region_id"),
        )

    @property
    def stores(self) -> DataFrame:
        """Customers named after their place, ``Store (place)``, with the place's region."""
        return self.raw("customer").join(
            self.cities, F.col("c_nationkey") == F.col("city_id")
        ).select(
            F.col("c_custkey").alias("customer_id"),
            F.concat(F.lit("Store ("), "city_name", F.lit(")")).alias("customer_name"),
            "region_id",
        )

    @property
    def stock_items(self) -> DataFrame:
        """Items with the packaging and tax columns of the XML exchange format."""
        size = F.col("p_size")
        return self.raw("part").select(
            F.col("p_partkey").alias("item_id"),
            F.concat("p_name", F.lit(" #"), F.col("p_partkey").cast("string")).alias("item_name"),
            size.alias("supplier_id"),
            (size % 10).alias("unit_package_id"),
            (size % 6).alias("outer_package_id"),
            F.nullif(size % 5, F.lit(0)).alias("quantity_per_outer"),
            (size / 8).cast("decimal(18,3)").alias("typical_weight"),
            (size % 14 + 1).alias("lead_time_days"),
            (F.col("p_type") == "SMALL").alias("is_chiller_stock"),
            F.lit(15).cast("decimal(18,3)").alias("tax_rate"),
            F.col("p_retailprice").cast("decimal(18,6)").alias("unit_price"),
            F.lit(7).alias("last_edited_by"),
        )

    @property
    def item_fields(self) -> DataFrame:
        """Items with a JSON document: the country of manufacture and an array of tags, some in capitals."""
        tags = F.when(F.col("p_partkey") % 3 == 0, F.upper("p_name")).otherwise(F.col("p_name"))
        return self.raw("part").select(
            F.col("p_partkey").alias("item_id"),
            F.col("p_name").alias("item_name"),
            F.to_json(
                F.struct(
                    F.col("p_type").alias("CountryOfManufacture"),
                    F.split(tags, " ").alias("Tags"),
                )
            ).alias("custom_fields"),
        )
