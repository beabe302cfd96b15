"""A run of changes to the customer table: insert, delete, update, merge, export and load."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import text
from ledgerloom.operators import mutation
from ledgerloom.operators.topk import top
from ledgerloom.sources.delimited import export_delimited, load_delimited, load_delimited_split, write_lines
from ledgerloom.sources.tables import create_table, create_table_from, drop_table, read_back
from ledgerloom.sources.workspace import materialize, new_work_path

KEY = "customer_id"


def _is_test_row():
    return text.starts_with_text(F.col("customer_name"), "Test")


def insert_test_customers(customers: DataFrame, n: int = 5) -> DataFrame:
    """Copies of the n newest customers under a new key and a ``TEST_`` name."""
    copies = top(customers, n, F.col(KEY).desc()).withColumn(
        "customer_name", F.concat(F.lit("TEST_"), "customer_name")
    )
    return mutation.insert_rows(customers, copies, KEY, [F.col(KEY)])


def delete_one_test(customers: DataFrame) -> DataFrame:
    return mutation.delete_top(customers, _is_test_row(), 1, KEY)


def rename_one_test(customers: DataFrame) -> DataFrame:
    return mutation.update_top(customers, _is_test_row(), 1, KEY, {"customer_name": F.lit("2Test")})


def delete_renamed(customers: DataFrame) -> DataFrame:
    return mutation.delete_where(customers, text.same_text(F.col("customer_name"), "2Test"))


def merge_scratch(customers: DataFrame) -> mutation.Merge:
    """Merge a scratch copy of the four newest customers, with two dropped and one renamed.

    ``customers`` is the table after the steps above up to ``rename_one_test``; its renamed row is
    deleted before the merge, so that the copy holds both rows to update and a row to insert.
    """
    source = create_table_from(
        customers, new_work_path(customers.sparkSession, "scratch"), 4, [F.col(KEY).desc()]
    )
    source = mutation.delete_top(source, _is_test_row(), 2, KEY)
    source = mutation.update_top(source, _is_test_row(), 1, KEY, {"customer_name": F.lit("Test obn")})
    target = delete_renamed(customers)
    return mutation.merge(target, source, [KEY], ["customer_name"], key=KEY)


def changed_customers(customers: DataFrame) -> DataFrame:
    """The table after insert, delete and update."""
    return rename_one_test(delete_one_test(insert_test_customers(customers)))


def bulk_round_trip(customers: DataFrame, top_rows: int | None = None) -> DataFrame:
    """Copy key and name to a new table, export it, empty it and load the export again."""
    spark = customers.sparkSession
    demo = create_table_from(
        customers.select("customer_id", "customer_name"), new_work_path(spark, "demo"), top_rows
    )
    file = new_work_path(spark, "export")
    export_delimited(demo, file)
    emptied = mutation.delete_all(demo)
    return mutation.insert_rows(emptied, load_delimited(spark, file, demo.schema))


def bulk_load_split(customers: DataFrame) -> DataFrame:
    """Key and name exported and loaded from files that are cut at their line ends."""
    spark = customers.sparkSession
    named = customers.select(KEY, "customer_name")
    file = new_work_path(spark, "export")
    export_delimited(named, file)
    return load_delimited_split(spark, file, named.schema).rows


def bulk_load_rejects(customers: DataFrame) -> DataFrame:
    """Lines that a load sets aside: of a list with some keys in words, some quotes left open and some names missing."""
    spark = customers.sparkSession
    key, name = F.col(KEY).cast("string"), F.col("customer_name")
    line = (
        F.when(F.col(KEY) % 10 == 3, F.concat(F.lit("no. "), key, F.lit("@"), name))
        .when(F.col(KEY) % 10 == 5, F.concat(key, F.lit('@"'), name))
        .when(F.col(KEY) % 10 == 7, key)
        .otherwise(F.concat(key, F.lit("@"), name))
    )
    file = new_work_path(spark, "list")
    write_lines(customers.select(line.alias("line")), file)
    found = load_delimited_split(spark, file, "customer_id bigint, customer_name string")
    return found.rejects.select("reason", "record")


def catalog_table_cycle(customers: DataFrame) -> DataFrame:
    """Create a catalog table, insert the customers and then more under new keys, read it back in key order, drop it."""
    spark = customers.sparkSession
    name = f"demo_{uuid.uuid4().hex}"
    rows = customers.select(KEY, "customer_name")
    create_table(spark, name, "customer_id bigint, customer_name string", new_work_path(spark, "demo"))
    try:
        rows.write.insertInto(name)
        insert_test_customers(spark.table(name)).filter(_is_test_row()).write.insertInto(name)
        copy = materialize(spark.table(name), "read-back")
    finally:
        drop_table(spark, name)
    return read_back(copy, F.col(KEY))
