"""Stock items as XML: ``<StockItems><Item Name="..."><Package>...</Package>...</Item></StockItems>``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ledgerloom.sources.tables import Loaded
from ledgerloom.sources.workspace import materialize

ROOT_TAG = "StockItems"
ROW_TAG = "Item"

# Element names of the exchange format and their types.
ITEM_SCHEMA = (
    "_Name string, SupplierID int, "
    "Package struct<UnitPackageID: int, OuterPackageID: int, QuantityPerOuter: int, "
    "TypicalWeightPerUnit: decimal(18,3)>, "
    "LeadTimeDays int, IsChillerStock boolean, TaxRate decimal(18,3), UnitPrice decimal(18,6)"
)


def _flat() -> list[Column]:
    return [
        F.col("_Name").alias("item_name"),
        F.col("SupplierID").alias("supplier_id"),
        F.col("Package.UnitPackageID").alias("unit_package_id"),
        F.col("Package.OuterPackageID").alias("outer_package_id"),
        F.col("Package.QuantityPerOuter").alias("quantity_per_outer"),
        F.col("Package.TypicalWeightPerUnit").alias("typical_weight"),
        F.col("LeadTimeDays").alias("lead_time_days"),
        F.col("IsChillerStock").alias("is_chiller_stock"),
        F.col("TaxRate").alias("tax_rate"),
        F.col("UnitPrice").alias("unit_price"),
    ]


def export_items(items: DataFrame, path: str, *order: Column, rows_per_file: int = 50_000) -> None:
    """Write items in ``order``, each file a whole document; a reader takes one file per task."""
    if order:
        items = items.repartitionByRange(*order).sortWithinPartitions(*order)
    items.select(
        F.col("item_name").alias("_Name"),
        F.col("supplier_id").alias("SupplierID"),
        F.struct(
            F.col("unit_package_id").alias("UnitPackageID"),
            F.col("outer_package_id").alias("OuterPackageID"),
            F.col("quantity_per_outer").alias("QuantityPerOuter"),
            F.col("typical_weight").alias("TypicalWeightPerUnit"),
        ).alias("Package"),
        F.col("lead_time_days").alias("LeadTimeDays"),
        F.col("is_chiller_stock").alias("IsChillerStock"),
        F.col("tax_rate").alias("TaxRate"),
        F.col("unit_price").alias("UnitPrice"),
    ).write.format("xml").options(
        rootTag=ROOT_TAG, rowTag=ROW_TAG, maxRecordsPerFile=str(rows_per_file)
    ).save(path)


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """Items by row tag and typed paths; a missing element is NULL, a malformed one an error."""
    return (
        spark.read.format("xml")
        .schema(ITEM_SCHEMA)
        .options(rowTag=ROW_TAG, mode="FAILFAST")
        .load(path)
        .select(*_flat())
    )


def shred_items(documents: DataFrame, document: str = "value") -> DataFrame:
    """Items of whole documents held as text, one document per row."""
    schema = StructType([StructField(ROW_TAG, ArrayType(StructType.fromDDL(ITEM_SCHEMA)))])
    parsed = F.from_xml(F.col(document), schema, {"mode": "FAILFAST"})
    return (
        documents.select(F.explode(parsed[ROW_TAG]).alias("item"))
        .select("item.*")
        .select(*_flat())
    )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Each file as one row of text."""
    return spark.read.text(path, wholetext=True)


def read_items_split(spark: SparkSession, path: str) -> Loaded:
    """Items of large documents, each read by many tasks, with bad records set aside.

    Files are cut at the closing row tag, which a scan can do from any place in a file, and each record is parsed by
    itself. What cannot be cut so is rejected, never guessed at: records with a comment or CDATA section (their text may
    hold tags), self-closed ones, text between records, and a record whose end is missing. A record that is not
    well-formed or has a value of another type is rejected too. The parsed records become a work table, which
    both results read.
    """
    schema = StructType([*StructType.fromDDL(ITEM_SCHEMA).fields, StructField("_bad", StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad", "rowTag": ROW_TAG}
    end = f"</{ROW_TAG}>"
    pieces = spark.read.option("lineSep", end).text(path).select(F.col("_metadata.file_path").alias("file"), "value")
    start = F.regexp_instr("value", F.lit(rf"<{ROW_TAG}[\s/>]"))
    cut = pieces.select(
        "file",
        F.when(start > 0, F.substr("value", F.lit(1), start - 1)).otherwise(F.col("value")).alias("before"),
        F.when(start > 0, F.concat(F.substr("value", start), F.lit(end))).alias("record"),
    )
    # what may stand around records: a declaration and the root's tags
    frame = rf"^\uFEFF?\s*(<\?xml[^>]*\?>)?\s*(</{ROOT_TAG}\s*>)?\s*(<{ROOT_TAG}\s*>)?\s*$"
    whole = F.coalesce("record", F.lit(""))
    cut = cut.filter(F.col("record").isNotNull() | ~F.col("before").rlike(frame))
    reason = (
        F.when(F.concat("before", whole).rlike(r"<!--|-->|<!\[CDATA\[|\]\]>"), "comment or CDATA section")
        .when(~F.col("before").rlike(frame), "text outside a record")
        .when(whole.rlike(rf"<{ROW_TAG}(\s[^>]*)?/>"), "self-closed record")
        .when(F.regexp_count(whole, F.lit(rf"<{ROW_TAG}[\s>]")) > 1, "record without an end")
    )
    parsed = cut.withColumn("reason", reason).withColumn("item", F.when(F.col("reason").isNull(), F.from_xml("record", schema, options)))
    bad = F.col("reason").isNull() & (F.col("item").isNull() | F.col("item._bad").isNotNull())
    table = materialize(
        parsed.select(
            "file", F.concat("before", whole).alias("record"), F.when(bad, "not a valid record").otherwise(F.col("reason")).alias("reason"), "item"
        ),
        "records",
    )
    rows = table.filter("reason is null").select("item.*").select(*_flat())
    return Loaded(rows, table.filter("reason is not null").select("file", "reason", F.regexp_replace("record", r"^\s+", "").alias("record")))
