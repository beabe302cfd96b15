"""Items as XML documents and as JSON fields."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.json_path import explode_json, json_array, json_query, json_value
from ledgerloom.functions.text import joined, same_text
from ledgerloom.functions.variants import explode_at, fragment_at, scalar_at, texts_at, with_variant
from ledgerloom.operators.mutation import Merge, merge
from ledgerloom.sources.item_xml import export_items, read_documents, read_items, read_items_split, shred_items
from ledgerloom.sources.workspace import new_work_path

# what a match takes from the document
ITEM_COLUMNS = [
    "supplier_id",
    "unit_package_id",
    "outer_package_id",
    "quantity_per_outer",
    "typical_weight",
    "lead_time_days",
    "is_chiller_stock",
    "tax_rate",
    "unit_price",
]


def xml_of(items: DataFrame, order: str = "item_id") -> str:
    """Write items as XML, highest first, and return where."""
    path = new_work_path(items.sparkSession, "items-xml")
    export_items(items, path, F.col(order).desc())
    return path


def xml_items_source(items: DataFrame) -> DataFrame:
    """Items read by row tag from the documents of ``items``."""
    return read_items(items.sparkSession, xml_of(items))


def xml_items_shred(items: DataFrame) -> DataFrame:
    """Items taken out of whole documents."""
    return shred_items(read_documents(items.sparkSession, xml_of(items)))


def xml_items_split(items: DataFrame) -> DataFrame:
    """The same from documents that are cut at their records."""
    return read_items_split(items.sparkSession, xml_of(items)).rows


def xml_load_rejects(items: DataFrame) -> DataFrame:
    """Records that a load sets aside: of a price list with some prices missing their digits and some end tags."""
    name, price = F.col("item_name"), F.col("unit_price").cast("string")
    bad_price = F.when(F.col("item_id") % 10 == 3, F.lit("soon")).otherwise(price)
    end = F.when(F.col("item_id") % 10 == 7, F.lit("</Price>")).otherwise(F.lit("</UnitPrice>"))
    record = F.concat(F.lit('<Item Name="'), name, F.lit('"><UnitPrice>'), bad_price, end, F.lit("</Item>"))
    path = new_work_path(items.sparkSession, "price-list")
    items.select(record.alias("value")).write.text(path)
    return read_items_split(items.sparkSession, path).rejects.select("reason", "record")


def xml_export_round_trip(items: DataFrame) -> DataFrame:
    """Items exported, loaded, exported again from what was loaded, and loaded from that."""
    loaded = xml_items_source(items)
    return read_items(items.sparkSession, xml_of(loaded, "item_name"))


def merge_items(items: DataFrame, incoming: DataFrame) -> Merge:
    """Update items by name from ``incoming``; add unknown names under a new key."""
    return merge(
        items,
        incoming,
        ["item_name"],
        ITEM_COLUMNS,
        key="item_id",
        insert_constants={"last_edited_by": F.lit(1)},
        ignore_case=True,
    )


def price_list(items: DataFrame, new_kind: int) -> DataFrame:
    """A supplier's list: every price doubled, one supplier's items under new names."""
    renamed = F.when(
        F.col("supplier_id") == new_kind, F.concat(F.lit("new "), "item_name")
    ).otherwise(F.col("item_name"))
    return items.withColumns(
        {"item_name": renamed, "unit_price": (F.col("unit_price") * 2).cast("decimal(18,6)")}
    )


def json_fields(items: DataFrame) -> DataFrame:
    """Country and first tag out of the JSON field; the tag array itself is no scalar."""
    fields = F.col("custom_fields")
    return items.select(
        "item_id",
        "item_name",
        json_value(fields, "$.CountryOfManufacture").alias("country"),
        json_value(fields, "$.Tags[0]").alias("first_tag"),
        json_value(fields, "$.Tags[1]").alias("second_tag"),
        json_value(fields, "$.Tags").alias("tags_value"),
    )


def json_tag_search(items: DataFrame, tag: str) -> DataFrame:
    """Items carrying a tag, once per occurrence, with all tags as JSON and as text."""
    fields = F.col("custom_fields")
    return (
        explode_json(items, "custom_fields", "$.Tags", "tag")
        .filter(same_text(F.col("tag"), tag))
        .select(
            "item_id",
            "item_name",
            json_query(fields, "$.Tags").alias("tags_json"),
            joined(json_array(fields, "$.Tags")).alias("tags"),
        )
    )


def json_fields_variant(items: DataFrame) -> DataFrame:
    """``json_fields`` from documents that are parsed once."""
    document = F.col("_document")
    return with_variant(items, "custom_fields").select(
        "item_id",
        "item_name",
        scalar_at(document, "$.CountryOfManufacture").alias("country"),
        scalar_at(document, "$.Tags[0]").alias("first_tag"),
        scalar_at(document, "$.Tags[1]").alias("second_tag"),
        scalar_at(document, "$.Tags").alias("tags_value"),
    )


def json_tag_search_variant(items: DataFrame, tag: str) -> DataFrame:
    """``json_tag_search`` from documents that are parsed once."""
    document = F.col("_document")
    return (
        explode_at(with_variant(items, "custom_fields"), "_document", "$.Tags", "tag")
        .filter(same_text(F.col("tag"), tag))
        .select(
            "item_id",
            "item_name",
            fragment_at(document, "$.Tags").alias("tags_json"),
            joined(texts_at(document, "$.Tags")).alias("tags"),
        )
    )
