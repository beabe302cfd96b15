import pytest
from pyspark.sql import functions as F

from ledgerloom.plans import crosstabs, documents, dynamic_sql
from ledgerloom.sources import item_xml
from ledgerloom.sources.item_xml import export_items, read_documents, read_items, shred_items
from tests.conftest import ordered, physical_plan, rows, same

XML = """<StockItems>
  <Item Name="full &amp; tidy">
    <SupplierID>4</SupplierID>
    <Package>
      <UnitPackageID>7</UnitPackageID><OuterPackageID>6</OuterPackageID>
      <QuantityPerOuter>12</QuantityPerOuter><TypicalWeightPerUnit>0.250</TypicalWeightPerUnit>
    </Package>
    <LeadTimeDays>14</LeadTimeDays><IsChillerStock>1</IsChillerStock>
    <TaxRate>15.000</TaxRate><UnitPrice>32.000000</UnitPrice>
  </Item>
  <Item Name="bare"><SupplierID>5</SupplierID></Item>
</StockItems>
"""


@pytest.fixture
def path(tmp_path):
    folder = tmp_path / "xml"
    folder.mkdir()
    (folder / "items.xml").write_text(XML)
    return str(folder)


def test_both_readers_give_typed_rows_and_nulls(spark, path):
    by_tag = read_items(spark, path)
    shredded = shred_items(read_documents(spark, path))
    assert by_tag.dtypes == shredded.dtypes
    assert same(by_tag, shredded)
    found = {r["item_name"]: r for r in by_tag.collect()}
    full, bare = found["full & tidy"], found["bare"]
    assert (full["quantity_per_outer"], full["is_chiller_stock"], str(full["typical_weight"])) == (12, True, "0.250")
    assert bare["supplier_id"] == 5
    assert all(bare[c] is None for c in by_tag.columns if c not in ("item_name", "supplier_id"))


def test_export_is_whole_documents_in_order(spark, catalog, tmp_path):
    path = str(tmp_path / "out")
    items = catalog.stock_items
    export_items(items, path, F.col("item_id").desc(), rows_per_file=30)
    parts = sorted((tmp_path / "out").glob("part-*"))
    assert len(parts) > items.count() // 30
    keys = []
    for part in parts:
        body = part.read_text()
        assert body.count("<StockItems>") == 1 and body.rstrip().endswith("</StockItems>")
        keys += [int(p.split('"')[0].split("#")[1]) for p in body.split('Name="')[1:]]
    assert keys == sorted(keys, reverse=True)
    columns = ["item_name", *documents.ITEM_COLUMNS]
    assert same(read_items(spark, path).select(columns), items.select(columns))


def test_merge_binds_columns_by_name(spark, catalog, path):
    items = catalog.stock_items.limit(3)
    incoming = read_items(spark, path)
    result = documents.merge_items(items, incoming)
    added = result.snapshot.filter("item_name = 'full & tidy'").first()
    assert added["last_edited_by"] == 1
    assert (added["lead_time_days"], added["quantity_per_outer"], str(added["typical_weight"])) == (14, 12, "0.250")
    assert str(added["unit_price"]) == "32.000000" and str(added["tax_rate"]) == "15.000"
    assert ordered(result.changes.groupBy("action").count()) == [("INSERT", 2)]


RECORD = '<Item Name="{}"><SupplierID>{}</SupplierID><Package><QuantityPerOuter>{}</QuantityPerOuter></Package></Item>'


def test_one_large_document_is_cut_at_its_records(spark, tmp_path):
    good = [RECORD.format(f"ёлка {i} &lt;/Item&gt;", i, i % 5) for i in range(4000)]
    text = '<?xml version="1.0"?>\n<StockItems>\n' + "\n".join(good) + "\n</StockItems>\n"
    (tmp_path / "one.xml").write_text(text, encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert spark.read.option("lineSep", "</Item>").text(str(tmp_path / "one.xml")).rdd.getNumPartitions() > 10
        found = item_xml.read_items_split(spark, str(tmp_path / "one.xml"))
        assert found.rejects.isEmpty() and same(found.rows, item_xml.read_items(spark, str(tmp_path / "one.xml")))
        assert found.rows.count() == 4000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_bad_records_are_set_aside(spark, tmp_path):
    records = [
        RECORD.format("good", 1, 2),
        RECORD.format("number", "many", 2),
        '<Item Name="open"><SupplierID>1</Item>',
        '<!-- <Item Name="hidden"></Item> -->' + RECORD.format("after a comment", 1, 2),
        '<Item Name="cdata"><SupplierID><![CDATA[</Item>]]></SupplierID></Item>',
        '<Item Name="self"/>' + RECORD.format("behind it", 1, 2),
        "stray text " + RECORD.format("stray", 1, 2),
        '<Item Name="no end">' + RECORD.format("next", 1, 2),
        RECORD.format("good too", 3, 4),
    ]
    (tmp_path / "a.xml").write_text("<StockItems>" + "\n".join(records) + "</StockItems>")
    (tmp_path / "b.xml").write_text("")
    found = item_xml.read_items_split(spark, str(tmp_path))
    assert sorted(r.item_name for r in found.rows.collect()) == ["good", "good too"]
    reasons = [(r.reason, r.file.rpartition("/")[2]) for r in found.rejects.collect()]
    assert {f for _, f in reasons} == {"a.xml"}
    counted = {}
    for reason, _ in reasons:
        counted[reason] = counted.get(reason, 0) + 1
    assert counted == {
        "not a valid record": 2, "comment or CDATA section": 4, "self-closed record": 1, "text outside a record": 1, "record without an end": 1,
    }


def test_sql_quotes_the_names_it_splices(spark):
    names = ["it's", "back`tick", "a, b", "back\\slash", "Élan"]
    customers = spark.createDataFrame(list(enumerate([*names, "IT'S", None])), "customer_id bigint, name string")
    orders = spark.range(70).select(
        F.col("id").alias("order_id"), (F.col("id") % 7).alias("customer_id"), F.add_months(F.lit("2020-01-05").cast("date"), (F.col("id") % 3).cast("int")).alias("order_date")
    )
    by_sql, plain = dynamic_sql.pivot_dynamic_sql(orders, customers, "name"), crosstabs.pivot_dynamic(orders, customers, "name")
    assert by_sql.columns == plain.columns and len(by_sql.columns) == 6
    assert rows(by_sql) == rows(plain)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("cells_")]


def test_the_pivot_joins_its_customers_once(spark, catalog):
    plan = physical_plan(crosstabs.pivot_dynamic(catalog.orders, catalog.customers, "segment"))
    assert "Join" not in plan
