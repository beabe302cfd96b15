import datetime

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import dates, text
from ledgerloom.functions.json_path import explode_json, json_query, json_value
from tests.conftest import rows


def one(spark, column, value=None, kind="string"):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(column).first()[0]


@pytest.mark.parametrize("month,third", [(1, 1), (4, 1), (5, 2), (8, 2), (9, 3), (12, 3)])
def test_third_of_year(spark, month, third):
    assert one(spark, dates.third_of_year(F.col("v")), datetime.date(2013, month, 5), "date") == third


def test_written_dates(spark):
    day = datetime.date(2013, 3, 5)
    v = F.col("v")
    assert one(spark, dates.dotted_date(v), day, "date") == "05.03.2013"
    assert one(spark, dates.month_name_ru(v), day, "date") == "март"
    assert one(spark, dates.month_name_en(v), day, "date") == "March"
    assert one(spark, dates.long_date_ru(v), day, "date") == "5 марта 2013 г."
    assert one(spark, dates.long_date_en(v), day, "date") == "Tuesday, March 5, 2013"
    assert one(spark, dates.month_start(v), day, "date") == datetime.date(2013, 3, 1)
    assert one(spark, dates.month_end(v), day, "date") == datetime.date(2013, 3, 31)


def test_text_predicates_ignore_case(spark):
    df = spark.createDataFrame([("TEST_a",), ("2Test",), ("attest",), ("50%",), (None,)], "v string")
    v = F.col("v")
    assert rows(df.filter(text.starts_with_text(v, "Test"))) == [("TEST_a",)]
    assert rows(df.filter(text.contains_text(v, "TEST"))) == [("TEST_a",), ("2Test",), ("attest",)]
    assert rows(df.filter(text.same_text(v, "2TEST"))) == [("2Test",)]
    assert rows(df.filter(text.contains_text(v, "%"))) == [("50%",)]


@pytest.mark.parametrize(
    "name,place", [("Shop (Gasport, NY)", "Gasport, NY"), ("Plain", "Plai"), ("A (b", ""), (None, None)]
)
def test_inside_parentheses(spark, name, place):
    assert one(spark, text.inside_parentheses(F.col("v")), name) == place


@pytest.mark.parametrize(
    "given,comma,space",
    [
        (
            "apple,pear,orange,banana,grape,kiwi",
            "apple,banana,grape,kiwi,orange,pear,",
            "apple banana grape kiwi orange pear ",
        ),
        ("pineapple,grape,banana,apple", "apple,banana,grape,pineapple,", "apple banana grape pineapple "),
        ("b,A,a,B", "A,a,B,b,", "A a B b "),
        ("one", "one,", "one "),
        ("", ",", " "),
        (None, None, None),
    ],
)
def test_sort_list(spark, given, comma, space):
    assert one(spark, text.sort_list(F.col("v")), given) == comma
    assert one(spark, text.sort_list(F.col("v"), " "), given) == space


DOCUMENT = '{"Country": "China", "Tags": ["Radio", "Vintage", "Vintage"], "Age": 3, "Odd": "[1]", "Range": {"a": 1}}'


def test_json_value_reads_scalars_only(spark):
    v = F.col("v")
    assert one(spark, json_value(v, "$.Country"), DOCUMENT) == "China"
    assert one(spark, json_value(v, "$.Age"), DOCUMENT) == "3"
    assert one(spark, json_value(v, "$.Tags[1]"), DOCUMENT) == "Vintage"
    assert one(spark, json_value(v, "$.Odd"), DOCUMENT) == "[1]"
    for path in ("$.Tags", "$.Range", "$.Missing", "$.Tags[9]"):
        assert one(spark, json_value(v, path), DOCUMENT) is None
    assert one(spark, json_value(v, "$.Country")) is None


def test_json_query_reads_fragments_only(spark):
    v = F.col("v")
    assert one(spark, json_query(v, "$.Range"), DOCUMENT) == '{"a":1}'
    assert one(spark, json_query(v, "$.Tags"), DOCUMENT) == '["Radio","Vintage","Vintage"]'
    for path in ("$.Country", "$.Odd", "$.Missing"):
        assert one(spark, json_query(v, path), DOCUMENT) is None


def test_explode_json(spark):
    df = spark.createDataFrame(
        [(1, DOCUMENT), (2, '{"Tags": []}'), (3, '{"Country": "x"}'), (4, None)], "id int, doc string"
    )
    found = explode_json(df, "doc", "$.Tags", "tag").filter("tag = 'Vintage'")
    assert rows(found.select("id")) == [(1,), (1,)]


def test_any_alphabet_in_column_names(spark):
    df = spark.createDataFrame([(1,)], "id int").select(F.col("id").alias("ИД товара"))
    assert rows(df.filter("`ИД товара` = 1")) == [(1,)]
