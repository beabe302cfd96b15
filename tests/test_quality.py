import datetime

from pyspark.sql import functions as F

from ledgerloom.operators import quality
from ledgerloom.plans import constraints
from ledgerloom.plans.constraints import Shop
from tests.conftest import ordered, rows


def shop(spark):
    day, later = datetime.datetime(2024, 1, 2), datetime.datetime(2024, 1, 3)
    made = spark.createDataFrame
    return Shop(
        services=made(
            [(1, "post", "text", 5.0), (2, "post", None, -1.0), (3, "x" * 101, "free", 0.0)],
            "id_service int, name_service string, description_service string, price_service double",
        ),
        sales=made(
            [
                (1, 1, 1, 1, day, later, 1),
                (1, 9, 1, 1, later, day, 1),
                (2, 1, None, 1, None, day, 9),
                (3, 1, 1, None, day, None, 1),
            ],
            "id_sales int, id_service int, id_client int, quantity int, date_created timestamp_ntz, "
            "expected_date timestamp_ntz, id_employee int",
        ),
        client=made(
            [(1, "a", "79001234567", "e", day), (2, "b", "7900123456", "e", day), (None, "c", "7900123456x", "e", day)],
            "id int, username string, phone string, email string, created timestamp_ntz",
        ),
        employee=made(
            [(1, "a", "79001234567", "e", day, 3), (2, "a", "7900123456789", "e", day, 4)],
            "id int, username string, phone string, email string, created timestamp_ntz, skill int",
        ),
        skill=made([(3, "senior", 9), (0, "none", 1)], "id int, name string, speed int"),
    )


def test_keys(spark):
    assert ordered(constraints.key_violations(shop(spark))) == sorted(
        [
            ("services", "unique_name_service", "post", "2"),
            ("sales", "primary_key", "1", "2"),
            ("client", "primary_key", "NULL", "1"),
            ("employee", "unique_username", "a", "2"),
        ],
        key=repr,
    )


def test_foreign_keys_ignore_null(spark):
    assert ordered(constraints.foreign_key_violations(shop(spark))) == sorted(
        [
            ("sales", "foreign_key_id_service", "1", "9"),
            ("sales", "foreign_key_id_employee", "2", "9"),
            ("employee", "foreign_key_skill", "2", "4"),
        ],
        key=repr,
    )


def test_checks_pass_when_unknown(spark):
    assert ordered(constraints.check_violations(shop(spark))) == sorted(
        [
            ("services", "not_null_description_service", "2", None),
            ("services", "check_price_service", "2", "-1.0"),
            ("services", "max_length_name_service", "3", "101"),
            ("sales", "check_expected_date", "1", "2024-01-02 00:00:00"),
            ("sales", "not_null_id_client", "2", None),
            ("sales", "not_null_quantity", "3", None),
            ("client", "check_phone", "2", "7900123456"),
            ("client", "not_null_id", "NULL", None),
            ("client", "check_phone", "NULL", "7900123456x"),
            ("employee", "check_phone", "2", "7900123456789"),
            ("employee", "max_length_phone", "2", "13"),
            ("skill", "check_id", "0", "0"),
        ],
        key=repr,
    )


def test_default_fills_only_the_missing(spark):
    now = F.lit("2030-01-01 00:00:00").cast("timestamp_ntz")
    found = constraints.sales_with_defaults(shop(spark), now).select("id_sales", "date_created")
    assert [r[1].year for r in rows(found.orderBy("id_sales", "date_created"))] == [2024, 2024, 2030, 2024]
    assert constraints.sales_with_defaults(shop(spark)).filter("date_created IS NULL").isEmpty()


def test_row_rules_do_not_shuffle(spark):
    df = quality.row_violations(
        spark.range(10).toDF("id"), "t", ["id"], [quality.check("small", F.col("id") < 5, F.col("id"))]
    )
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    assert df.count() == 5


def test_names_that_differ_in_case_repeat(spark):
    df = spark.createDataFrame([("Bob", 1), ("bob", 2), ("ann", 3), (None, 4)], "name string, id int")
    assert rows(quality.unique(df, "people", ["name"])) == [("people", "unique_name", "Bob", "2")]
    assert ordered(quality.primary_key(df, "people", ["name"])) == [
        ("people", "primary_key", "Bob", "2"), ("people", "primary_key", "NULL", "1"),
    ]
