"""The declared constraints of a small service shop: services, sales, client, employee, skill."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import quality
from ledgerloom.operators.quality import check, max_length, not_null
from ledgerloom.sources.catalog import Catalog


# keys from here on stand for services that do not exist
UNKNOWN = 1_000_000_000


@dataclass(frozen=True)
class Shop:
    services: DataFrame
    sales: DataFrame
    client: DataFrame
    employee: DataFrame
    skill: DataFrame


def shop_from(catalog: Catalog) -> Shop:
    """Bind the shop to the star schema.

    The bound columns break rules on their own: names repeat, phones of indebted clients are short,
    emails of one segment and some descriptions are missing, others are too long, skills go beyond the
    allowed three, and ship dates are compared with a later order date. Some orders sell a service that
    does not exist, and some clients take a name that differs from another's in case only.
    """
    part = catalog.raw("part")
    customer = catalog.raw("customer")
    supplier = catalog.raw("supplier")
    region = catalog.raw("region")
    service = F.col("l_partkey")
    unknown = (F.col("l_orderkey") % 100 == 0) & (F.col("l_linenumber") == 1)
    sold = F.when(unknown, F.array(service, service + UNKNOWN)).otherwise(F.array(service))
    lines = catalog.raw("lineitem").withColumn("l_partkey", F.explode(sold)).join(
        catalog.raw("orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )

    def phone(key: str, owed: str):
        return F.when(F.col(owed) < 0, F.lit("8-000")).otherwise(
            F.lpad(F.col(key).cast("string"), 11, "7")
        )

    def opened(key: str):
        return F.date_add(F.lit("1994-01-01").cast("date"), (F.col(key) % 365).cast("int"))

    return Shop(
        services=part.select(
            F.col("p_partkey").alias("id_service"),
            F.col("p_name").alias("name_service"),
            F.when(F.col("p_size") == 50, F.repeat("p_type", F.lit(40)))
            .when(F.col("p_size") != 49, F.col("p_type"))
            .alias("description_service"),
            (F.col("p_retailprice") - 901).cast("decimal(19,2)").alias("price_service"),
        ),
        sales=lines.select(
            F.col("l_orderkey").alias("id_sales"),
            F.col("l_partkey").alias("id_service"),
            F.col("o_custkey").alias("id_client"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("date_created"),
            (F.col("l_shipdate") - F.expr("interval 30 days")).alias("expected_date"),
            F.col("l_suppkey").alias("id_employee"),
        ),
        client=customer.select(
            F.col("c_custkey").alias("id"),
            F.when(F.col("c_custkey") % 40 == 0, F.concat(F.lit("client "), (F.col("c_custkey") - 1).cast("string")))
            .otherwise(F.concat(F.lit("Client "), F.col("c_custkey").cast("string")))
            .alias("username"),
            phone("c_custkey", "c_acctbal").alias("phone"),
            F.when(F.col("c_mktsegment") != "MACHINERY", F.concat("c_name", F.lit("@example.org"))).alias("email"),
            opened("c_custkey").alias("created"),
        ),
        employee=supplier.select(
            F.col("s_suppkey").alias("id"),
            F.col("s_name").alias("username"),
            phone("s_suppkey", "s_acctbal").alias("phone"),
            F.concat("s_name", F.lit("@example.org")).alias("email"),
            opened("s_suppkey").alias("created"),
            (F.col("s_nationkey") % 7).alias("skill"),
        ),
        skill=region.select(
            F.col("r_regionkey").alias("id"),
            F.col("r_name").alias("name"),
            (F.col("r_regionkey") * 10).alias("speed"),
        ),
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def key_violations(shop: Shop) -> DataFrame:
    """Primary keys and unique names."""
    return _union(
        [
            quality.primary_key(shop.services, "services", ["id_service"]),
            quality.primary_key(shop.sales, "sales", ["id_sales"]),
            quality.primary_key(shop.client, "client", ["id"]),
            quality.primary_key(shop.employee, "employee", ["id"]),
            quality.primary_key(shop.skill, "skill", ["id"]),
            quality.unique(shop.services, "services", ["name_service"]),
            quality.unique(shop.client, "client", ["username"]),
            quality.unique(shop.employee, "employee", ["username"]),
        ]
    )


def sales_parents(shop: Shop) -> dict[str, tuple[DataFrame, str]]:
    return {
        "id_service": (shop.services, "id_service"),
        "id_client": (shop.client, "id"),
        "id_employee": (shop.employee, "id"),
    }


def foreign_key_violations(shop: Shop) -> DataFrame:
    """References without a parent. ``shop.sales`` is read twice: for its references, and for the rows that hold orphans."""
    return _union(
        [
            quality.foreign_keys(shop.sales, "sales", ["id_sales"], sales_parents(shop)),
            quality.foreign_keys(shop.employee, "employee", ["id"], {"skill": (shop.skill, "id")}),
        ]
    )


def _required(*columns: str):
    return [not_null(c) for c in columns]


def _phone_rule():
    phone = F.col("phone")
    return check("phone", phone.rlike(r"^[0-9]{11}\z"), phone)


def sales_rules() -> list[quality.RowRule]:
    expected = F.col("expected_date")
    return [
        *_required("id_sales", "id_service", "id_client", "quantity", "id_employee"),
        check("expected_date", expected >= F.col("date_created"), expected),
    ]


def check_violations(shop: Shop) -> DataFrame:
    """NOT NULL, CHECK and length rules, one scan per table."""
    contact = [
        *_required("id", "username", "phone", "email", "created"),
        max_length("username", 100),
        max_length("phone", 12),
        max_length("email", 100),
        _phone_rule(),
    ]
    price, skill_id = F.col("price_service"), F.col("id")
    return _union(
        [
            quality.row_violations(
                shop.services,
                "services",
                ["id_service"],
                [
                    *_required("id_service", "name_service", "description_service", "price_service"),
                    max_length("name_service", 100),
                    max_length("description_service", 100),
                    check("price_service", price >= 0, price),
                ],
            ),
            quality.row_violations(
                shop.sales,
                "sales",
                ["id_sales"],
                sales_rules(),
            ),
            quality.row_violations(shop.client, "client", ["id"], contact),
            quality.row_violations(shop.employee, "employee", ["id"], [*contact, *_required("skill")]),
            quality.row_violations(
                shop.skill,
                "skill",
                ["id"],
                [
                    *_required("id", "name", "speed"),
                    max_length("name", 100),
                    check("id", skill_id.isin(1, 2, 3), skill_id),
                ],
            ),
        ]
    )


def sales_with_defaults(shop: Shop, now=None) -> DataFrame:
    """Sales as an insert stores them: no creation date means now."""
    now = F.current_timestamp() if now is None else now
    created = shop.sales.schema["date_created"].dataType
    return quality.with_defaults(shop.sales, {"date_created": now.cast(created)})
