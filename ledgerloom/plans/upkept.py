"""Months of orders and sales changed in place, with totals and violations that follow the change log."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import partitioned, quality, rechecks, upkeep
from ledgerloom.plans.constraints import UNKNOWN, Shop, sales_parents, sales_rules
from ledgerloom.sources.layouts import MonthTable, month_of, write_by_month
from ledgerloom.sources.workspace import materialize

FIRST, LAST = "1998-03-01", "1998-03-31"
NEW_KEYS = 1_000_000_000


def _inside(day: str):
    return F.col(day).cast("date").between(F.lit(FIRST).cast("date"), F.lit(LAST).cast("date"))


@dataclass(frozen=True)
class Changed:
    """A table after a run of changes, and the log of each change."""

    table: MonthTable
    logs: list[DataFrame]

    @property
    def log(self) -> DataFrame:
        return reduce(DataFrame.unionByName, self.logs)


def order_corrections(orders: DataFrame) -> DataFrame:
    """Corrected orders of one month, some moved to the next one, and copies of others under a new key two months on."""
    month = orders.filter(_inside("order_date"))
    corrected = month.filter("order_id % 7 = 0").withColumns(
        {
            "order_date": F.when(F.col("order_id") % 14 == 0, F.lit("1998-04-15").cast("date")).otherwise(F.col("order_date")),
            "paid_amount": (F.col("paid_amount") + 10).cast("decimal(18,2)"),
        }
    )
    copied = month.filter("order_id % 11 = 0").withColumns(
        {"order_id": F.col("order_id") + NEW_KEYS, "order_date": F.lit("1998-05-02").cast("date")}
    )
    return corrected.unionByName(copied)


def change_orders(table: MonthTable) -> Changed:
    """Merge the corrections, then delete the low-priority orders of the month. Three months are rewritten."""
    merged = partitioned.merge_months(table, order_corrections(table.rows()), ["order_id"], ["order_date", "paid_amount"])
    deleted = partitioned.delete_months(table, _inside("order_date") & (F.col("priority") == "5-LOW"))
    return Changed(table, [merged, deleted])


def orders_changed(orders: DataFrame) -> Changed:
    return change_orders(write_by_month(orders, "order_date"))


def order_totals_kept(orders: DataFrame) -> DataFrame:
    """Orders, paid amount and running amount per month after the changes, from the totals before and the log."""
    table = write_by_month(orders, "order_date")
    sums, month = {"paid": F.col("paid_amount")}, month_of("order_date")
    before = materialize(upkeep.totals(table.rows(), month, sums), "month-totals")
    changed = change_orders(table)
    state = materialize(reduce(lambda s, log: upkeep.updated_totals(s, log, month, sums), changed.logs, before), "month-totals")
    running = upkeep.running_totals(state, "paid", "running_amount")
    return (
        state.join(F.broadcast(running), "month")
        .select("month", F.col(upkeep.ROWS).alias("orders"), F.col("paid").alias("paid_amount"), "running_amount")
        .orderBy("month")
    )


def sales_violations(shop: Shop) -> DataFrame:
    """All rules of the sales, in full."""
    found = [
        quality.row_violations(shop.sales, "sales", ["id_sales"], sales_rules()),
        quality.primary_key(shop.sales, "sales", ["id_sales"]),
        quality.foreign_keys(shop.sales, "sales", ["id_sales"], sales_parents(shop)),
    ]
    return reduce(DataFrame.unionByName, found)


def sales_violations_kept(shop: Shop) -> DataFrame:
    """Violations of the sales after a month of them was changed and services were withdrawn.

    The full jobs run once, before the changes. Each change is then followed from its log; of the sales that did not
    change only those are read that share a key with a changed one or sell a withdrawn service.
    """
    table = write_by_month(shop.sales, "date_created")
    shop = replace(shop, sales=table.rows())
    violations = materialize(sales_violations(shop), "violations")

    def followed(log: DataFrame, parent_logs=None) -> DataFrame:
        current = table.rows()
        found = rechecks.row_rules(violations, log, "sales", ["id_sales"], sales_rules())
        found = rechecks.primary_key(found, log, current, "sales", "id_sales")
        found = rechecks.foreign_keys(found, log, current, "sales", ["id_sales"], sales_parents(shop), parent_logs)
        return materialize(found, "violations")

    violations = followed(partitioned.delete_months(table, _inside("date_created") & (F.col("id_employee") % 3 == 0)))
    late = {"expected_date": F.col("date_created") - F.expr("interval 1 day"), "id_client": F.col("id_client") + UNKNOWN}
    violations = followed(partitioned.update_months(table, _inside("date_created") & (F.col("quantity") > 25), late))
    withdrawn = F.col("id_service") % 50 == 3
    log = partitioned.change_log(shop.services.filter(withdrawn), "DELETE")
    shop = replace(shop, services=shop.services.filter(~withdrawn))
    nothing = partitioned.change_log(table.rows().limit(0), "DELETE")
    return followed(nothing, {"id_service": log})
