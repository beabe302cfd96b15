"""Bucketed facts, tables by month, changes that rewrite only touched months, and results that follow the log."""

import datetime
import os
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import joins, mutation, partitioned, quality, rechecks, upkeep
from ledgerloom.plans import ranking, sales
from ledgerloom.sources.layouts import bucket_facts, month_of, write_by_month
from ledgerloom.sources.workspace import materialize
from tests.conftest import ordered, physical_plan, same

SCHEMA = "id bigint, name string, ref bigint, day date, amount decimal(18,2)"


@pytest.fixture(scope="module")
def facts(spark, tmp_path_factory):
    """Orders and lines in which one order has a third of the lines."""
    base = str(tmp_path_factory.mktemp("facts"))
    spark.range(3000).select(
        F.col("id").alias("order_id"), (F.col("id") % 97).alias("customer_id"),
        F.date_add(F.lit("1997-11-01").cast("date"), (F.col("id") % 300).cast("int")).alias("order_date"),
    ).write.parquet(f"{base}/orders")
    spark.range(0, 12_000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 2900).cast("bigint").alias("order_id"),
        (F.col("id") % 7 + 1).cast("int").alias("quantity"),
        F.pmod(F.xxhash64("id"), F.lit(1009)).cast("decimal(18,2)").alias("unit_price"),
    ).write.parquet(f"{base}/lines")
    return spark.read.parquet(f"{base}/orders"), spark.read.parquet(f"{base}/lines")


def test_bucketed_facts_meet_without_a_shuffle(spark, facts, no_broadcast):
    orders, lines = facts
    customers = spark.range(97).select(F.col("id").alias("customer_id"), F.concat(F.lit("c"), "id").alias("customer_name"))
    laid = bucket_facts(orders, lines, buckets=4, hot_lines=1000)
    try:
        assert laid.hot_orders.count() == 1 and laid.hot_lines.count() > 4000 and laid.lines.filter("order_id = 7").isEmpty()
        report = sales.monthly_sales_bucketed(laid)
        plan = physical_plan(sales.monthly_sales(laid.orders, laid.lines))
        assert "hashpartitioning(order_id" not in plan and "SortMergeJoin" in plan and "Bucketed: true" in plan
        # the only rows dealt by order are those of the very large orders
        assert physical_plan(report).count("hashpartitioning(order_id") <= 2
        assert ordered(report) == ordered(sales.monthly_sales(orders, lines))
        running = ranking.running_total_bucketed(laid, customers, "1998-01-01")
        assert same(running, ranking.running_total_by_month(orders, lines, customers, "1998-01-01"))
    finally:
        laid.drop()
    assert not any(spark.catalog.tableExists(n) for n in laid.names)


def _files(table):
    found = {}
    for at, _, names in os.walk(table.path.removeprefix("file:")):
        for name in names:
            if name.endswith(".parquet"):
                path = os.path.join(at, name)
                found[path] = (os.path.getmtime(path), os.path.getsize(path))
    return found


def _spoil(table, months):
    """Make the files of other months unreadable."""
    for path in _files(table):
        if not any(f"month={m}" in path for m in months):
            with open(path, "wb") as file:
                file.write(b"not parquet")


def test_only_the_months_asked_for_are_read(spark, facts):
    orders, lines = facts
    rows = lines.withColumn("item_id", F.col("order_id") % 5).join(orders, "order_id").drop("customer_id")
    table = write_by_month(rows, "order_date")
    expected = ordered(
        rows.filter("order_date between '1998-01-20' and '1998-02-03'").groupBy("item_id").agg(F.sum("quantity"), F.sum(sales.line_amount()))
    )
    quarter = ordered(
        rows.filter("quarter(order_date) = 2").groupBy(F.year("order_date"), F.month("order_date")).agg(F.sum(sales.line_amount()), F.count("*"))
    )
    report = sales.quarter_sales(table, 2, "1990-01-01", "2003-12-31")
    assert "dynamicpruningexpression" in physical_plan(report)
    _spoil(table, ["1998-01", "1998-02", "1998-04", "1998-05", "1998-06"])
    assert ordered(sales.item_quantities(table, "1998-01-20", "1998-02-03")) == expected
    assert ordered(report) == quarter
    with pytest.raises(Exception, match="(?i)parquet"):
        sales.item_quantities(table, "1997-11-20", "1997-12-03").collect()


def _rows(rng, ids):
    day = lambda: None if rng.random() < 0.1 else datetime.date(2020, 1, 1) + datetime.timedelta(days=rng.randrange(150))
    name = lambda: rng.choice(["Ann", "ann", "Bob", "Cy", None, "x" * 12])
    return [(i, name(), rng.choice([None, *range(8)]), day(), rng.choice([None, rng.randrange(-50, 900)])) for i in ids]


def _table(spark, rows):
    return spark.createDataFrame([(i, n, r, d, None if a is None else a / 1) for i, n, r, d, a in rows], SCHEMA.replace("decimal(18,2)", "double")).withColumn(
        "amount", F.col("amount").cast("decimal(18,2)")
    )


def test_a_merge_rewrites_its_months_only(spark):
    rng = random.Random(3)
    rows = _table(spark, _rows(rng, range(200)))
    january = F.col("day").between(F.lit("2020-01-01").cast("date"), F.lit("2020-01-31").cast("date"))
    table = write_by_month(rows, "day")
    source = rows.filter(january & (F.col("id") % 2 == 0)).withColumn("amount", F.lit(1).cast("decimal(18,2)"))
    source = source.unionByName(rows.filter(january & (F.col("id") % 9 == 0)).withColumn("id", F.col("id") + 5000))
    expected = mutation.merge(rows, source, ["id"], ["amount"])
    before = _files(table)
    log = partitioned.merge_months(table, source, ["id"], ["amount"])
    after = _files(table)
    assert {p for p in before if "month=2020-01-01" not in p} == {p for p in after if "month=2020-01-01" not in p}
    assert all(before[p] == after[p] for p in after if p in before) and set(before) != set(after)
    assert same(table.rows(), expected.snapshot) and same(log, expected.changes)
    # a month that loses all rows loses its folder; rows without a day are a folder of their own
    gone = partitioned.delete_months(table, january)
    assert gone.count() == expected.snapshot.filter(january).count() and not [p for p in _files(table) if "month=2020-01-01" in p]
    assert table.rows().filter(january).isEmpty() and not table.rows().filter("day is null").isEmpty()
    with pytest.raises(ValueError, match="other months"):
        table.replace(materialize(rows.limit(50), "rows"), [datetime.date(2020, 2, 1)])
    with pytest.raises(ValueError, match="of its own"):
        write_by_month(rows.withColumnRenamed("name", "month"), "day")


def test_generated_keys_follow_the_whole_table(spark):
    rows = _table(spark, [(900, "a", None, datetime.date(2020, 3, 1), 1), (1, "b", None, datetime.date(2020, 1, 1), 1)])
    table = write_by_month(rows, "day")
    partitioned.merge_months(table, rows.filter("id = 1").withColumn("name", F.lit("new")).drop("id"), ["name"], ["amount"], key="id")
    assert sorted(r.id for r in table.rows().collect()) == [1, 900, 901]


def _rules():
    return [quality.not_null("name"), quality.max_length("name", 5), quality.check("amount", F.col("amount") >= 0, F.col("amount"))]


def _all_violations(rows, parents):
    return (
        quality.row_violations(rows, "t", ["id"], _rules())
        .unionByName(quality.primary_key(rows, "t", ["id"]))
        .unionByName(quality.unique(rows, "t", ["name"]))
        .unionByName(quality.foreign_keys(rows, "t", ["id"], {"ref": (parents, "key")}))
    )


@pytest.mark.parametrize("seed", [1, 2])
def test_totals_and_violations_follow_the_log(spark, monkeypatch, seed):
    monkeypatch.setattr(joins, "LISTED_KEYS", 3 if seed == 1 else 1000)
    rng = random.Random(seed)
    rows = _rows(rng, [*range(60), *range(0, 60, 9), *([None] * 3)])
    table = write_by_month(_table(spark, rows), "day")
    parents = spark.createDataFrame([(k,) for k in range(5)], "key bigint")
    sums, month = {"total": F.col("amount")}, month_of("day")
    state = materialize(upkeep.totals(table.rows(), month, sums), "state")
    violations = materialize(_all_violations(table.rows(), parents), "violations")
    for step in range(4):
        parent_log = None
        if step == 0:
            log = partitioned.update_months(
                table, F.col("id") % 4 == seed, {"amount": F.col("amount") - 300, "day": F.add_months("day", 1), "ref": F.col("ref") + 1, "name": F.upper("name")}
            )
        elif step == 1:
            log = partitioned.delete_months(table, (F.col("id") % 5 == 0) | (F.col("name") == "Bob"))
        elif step == 2:
            log = partitioned.insert_months(table, _table(spark, _rows(rng, [*range(50, 70), 3, None])))
        else:  # a parent goes and one comes
            changed = spark.createDataFrame([(2,), (6,)], "key bigint")
            parent_log = partitioned.change_log(changed.filter("key = 2"), "DELETE").unionByName(partitioned.change_log(changed.filter("key = 6"), "INSERT"))
            parents = parents.filter("key <> 2").unionByName(changed.filter("key = 6"))
            log = partitioned.update_months(table, F.col("id") % 6 == 1, {"ref": F.lit(2).cast("bigint")})
        current = table.rows()
        state = materialize(upkeep.updated_totals(state, log, month, sums), "state")
        found = rechecks.row_rules(violations, log, "t", ["id"], _rules())
        found = rechecks.primary_key(found, log, current, "t", "id")
        found = rechecks.unique(found, log, current, "t", "name")
        found = rechecks.foreign_keys(found, log, current, "t", ["id"], {"ref": (parents, "key")}, {"ref": parent_log} if parent_log else None)
        violations = materialize(found, "violations")
        assert ordered(violations) == ordered(_all_violations(current, parents)), step
        assert ordered(state) == ordered(upkeep.totals(current, month, sums)), step


def test_following_the_log_reads_no_sales(spark):
    table = write_by_month(_table(spark, _rows(random.Random(5), range(80))), "day")
    sums, month = {"total": F.col("amount")}, month_of("day")
    state = materialize(upkeep.totals(table.rows(), month, sums), "state")
    violations = materialize(quality.row_violations(table.rows(), "t", ["id"], _rules()), "violations")
    log = partitioned.delete_months(table, F.col("id") % 3 == 0)
    totals = upkeep.updated_totals(state, log, month, sums)
    found = rechecks.row_rules(violations, log, "t", ["id"], _rules())
    expected = ordered(totals), ordered(found)
    _spoil(table, [])
    assert (ordered(totals), ordered(found)) == expected
    name = os.path.basename(table.path)
    assert name not in physical_plan(totals) and name not in physical_plan(found)


def test_floating_sums_are_refused(spark):
    state = spark.createDataFrame([(datetime.date(2020, 1, 1), 1, 0.5)], "month date, rows bigint, total double")
    log = partitioned.change_log(_table(spark, _rows(random.Random(1), [1])), "INSERT")
    with pytest.raises(ValueError, match="floating"):
        upkeep.updated_totals(state, log, month_of("day"), {"total": F.col("amount")})
