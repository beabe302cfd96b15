import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.text import starts_with_text
from ledgerloom.operators import joins, mutation
from ledgerloom.operators.mutation import merge
from ledgerloom.plans import changes
from ledgerloom.sources.delimited import export_delimited, load_delimited
from ledgerloom.sources.tables import (
    create_table,
    create_table_from,
    drop_table,
    literal_rows,
    read_back,
)
from tests.conftest import ordered, rows, same


@pytest.fixture
def people(spark):
    return literal_rows(
        spark,
        [(1, "ann", 10), (2, "TEST_bob", 20), (3, "test_cid", None), (5, None, 50)],
        "id bigint, name string, score int",
    )


def test_insert_generates_keys_after_the_highest(spark, people):
    new = spark.createDataFrame([("x",), ("y",)], "name string")
    found = mutation.insert_rows(people, new, "id", [F.col("name")])
    assert rows(found.filter("id > 5").orderBy("id")) == [(6, "x", None), (7, "y", None)]
    assert found.count() == 6


def test_insert_into_an_empty_table_with_defaults(spark, people):
    new = spark.createDataFrame([("x", None), ("y", 4)], "name string, score int")
    found = mutation.insert_rows(
        mutation.delete_all(people), new, "id", [F.col("name")], {"score": F.lit(0)}
    )
    assert ordered(found) == [(1, "x", 0), (2, "y", 4)]


def test_top_changes_pick_by_key(people):
    is_test = starts_with_text(F.col("name"), "Test")
    assert ordered(mutation.delete_top(people, is_test, 1, "id").select("id")) == [(1,), (3,), (5,)]
    found = mutation.update_top(people, is_test, 1, "id", {"name": F.lit("2Test")})
    assert ordered(found.select("id", "name")) == [(1, "ann"), (2, "2Test"), (3, "test_cid"), (5, None)]
    assert found.schema == people.schema or found.dtypes == people.dtypes


def test_many_picked_keys_give_the_same(spark, people, monkeypatch):
    has_score = F.col("score").isNotNull()
    source = spark.createDataFrame([("ann", 10), ("zoe", 7), ("yan", 8), (None, 1)], "name string, score int")

    def results():
        return [
            ordered(mutation.delete_top(people, has_score, 2, "id")),
            ordered(mutation.update_top(people, has_score, 2, "id", {"score": F.lit(0)})),
            ordered(merge(people, source, ["name"], ["score"], key="id").snapshot),
        ]

    few = results()
    monkeypatch.setattr(joins, "LISTED_KEYS", 1)
    assert results() == few
    assert [r[0] for r in few[0]] == [3, 5] and few[1][0] == (1, "ann", 0)


def test_rows_without_a_key_stay_when_others_are_picked(spark, monkeypatch):
    some = spark.createDataFrame([(None, "a"), (1, "a"), (1, "a"), (2, "a")], "id bigint, name string")
    for most in (1000, 0):
        monkeypatch.setattr(joins, "LISTED_KEYS", most)
        assert ordered(mutation.delete_top(some, F.col("name") == "a", 3, "id").select("id")) == [(2,), (None,)]
        found = mutation.update_top(some, F.col("name") == "a", 3, "id", {"name": F.lit("b")})
        assert ordered(found) == [(1, "b"), (1, "b"), (2, "a"), (None, "a")]


def test_changes_of_the_customers_start_few_jobs(spark, catalog):
    tracker, group = spark.sparkContext.statusTracker(), "customer-changes"
    spark.sparkContext.setJobGroup(group, group)
    try:
        changes.merge_scratch(changes.changed_customers(catalog.customers))
        assert len(tracker.getJobIdsForGroup(group)) <= 34
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_unknown_predicates_change_nothing(people):
    assert ordered(mutation.delete_where(people, F.col("score") > 15).select("id")) == [(1,), (3,)]
    found = mutation.update_where(people, F.col("score") > 15, {"score": F.col("score") + 1})
    assert ordered(found.select("id", "score")) == [(1, 10), (2, 21), (3, None), (5, 51)]


def test_merge_updates_inserts_and_logs(spark, people):
    source = spark.createDataFrame([("ann", 10), ("zoe", 7), (None, 1)], "name string, score int")
    result = merge(people, source, ["name"], ["score"], key="id")
    assert ordered(result.snapshot) == sorted(
        [(1, "ann", 10), (2, "TEST_bob", 20), (3, "test_cid", None), (5, None, 50), (6, None, 1), (7, "zoe", 7)],
        key=repr,
    )
    assert result.changes.columns == [
        "deleted_id", "deleted_name", "deleted_score", "action", "inserted_id", "inserted_name", "inserted_score",
    ]
    assert ordered(result.changes) == sorted(
        [
            (1, "ann", 10, "UPDATE", 1, "ann", 10),
            (None, None, None, "INSERT", 6, None, 1),
            (None, None, None, "INSERT", 7, "zoe", 7),
        ],
        key=repr,
    )


def test_merge_update_only_twice_is_the_same(spark, people):
    source = spark.createDataFrame([(1, "new")], "id bigint, name string")
    once = merge(people, source, ["id"], ["name"], key="id")
    twice = merge(once.snapshot, source, ["id"], ["name"], key="id")
    assert same(once.snapshot, twice.snapshot)
    assert ordered(twice.changes.select("action")) == [("UPDATE",)]


def test_merge_one_source_row_may_hit_many(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "a", 2)], "id bigint, name string, v int")
    source = spark.createDataFrame([("a", 9)], "name string, v int")
    assert ordered(merge(target, source, ["name"], ["v"], key="id").snapshot) == [(1, "a", 9), (2, "a", 9)]


def test_merge_by_name_ignores_case_on_request(spark, people):
    source = spark.createDataFrame([("ANN", 11), ("Test_Bob", 21)], "name string, score int")
    found = merge(people, source, ["name"], ["score"], key="id", ignore_case=True).snapshot
    assert ordered(found.filter("id < 3")) == [(1, "ann", 11), (2, "TEST_bob", 21)]
    assert found.count() == 4
    twice = spark.createDataFrame([("ann", 1), ("ANN", 2)], "name string, score int")
    with pytest.raises(ValueError, match="on name"):
        merge(people, twice, ["name"], ["score"], key="id", ignore_case=True)
    assert merge(people, source, ["name"], ["score"], key="id").snapshot.count() == 6


def test_merge_rejects_two_source_rows_for_one_target(spark, people):
    twice = spark.createDataFrame([("ann", 1), ("ann", 2)], "name string, score int")
    with pytest.raises(ValueError, match="several source rows"):
        merge(people, twice, ["name"], ["score"], key="id")
    unknown = spark.createDataFrame([("new", 1), ("new", 2)], "name string, score int")
    assert merge(people, unknown, ["name"], ["score"], key="id").snapshot.count() == 6


def test_delimited_round_trip_of_awkward_text(spark, tmp_path):
    schema = "id bigint, name string"
    df = spark.createDataFrame(
        [
            (1, "a@b"), (2, ""), (3, None), (4, 'say "hi"'), (5, "two\nlines"), (6, " padded "),
            (7, "Ёлка"), (8, "ਅĀ"), (9, "back\\slash"), (None, "no id"), (11, "'"),
            (12, '"'), (13, '\\"'), (14, "cr\rlf\r\nx"), (15, "a\\"), (16, "@"),
        ],
        schema,
    )
    path = str(tmp_path / "out")
    export_delimited(df.repartition(1), path, rows_per_file=4)
    assert len(list((tmp_path / "out").glob("part-*"))) == 4
    assert same(load_delimited(spark, path, schema), df)
    raw = next((tmp_path / "out").glob("part-*")).read_bytes()
    assert raw.decode("utf-16-le").count("@") >= 4


def test_bulk_round_trip_of_the_top_rows(catalog):
    assert changes.bulk_round_trip(catalog.customers, 10).count() == 10


def test_scratch_tables(spark, people, tmp_path):
    path = str(tmp_path / "scratch")
    copy = create_table_from(people, path, 2, [F.col("id").desc()])
    assert ordered(copy.select("id")) == [(3,), (5,)]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        create_table_from(people, path)
    assert [r[0] for r in rows(read_back(people, F.col("id").desc()))] == [5, 3, 2, 1]


def test_create_and_drop_table(spark):
    create_table(spark, "lists", "data STRING")
    literal_rows(spark, [("b,a",)], "data string").write.insertInto("lists")
    assert rows(spark.table("lists")) == [("b,a",)]
    drop_table(spark, "lists")
    drop_table(spark, "lists")
    assert not spark.catalog.tableExists("lists")
