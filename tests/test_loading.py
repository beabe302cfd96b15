"""UTF-16 files cut at their line ends, rejects, and JSON documents parsed once."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.json_path import json_query, json_value
from ledgerloom.functions.variants import explode_at, fragment_at, scalar_at, texts_at, with_variant
from ledgerloom.plans import documents
from ledgerloom.sources.delimited import export_delimited, load_delimited, load_delimited_split, write_lines
from tests.conftest import ordered, physical_plan, rows, same

SCHEMA = "id int, name string"
# the second byte of the first and the first byte of the second read like a line end
FALSE_END = "\u0a85\u4e00"


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1001")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def _write(folder, name, lines, line_end="\n"):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes("".join(line + line_end for line in lines).encode("utf-16-le", "surrogatepass"))


@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
def test_one_file_is_many_tasks_and_no_character_is_cut(spark, tmp_path, small_splits, line_end):
    chance = random.Random(5)
    names = ["".join(chance.choice([FALSE_END, "a", "\u4e00", "\U0001f600", "\u0a0a", "\u0100"]) for _ in range(chance.randint(1, 30))) for _ in range(700)]
    names[40] = FALSE_END * 900  # longer than several splits
    names[41] = "\u0a00" + FALSE_END
    _write(tmp_path / "in", "a.txt", [f"{i}@{n}" for i, n in enumerate(names)], line_end)
    _write(tmp_path / "in", "b.txt", [f"{i}@plain" for i in range(1000, 1300)], line_end)
    assert spark.read.text(str(tmp_path / "in")).rdd.getNumPartitions() > 20
    found = load_delimited_split(spark, str(tmp_path / "in"), SCHEMA, line_end=line_end)
    assert found.rejects.isEmpty()
    assert sorted(rows(found.rows)) == [*enumerate(names), *((i, "plain") for i in range(1000, 1300))]


def test_split_and_whole_load_agree_on_an_export(spark, tmp_path, small_splits):
    data = [(i, v) for i, v in enumerate([None, "", " x ", 'say ""', "a@b", "\u0001x", FALSE_END] * 30)]
    df = spark.createDataFrame(data, SCHEMA).coalesce(1)
    export_delimited(df, str(tmp_path / "out"))
    found = load_delimited_split(spark, str(tmp_path / "out"), SCHEMA)
    assert found.rejects.isEmpty() and found.rows.dtypes == df.dtypes
    assert same(found.rows, df) and same(found.rows, load_delimited(spark, str(tmp_path / "out"), SCHEMA))


def test_good_and_rejected_lines_add_up(spark, tmp_path):
    lines = ["1@a", "x@a", "2", "3@a@b", '4@"open', '5@"q""q"', "6@half \ud83d", "\udc00@7", "8@\U0001f600", "", f"9@{FALSE_END}", "99999999999@big"]
    _write(tmp_path / "in", "a.txt", lines)
    (tmp_path / "in" / "b.txt").write_bytes("10@b\n11@c".encode("utf-16-le")[:-1])
    (tmp_path / "in" / "empty.txt").write_bytes(b"")
    found = load_delimited_split(spark, str(tmp_path / "in"), SCHEMA)
    assert sorted(rows(found.rows)) == [(1, "a"), (5, 'q"q'), (8, "\U0001f600"), (9, FALSE_END), (10, "b")]
    reasons = ordered(found.rejects.groupBy("reason").count())
    assert reasons == [("half a character", 3), ("not a valid row", 4), ("quote left open", 1)]
    assert {r.record for r in found.rejects.filter("reason = 'not a valid row'").collect()} == {"x@a", "2", "3@a@b", "99999999999@big"}
    assert found.rejects.filter("file like '%b.txt'").count() == 1


def test_a_file_out_of_step_is_rejected_in_pieces(spark, tmp_path):
    """A stray byte puts every later line end at an odd place: no line of unbounded length is built."""
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.txt").write_bytes("1@a\n".encode("utf-16-le") + b"z" + "".join(f"{i}@b\n" for i in range(500)).encode("utf-16-le"))
    found = load_delimited_split(spark, str(folder), SCHEMA, longest_line=1000)
    assert rows(found.rows) == [(1, "a")]
    assert {r.reason for r in found.rejects.collect()} == {"line ends at odd bytes"} and found.rejects.count() >= 500


def test_lines_are_written_as_they_are(spark, tmp_path):
    lines = ['1@"open', "2@a,b", "3@ x ", "4@\\n"]
    write_lines(spark.createDataFrame([(v,) for v in lines], "line string").coalesce(1), str(tmp_path / "out"))
    (part,) = (tmp_path / "out").glob("part-*")
    assert part.read_bytes().decode("utf-16-le").splitlines() == lines


DOCUMENTS = [
    '{"a": "x", "t": ["p", "Q", 3, null], "o": {"k": 1}}',
    '{"a": "[not an array]", "t": []}',
    '{"a": {"b": 1}, "t": "scalar"}',
    '{"a": 7, "t": ["\u0451\u043b\u043a\u0430", "p"]}',
    "not json", "", None, "null", "{}",
]


def test_paths_of_a_variant_are_those_of_the_text(spark):
    df = with_variant(spark.createDataFrame(list(enumerate(DOCUMENTS)), "id int, doc string"), "doc", "v")
    for path in ("$.a", "$.t[0]", "$.t[2]", "$.o.k", "$.o", "$.missing"):
        both = df.select(scalar_at(F.col("v"), path).alias("one"), json_value(F.col("doc"), path).alias("two"))
        assert all(one == two for one, two in rows(both)), path
        both = df.select(fragment_at(F.col("v"), path).alias("one"), F.to_json(F.try_parse_json(json_query(F.col("doc"), path))).alias("two"))
        assert all(one == two for one, two in rows(both)), path
    assert ordered(explode_at(df, "v", "$.t", "tag").select("id", "tag")) == ordered(
        spark.createDataFrame([(0, "p"), (0, "Q"), (0, "3"), (0, None), (3, "\u0451\u043b\u043a\u0430"), (3, "p")], "id int, tag string")
    )
    assert [r[0] for r in rows(df.orderBy("id").select(texts_at(F.col("v"), "$.t")))][:2] == [["p", "Q", "3", None], []]


def test_a_document_is_parsed_once(spark, catalog):
    for df in (documents.json_fields_variant(catalog.item_fields), documents.json_tag_search_variant(catalog.item_fields, "ring")):
        plan = physical_plan(df)
        assert plan.count("parse_json") + plan.count("parseJson") == 1, plan
        assert "Exchange" not in plan
