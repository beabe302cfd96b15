"""The registered queries: names, results against SQL, and the pipeline's stages."""

import os
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_file
import corpus_pipeline
from ledgerloom.llm.oracle import ORACLE
from ledgerloom.llm.queries import QUERIES
from ledgerloom.sources.workspace import materialize, work_scope


def test_every_operator_has_one_query():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry_file.queries())
    assert set(ORACLE) <= set(entry_file.oracle_sql())


@pytest.mark.parametrize("name", list(ORACLE))
def test_queries_match_sql(spark, folder, name):
    connection = duckdb.connect()
    for file in os.listdir(folder):
        connection.execute(f"CREATE VIEW {file.partition('.')[0]} AS SELECT * FROM '{folder}/{file}'")
    expected = connection.execute(ORACLE[name])
    columns = [c[0] for c in expected.description]
    found = QUERIES[name](spark, folder)
    assert sorted(found.columns) == sorted(columns)
    assert sorted(map(repr, map(tuple, found.select(*columns).collect()))) == sorted(map(repr, expected.fetchall()))


def test_pipeline_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    quality = spark.read.parquet(f"{folder}/labels.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, folder), "stage")
        assert docs.columns == columns
        if name != "mixing":
            assert 0 < docs.count() <= before and docs.count() == docs.select("doc_id").distinct().count()
            before = docs.count()
        if name == "quality classifier":
            good = quality.filter("quality = 1").count()
            assert docs.join(quality.filter("quality = 1"), "doc_id").count() >= 0.97 * good
        if name == "exact dedup":
            assert docs.select(F.regexp_replace("text", r"\s+", " ")).distinct().count() == before
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert sorted(r.position for r in packed.select("position").collect()) == list(range(docs.count()))
    assert packed.count() == docs.count() and packed.filter("length > 0 and batch is null").isEmpty()


def test_stages_leave_no_copies_of_the_documents(spark, folder, tmp_path):
    """A stage leaves a small table behind its result: row numbers, not texts."""
    source = f"{folder}/documents.parquet"
    docs, texts = spark.read.parquet(source), os.path.getsize(source)
    for name, stage in corpus_pipeline.STAGES[1:4]:
        with work_scope(spark) as path:
            rows = stage(spark, docs, folder)
            left = sum(os.path.getsize(os.path.join(at, f)) for at, _, files in os.walk(path) for f in files)
            assert left < texts / 4, name
            assert rows.count() > 0


def test_pipeline_of_nothing(spark, folder, tmp_path):
    for table in ("documents", "labels"):
        spark.read.parquet(f"{folder}/{table}.parquet").filter(F.lit(False)).write.parquet(str(tmp_path / f"{table}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
