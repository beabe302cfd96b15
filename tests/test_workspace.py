import os

import pytest

from ledgerloom.sources.workspace import materialize, work_root, work_scope
from tests.conftest import same


class Session:
    """Only what work_root asks of a session."""

    def __init__(self, master, configured=None):
        self.conf = {"spark.checkpoint.dir": configured}
        self.sparkContext = self
        self.master = master
        self.folder = None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_configured_folder_is_used_everywhere():
    assert work_root(Session("yarn", "hdfs://shared/work/")) == "hdfs://shared/work"
    assert work_root(Session("local[2]", "/shared")) == "/shared"


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_root(Session("spark://host:7077"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_root(Session("local-cluster[3,2,1024]"))


def test_local_mode_makes_one_folder():
    session = Session("local[2]")
    assert work_root(session) == work_root(session) == session.folder


def test_work_table_keeps_rows_and_types(spark):
    df = spark.sql("SELECT id, CAST(NULL AS STRING) AS t, CAST(id AS DECIMAL(18,2)) AS m FROM range(5)")
    table = materialize(df, "t")
    assert table.dtypes == df.dtypes and same(table, df)
    assert "Range" not in table._jdf.queryExecution().executedPlan().toString()


def test_scope_deletes_its_work_tables(spark):
    with work_scope(spark) as path:
        table = materialize(spark.range(3), "t")
        assert table.count() == 3 and os.listdir(path.removeprefix("file:"))
    assert not os.path.exists(path.removeprefix("file:"))
    assert os.path.dirname(path) == work_root(spark)
