"""Work tables in the folder all executors share.

A work table cuts lineage: it is written once, survives the loss of executors and reads back
with the same rows every time, which range-partitioned jobs need (their boundaries are sampled).
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def work_root(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; a temporary one only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if context.master.partition("[")[0] != "local":  # local-cluster has executors of its own
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder that every executor can reach"
            )
        context.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerloom-"))
    return context.getCheckpointDir()


_scopes: list[str] = []


@contextmanager
def work_scope(spark: SparkSession) -> Iterator[str]:
    """Work tables made inside go to a folder of their own, which is deleted at the end.

    Results are lazy: write or collect them before the scope ends.
    """
    path = f"{work_root(spark)}/scope-{uuid.uuid4().hex}"
    _scopes.append(path)
    try:
        yield path
    finally:
        _scopes.remove(path)
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def new_work_path(spark: SparkSession, label: str) -> str:
    root = _scopes[-1] if _scopes else work_root(spark)
    return f"{root}/{label}-{uuid.uuid4().hex}"


def settled(spark: SparkSession, label: str, build: Callable[[], DataFrame]) -> DataFrame:
    """What ``build`` returns, as a work table; those made on the way to it are deleted at once."""
    path = new_work_path(spark, label)
    with work_scope(spark):
        df = build()
        df.write.parquet(path)
        schema = df.schema
    return spark.read.schema(schema).parquet(path)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a work table and return the table."""
    spark = df.sparkSession
    path = new_work_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
