"""Table scans, scratch tables and literal rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Loaded:
    """Good rows, and rejected records with their file and a reason. Every record is in one of them."""

    rows: DataFrame
    rejects: DataFrame


def read_table(spark: SparkSession, folder: str, name: str, schema: StructType | str) -> DataFrame:
    """Scan with a declared schema, so that building a query starts no job to look at the files."""
    return spark.read.schema(schema).parquet(f"{folder}/{name}.parquet")


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: StructType | str) -> DataFrame:
    """A few rows written in the program, with a declared schema."""
    return spark.createDataFrame(list(rows), schema)


def create_table_from(
    df: DataFrame, path: str, top: int | None = None, order: Sequence[Column] = ()
) -> DataFrame:
    """Create a new table at ``path`` from a query; fails if one is there.

    ``top`` keeps the first rows by ``order``, as a scratch copy of a few rows does.
    """
    if order:
        df = df.orderBy(*order)
    if top is not None:
        df = df.limit(top)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def create_table(spark: SparkSession, name: str, columns: str, path: str | None = None) -> None:
    """Create an empty catalog table, in the warehouse or at ``path``."""
    place = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet{place}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def read_back(df: DataFrame, *order: Column) -> DataFrame:
    """Every row of a changed table, in key order."""
    return df.orderBy(*order)
