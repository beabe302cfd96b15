"""Facts written in a layout that later jobs use: bucketed by their key, or partitioned by month."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from ledgerloom.sources.workspace import new_work_path

MONTH = "month"
# an order with more lines than this is kept apart from the buckets
HOT_LINES = 1_000_000


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str) -> DataFrame:
    """Write ``df`` as the catalog table ``name`` at ``path``, one file for each bucket of ``key``.

    The rows are dealt by the hash that bucketing uses, so every task writes one file. Joins and groupings on
    ``key`` of tables with the same number of buckets then need no shuffle.
    """
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


@dataclass(frozen=True)
class BucketedFacts:
    """Orders and lines bucketed by order; the lines of very large orders, and those orders, beside them.

    A bucket is read by one task, so an order with a large share of all lines must not be in one. Its lines lie
    in a plain table, where any number of tasks sum them; ``orders`` has all orders.
    """

    orders: DataFrame
    lines: DataFrame
    hot_orders: DataFrame
    hot_lines: DataFrame
    names: tuple[str, ...]

    def parts(self) -> list[tuple[DataFrame, DataFrame]]:
        """Pairs of orders and lines that hold every line once."""
        return [(self.orders, self.lines), (self.hot_orders, self.hot_lines)]

    def drop(self) -> None:
        """Take the tables out of the catalog; their files go with the work folder."""
        for name in self.names:
            self.orders.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")


def bucket_facts(orders: DataFrame, lines: DataFrame, buckets: int | None = None, hot_lines: int = HOT_LINES) -> BucketedFacts:
    """Write both facts once, bucketed by ``order_id``, for all reports that join or group by it.

    ``buckets`` is the number of shuffle partitions unless given. There are at most rows / ``hot_lines`` hot orders.
    """
    spark = orders.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = lines.groupBy("order_id").agg(F.count("*").alias("_lines")).filter(F.col("_lines") > hot_lines).select("order_id")
    path = new_work_path(spark, "hot-orders")
    orders.join(hot, "order_id", "left_semi").write.parquet(path)
    hot_orders = spark.read.schema(orders.schema).parquet(path)
    path = new_work_path(spark, "hot-lines")
    lines.join(hot_orders.select("order_id"), "order_id", "left_semi").write.parquet(path)
    rest = lines.join(hot_orders.select("order_id"), "order_id", "left_anti")
    names = tuple(f"{n}_{uuid.uuid4().hex}" for n in ("orders", "lines"))
    return BucketedFacts(
        save_bucketed(orders, names[0], "order_id", buckets, new_work_path(spark, "orders")),
        save_bucketed(rest, names[1], "order_id", buckets, new_work_path(spark, "lines")),
        hot_orders,
        spark.read.schema(lines.schema).parquet(path),
        names,
    )


def month_of(day: str | Column) -> Column:
    """First day of the month, the value that rows are laid out by."""
    return F.trunc((F.col(day) if isinstance(day, str) else day).cast("date"), "MM")


@dataclass(frozen=True)
class MonthTable:
    """A Parquet table in folders by month of its column ``day``; rows without a day have a folder of their own."""

    spark: SparkSession
    path: str
    schema: StructType
    day: str

    def read(self) -> DataFrame:
        """All rows with their ``month``. A filter or join on it reads only the folders it names."""
        whole = StructType([*self.schema.fields, StructField(MONTH, DateType())])
        return self.spark.read.schema(whole).parquet(self.path)

    def rows(self) -> DataFrame:
        return self.read().drop(MONTH)

    def between(self, first: str, last: str) -> DataFrame:
        """Rows of the days from ``first`` to ``last``, from the folders of their months only."""
        low, high = (F.lit(d).cast("date") for d in (first, last))
        months = F.col(MONTH).between(month_of(low), month_of(high))
        return self.read().filter(months & F.col(self.day).between(low, high)).drop(MONTH)

    def of_months(self, months: Sequence) -> DataFrame:
        """Rows of the folders of these months; None is that of the rows without a day."""
        named = [m for m in months if m is not None]
        wanted = F.col(MONTH).isin(named) if named else F.lit(False)
        if len(named) < len(months):
            wanted = wanted | F.col(MONTH).isNull()
        return self.read().filter(wanted).drop(MONTH)

    def append(self, rows: DataFrame) -> None:
        """Add files with ``rows``; no file there is touched."""
        self._written(rows).mode("append").parquet(self.path)

    def replace(self, rows: DataFrame, months: Sequence) -> None:
        """Make ``rows`` the content of ``months``; the folders of other months are not touched.

        ``rows`` must not be read from this table (write them first) and be of ``months`` only. Months without
        rows lose their folder. If the job fails, running it again with the same rows gives the same table.
        """
        kept = {r[0] for r in rows.select(month_of(self.day)).distinct().collect()}  # one row for each month
        if not kept <= set(months):
            raise ValueError(f"rows of other months: {sorted(map(str, kept - set(months)))}")
        self._written(rows).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(self.path)
        for month in set(months) - kept:
            name = "__HIVE_DEFAULT_PARTITION__" if month is None else month.isoformat()
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{MONTH}={name}")
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def _written(self, rows: DataFrame):
        laid = rows.select(*self.schema.names).withColumn(MONTH, month_of(self.day))
        # by range, so that a month of any size is spread over tasks and few months are in one
        return laid.repartitionByRange(MONTH, *self.schema.names[:1]).write.partitionBy(MONTH)


def write_by_month(df: DataFrame, day: str, path: str | None = None) -> MonthTable:
    """Write ``df`` by month of ``day`` to a new path."""
    if MONTH in df.columns:
        raise ValueError(f"a table laid out by month has no column {MONTH} of its own")
    spark = df.sparkSession
    table = MonthTable(spark, path or new_work_path(spark, "by-month"), df.schema, day)
    table._written(df).mode("errorifexists").parquet(table.path)
    return table
