"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Joins here are fact-to-unique-key joins, so a hot key is always on one side and the adaptive
# skew-join rule can split it. Forcing it accepts one more shuffle where the split would
# otherwise be skipped to keep a partitioning.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(
    app_name: str = "ledgerloom",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **extra: str,
) -> SparkSession:
    """Session with the adaptive settings above.

    On a cluster leave ``master`` to spark-submit and give ``shuffle_partitions`` generously (two to
    three per core, or input bytes / 128 MB); the adaptive rules merge the small ones.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**ADAPTIVE, **extra}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()
