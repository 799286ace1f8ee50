"""Parquet tables of a data directory (``<dir>/<name>.parquet``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, keys: list[str] = (), min_partitions: int | None = None) -> DataFrame:
    """Hash-spread a narrow scan before heavy per-row work (tokenising texts).

    A parquet row group cannot be split, so a small input stored as one row
    group is scanned by a single task.  When the scan has fewer partitions than
    the cluster can run at once, the rows are hash-partitioned on ``keys``
    (deterministic on retry, unlike round-robin).  On a large input the scan is
    already wider than the cluster and the DataFrame is returned unchanged: no
    extra shuffle.  Column pruning and filters still reach the scan below the
    repartition.
    """
    try:
        cores = df.sparkSession.sparkContext.defaultParallelism
        narrow = df.rdd.getNumPartitions() < cores
    except Exception:  # no SparkContext on this client (Spark Connect): leave the plan as is
        return df
    if not narrow:
        return df
    # Two tasks per core even out texts of very different lengths.
    target = min_partitions or 2 * cores
    return df.repartition(target, *keys) if keys else df.repartition(target)
