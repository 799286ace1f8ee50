"""Group operators: ranked sizes, size thresholds, centroids, peak hour.

All are algebraic aggregates (count, sum, avg, max of a struct), so Spark
combines on the map side before the shuffle; a key holding a third of all rows
costs one partial row per input partition, not a hot reducer.  No group is
ever materialised as a list (the reference's ``groupByKey`` + ``list``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoscribe.operators.joins import anti_join


def count_by_key(df: DataFrame, key: str | list[str], n: str = "n") -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(n))


def rank_order(key: str, n: str = "n") -> list[Column]:
    """The reference's stable double sort: count descending, then key ascending."""
    return [F.col(n).desc(), F.col(key).asc()]


def group_count_sorted(df: DataFrame, key: str, n: str = "n") -> DataFrame:
    """Rows per key ordered by (n desc, key asc)."""
    return count_by_key(df, key, n).orderBy(*rank_order(key, n))


def filtered_group_count(df: DataFrame, key: str, condition: Column, n: str = "n") -> DataFrame:
    """Rows per key among rows meeting ``condition`` (pushed to the scan), ranked."""
    return group_count_sorted(df.where(condition), key, n)


def small_groups(df: DataFrame, key: str, max_n: int, n: str = "n") -> DataFrame:
    """Keys with at most ``max_n`` rows (the reference's ``count < max_n + 1``)."""
    return count_by_key(df, key, n).where(F.col(n) <= max_n)


def without_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """All rows of ``df`` whose key is not in ``keys`` (``subtractByKey``); duplicates and NULL keys kept.

    For a key set that comes from other data than ``df``.  It may grow with that data, so
    its size is checked: broadcast, or a Bloom filter of bounded size first
    (``joins.anti_join``).  Either way the rows of ``df`` are judged where they are scanned.
    """
    return anti_join(df, keys.select(key), key)


def group_centroid(df: DataFrame, key: str, lat: str | Column, lon: str | Column, min_n: int,
                   lat_out: str = "lat", lon_out: str = "lon") -> DataFrame:
    """Mean latitude/longitude per key for keys with at least ``min_n`` rows.

    One aggregation with a HAVING: the threshold, both means and the 1:1 join
    of the reference collapse into a single partial/final aggregate.
    """
    lat_c = F.col(lat) if isinstance(lat, str) else lat
    lon_c = F.col(lon) if isinstance(lon, str) else lon
    return (df.groupBy(key)
            .agg(F.count(F.lit(1)).alias("_n"), F.avg(lat_c).alias(lat_out), F.avg(lon_c).alias(lon_out))
            .where(F.col("_n") >= min_n)
            .drop("_n"))


def centroid_by_join(df: DataFrame, key: str, lat: str | Column, lon: str | Column, max_small: int,
                     lat_out: str = "lat", lon_out: str = "lon") -> DataFrame:
    """The reference's plan shape (drop small keys, average latitude and longitude
    separately, join the two per-key results 1:1), with every step applied to
    per-key aggregates instead of raw rows.

    Both aggregates shuffle only partial aggregates and come out hash-partitioned
    on ``key``, so the inner join adds no exchange; the sizes ride along with the
    latitudes, so small keys go by a filter.
    """
    lat_c = F.col(lat) if isinstance(lat, str) else lat
    lon_c = F.col(lon) if isinstance(lon, str) else lon
    lat_df = df.groupBy(key).agg(F.avg(lat_c).alias(lat_out), F.count(F.lit(1)).alias("_n"))
    lon_df = df.groupBy(key).agg(F.avg(lon_c).alias(lon_out))
    return lat_df.where(F.col("_n") > max_small).drop("_n").join(lon_df, on=key, how="inner")


def join_aggregates(left: DataFrame, right: DataFrame, key: str, right_key: str) -> DataFrame:
    """Two tables' per-key aggregates joined 1:1; each table is scanned once and both aggregates
    come out hash-partitioned on the key, so the join adds no exchange."""
    renamed = right.withColumnRenamed(right_key, key) if right_key != key else right
    return left.join(renamed, on=key, how="inner")


def peak_of_counts(counts: DataFrame, key: str, hour: str, n: str = "n") -> DataFrame:
    """From ``(key, hour, n)`` counts, the hour with the largest ``n`` per key;
    a tie goes to the earlier hour (max of ``struct(n, -hour)``)."""
    best = counts.groupBy(key).agg(F.max(F.struct(F.col(n), (-F.col(hour)).alias("neg_hour"))).alias("_b"))
    return best.select(key, (-F.col("_b.neg_hour")).alias(hour), F.col("_b").getField(n).alias(n))


def peak_hour(df: DataFrame, key: str, hour: str | Column, hour_out: str = "hour", n: str = "n") -> DataFrame:
    """The busiest hour of each key and its row count; a tie goes to the earlier hour.

    Two algebraic aggregates: rows per (key, hour), then the max of
    ``struct(n, -hour)`` per key.  The second input has at most 24 rows per key,
    so no window sort over a large group is needed.
    """
    h = F.col(hour) if isinstance(hour, str) else hour
    per_hour = df.groupBy(F.col(key), h.alias(hour_out)).agg(F.count(F.lit(1)).alias(n))
    return peak_of_counts(per_hour, key, hour_out, n)
