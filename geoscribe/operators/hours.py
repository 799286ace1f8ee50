"""Rows per group and local hour, where the group and the offset belong to the row's key.

The offset of a key (seconds added to UTC) shifts its rows by whole slots of
``slot`` seconds, the greatest common divisor of an hour and all offsets: an hour
for whole-hour offsets, a quarter for real time zones.  Rows of one key and slot
of the day are therefore interchangeable, and 24 hours / ``slot`` counts (a
histogram) are all that a key needs.

Keys are joined to their group either by broadcast (a small table; or the hot
keys, by ``joins.hot_keys``): rows then become one histogram per task and group
in the scan stage; or, for the other keys of a large table, as per-key histograms.
No raw row is shuffled, and no key is more than one histogram per task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoscribe.functions.time import local_hour_from_second_of_day
from geoscribe.operators import joins

HOUR = 3600


def slot_seconds(dim: DataFrame, offset: str) -> int:
    """Greatest common divisor of an hour and all offsets (at most an hour's worth of distinct remainders)."""
    rest = dim.select(F.pmod(F.col(offset).cast("int"), F.lit(HOUR)).alias("r")).where("r > 0").distinct()
    return math.gcd(HOUR, *[r.r for r in rest.collect()])


def hour_histogram(rows: DataFrame, key: str, second: Column, dim: DataFrame, dim_key: str, group: str, offset: str,
                   hour: str = "hour", n: str = "n", max_rows: int | None = None,
                   max_hot: int = joins.MAX_HOT_KEYS, slot: int | None = None) -> DataFrame:
    """``(group, hour, n)`` of all rows whose ``key`` is in ``dim`` (unique per ``dim_key``).

    ``second`` is the row's second of the day in UTC.  ``max_rows`` bounds the broadcast of
    ``dim``; beyond it only the rows of hot keys of the table are broadcast.
    """
    slot = slot or slot_seconds(dim, offset)
    slots = rows.select(F.col(key).alias("_key"), F.floor(second / slot).cast("int").alias("_slot"))
    who = dim.select(F.col(dim_key).alias("_dim_key"), F.col(group), F.col(offset).alias("_offset"))
    local = local_hour_from_second_of_day(F.col("_slot") * slot, "_offset").alias(hour)
    same = F.col("_key") == F.col("_dim_key")

    def per_group(joined: DataFrame, weight: Column) -> DataFrame:
        return joined.groupBy(group, local).agg(F.sum(weight).alias("_w"))

    def of_few(rows: DataFrame, few: DataFrame) -> DataFrame:
        return per_group(rows.join(F.broadcast(few), same), F.lit(1))

    if joins.within_bounds(who, max_rows):
        parts = of_few(slots, who)
    else:
        hot = F.broadcast(joins.hot_keys(slots, ["_key"], max_hot))
        few = who.join(hot, F.col("_dim_key") == F.col("_hot_0"), "left_semi")
        others = slots.join(hot, F.col("_key") == F.col("_hot_0"), "left_anti")
        counted = others.groupBy("_key", "_slot").agg(F.count(F.lit(1)).alias("_c"))
        parts = of_few(slots, few).unionByName(per_group(counted.join(who, same), F.col("_c")))
    return parts.groupBy(group, hour).agg(F.sum("_w").cast("bigint").alias(n))
