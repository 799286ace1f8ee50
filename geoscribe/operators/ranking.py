"""Top-k keys, semi join on them, top-n inside each group, wide rows, maps.

Ties are broken by a stated rule everywhere (count descending, then key or
word ascending), so results do not depend on partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoscribe.operators.groups import count_by_key, rank_order


def top_keys(df: DataFrame, key: str, k: int, n: str = "n") -> DataFrame:
    """The ``k`` largest groups (the reference's ``zipWithIndex`` + ``index < k``)."""
    return count_by_key(df, key, n).orderBy(*rank_order(key, n)).limit(k)


def semi_join_keys(df: DataFrame, keys: DataFrame, key: str, bounded: bool = True) -> DataFrame:
    """Rows of ``df`` whose key is one of ``keys``.

    ``bounded=True`` states that the key set has a proven size bound (the
    result of ``top_keys``: at most ``k`` rows).  It is then broadcast, so the
    large side is filtered where it is scanned, with no shuffle.  For a key
    set that grows with the data pass ``bounded=False``: the optimizer then
    chooses between broadcast and a shuffled semi join by its size estimate.
    """
    right = keys.select(key)
    return df.join(F.broadcast(right) if bounded else right, on=key, how="left_semi")


def top_n_per_group(counts: DataFrame, group: str, item: str, k: int, n: str = "n",
                    rank: str = "rank") -> DataFrame:
    """Rank items inside each group by (n desc, item asc) and keep rank <= k.

    ``row_number() <= k`` lets Catalyst insert a partial WindowGroupLimit below
    the exchange: each map task forwards at most ``k`` rows per group, so a
    group with a huge vocabulary never reaches one task whole.
    """
    w = Window.partitionBy(group).orderBy(F.col(n).desc(), F.col(item).asc())
    return counts.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def wide_rows(ranked: DataFrame, group: str, item: str, n: str = "n", rank: str = "rank",
              out: str = "top_words", sep: str = "\t") -> DataFrame:
    """One row per group: ``item<sep>n`` pairs in rank order joined by ``sep``.

    Input must already be cut to a bounded rank (``top_n_per_group``), so the
    list per group has at most ``k`` entries.
    """
    pairs = F.array_sort(F.collect_list(F.struct(F.col(rank).alias("r"), F.col(item).alias("w"),
                                                 F.col(n).alias("c"))))
    joined = F.array_join(F.transform(pairs, lambda s: F.concat_ws(sep, s["w"], s["c"].cast("string"))), sep)
    return ranked.groupBy(group).agg(joined.alias(out))


def counts_table(df: DataFrame, outer: str, key: str, n: str = "n") -> DataFrame:
    """``(outer, key, n)``: the counts as rows, whatever the number of keys per ``outer`` value; NULL keys included."""
    return count_by_key(df, [outer, key], n)


def top_counts_map(df: DataFrame, outer: str, key: str, k: int, n: str = "n", out: str = "counts") -> DataFrame:
    """Per ``outer`` value a ``map<key, count>`` of its ``k`` most frequent non-NULL keys (ties by key).

    The limit is applied to the counted rows, partly before the shuffle, so no value
    ever holds more than ``k`` entries, however many keys a group has.
    """
    counts = counts_table(df.where(F.col(key).isNotNull()), outer, key, n)
    ranked = top_n_per_group(counts, outer, key, k, n)
    return ranked.groupBy(outer).agg(F.map_from_entries(F.collect_list(F.struct(key, n))).alias(out))


def counts_as_map(df: DataFrame, outer: str, key: str, n: str = "n", out: str = "counts",
                  null_n: str = "n_null") -> DataFrame:
    """Per ``outer`` value, a ``map<key, count>`` (the reference's ``collectAsMap``).

    The map is built per group of ``outer`` from already aggregated counts, so a
    map holds one entry per distinct ``key`` of that group, never raw rows.  For keys of a
    known small domain; otherwise ``counts_table`` or ``top_counts_map``.  Map keys cannot be NULL, so rows with a NULL
    key are counted in ``null_n``; a group with no other key has an empty map.
    """
    counts = count_by_key(df, [outer, key], n)
    entry = F.when(F.col(key).isNotNull(), F.struct(F.col(key), F.col(n)))     # collect_list leaves NULL out
    return counts.groupBy(outer).agg(
        F.map_from_entries(F.collect_list(entry)).alias(out),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col(n))), F.lit(0)).alias(null_n))


def map_as_text(m: Column) -> Column:
    """``k=v`` entries sorted by key, comma separated (a stable text form of a map)."""
    entries = F.array_sort(F.map_entries(m))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
