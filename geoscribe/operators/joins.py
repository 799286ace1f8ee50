"""Broadcast behind a size check.

Spark broadcasts a join side when its size *estimate* is small, but the
estimate is often useless for exactly the inputs that are small: a table
built from a Python list has no statistics, and ``distinct()`` over a large
table keeps the large table's estimate.  The join is then planned as a
sort-merge join that shuffles the whole large side by the join key (every
token of a corpus, say) before AQE notices at run time that the other side was
tiny.

``checked_broadcast`` is for inputs that are parameters rather than data (a
stop-word list, the words of a batch of queries): it counts them (one small
job over a small input) and broadcasts them only when the count is within a
row and byte
bounds, so the large side is filtered where it is scanned.  Beyond the bound
the DataFrame is returned as is, and the join is planned as a shuffled join.
Key sets derived from the large data itself are not counted this way (that
would cost another pass over the data); their joins are left to the optimizer.

``bloom_anti_join`` is the way beyond the bound for anti joins: a Bloom filter of
bounded size lets rows that are surely not in the key set pass where they are
scanned.  ``hot_key_join`` keeps a skewed join off single tasks: keys above a share of the
rows are found by a partial count and joined by broadcast, the rest by shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoscribe.session import materialize

# At most this many rows, and bytes of values as text, are broadcast.
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 << 20


def within_bounds(df: DataFrame, max_rows: int | None = None, max_bytes: int | None = None) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes of values."""
    max_rows = MAX_BROADCAST_ROWS if max_rows is None else max_rows
    max_bytes = MAX_BROADCAST_BYTES if max_bytes is None else max_bytes
    sizes = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns]
    width = sum(sizes[1:], sizes[0]).cast("long")
    n, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(width)).first()
    return n <= max_rows and (size or 0) <= max_bytes


def checked_broadcast(df: DataFrame, max_rows: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """``broadcast(df)`` if it is within the bounds, else ``df`` unchanged."""
    return F.broadcast(df) if within_bounds(df, max_rows, max_bytes) else df


#: Words of 64 bits of a Bloom filter: at most this many rows (16 bytes each) are broadcast, whatever the key set.
BLOOM_WORDS = 1 << 20
#: Bits per key; all four lie in one word, so a row looks up one.
BLOOM_BITS = 4


def _bloom_word(key: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(words))


def _bloom_mask(key: Column) -> Column:
    """A long with up to ``BLOOM_BITS`` bits set, from a second hash of the key."""
    h = F.xxhash64(F.lit("mask"), key)
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int"))
            for i in range(BLOOM_BITS)]
    mask = bits[0]
    for b in bits[1:]:
        mask = mask.bitwiseOR(b)
    return mask


def bloom_words(keys: DataFrame, words: int = BLOOM_WORDS) -> DataFrame:
    """``(_word, _bits)``: the Bloom filter of a one-column key set, one row per word in use."""
    key = F.col(keys.columns[0])
    return (keys.where(key.isNotNull()).select(_bloom_word(key, words).alias("_word"), _bloom_mask(key).alias("_mask"))
            .groupBy("_word").agg(F.bit_or("_mask").alias("_bits")))


def bloom_anti_join(df: DataFrame, keys: DataFrame, on: str, words: int = BLOOM_WORDS) -> DataFrame:
    """Rows of ``df`` whose ``on`` is not in the one-column ``keys``, for a key set past the broadcast bound.

    A filter of at most ``words`` 64-bit words is broadcast and every row
    looks up one word.  A row whose bits are not all set is surely not in the set.
    For the others the question is decided once per distinct value: values that pass
    the filter are reduced to distinct ones on the map side and anti-joined with
    the keys, which leaves the filter's false positives, a few per cent of the
    values outside the set (all of them if the set is far larger than the filter).
    Rows with those values pass too; they are broadcast behind the usual check, and
    only beyond it are the rows that passed the filter shuffled to meet them,
    heavy values apart.  A NULL is in no key set, so its rows stay.
    """
    key = F.col(on)
    filter_ = F.broadcast(bloom_words(keys, words))
    tagged = df.withColumn("_word", _bloom_word(key, words)).join(filter_, "_word", "left")
    maybe = key.isNotNull() & (F.coalesce("_bits", F.lit(0)).bitwiseAND(_bloom_mask(key)) == _bloom_mask(key))
    tagged = tagged.withColumn("_maybe", maybe).select(*df.columns, "_maybe")
    members = keys.select(F.col(keys.columns[0]).alias(on))
    passed = tagged.where("_maybe").select(on).distinct().join(members, on, "left_anti")
    passed = materialize(passed.select(F.col(on).alias("_value"), F.lit(True).alias("_passed")), "filter_false_positives")
    if within_bounds(passed):
        judged = tagged.join(F.broadcast(passed), key == F.col("_value"), "left")
        return judged.where(~F.col("_maybe") | F.col("_passed")).select(*df.columns)
    sure = tagged.where(~F.col("_maybe")).select(*df.columns)
    unsure = tagged.where("_maybe").select(*df.columns)
    return sure.unionByName(hot_key_join(unsure, passed, [(on, "_value")]).select(*df.columns))


def anti_join(df: DataFrame, keys: DataFrame, on: str, max_rows: int | None = None) -> DataFrame:
    """Rows of ``df`` whose ``on`` is not in the one-column ``keys``; duplicates and NULLs kept, rows not shuffled."""
    keys = keys.select(F.col(keys.columns[0]).alias(on))
    if within_bounds(keys, max_rows):
        return df.join(F.broadcast(keys), on, "left_anti").select(*df.columns)
    return bloom_anti_join(df, keys, on)


#: A key is hot when it holds more than one in this many rows, so there are fewer hot keys than that.
MAX_HOT_KEYS = 1_000


def _equal(left: DataFrame, right: DataFrame, on: list[tuple[str, str]]) -> Column:
    cond = None
    for a, b in on:
        c = left[a].eqNullSafe(right[b])
        cond = c if cond is None else cond & c
    return cond


def hot_keys(df: DataFrame, keys: list[str], max_hot: int = MAX_HOT_KEYS) -> DataFrame:
    """The keys that hold more than one in ``max_hot`` rows, as ``_hot_0`` ..: fewer than ``max_hot`` rows.

    One partial count per key and task crosses the network.  The result is written
    (it is tiny) because every user of it reads it more than once.
    """
    named = [F.col(k).alias(f"_hot_{i}") for i, k in enumerate(keys)]
    counts = df.groupBy(*named).agg(F.count(F.lit(1)).alias("_n"))
    total = df.select(F.count(F.lit(1))).scalar()
    return materialize(counts.where(F.col("_n") * max_hot > total).drop("_n"), "hot_keys")


def hot_key_join(left: DataFrame, right: DataFrame, on: list[tuple[str, str]], how: str = "inner",
                 max_hot: int = MAX_HOT_KEYS) -> DataFrame:
    """Join rows to a table that is unique per key, with the hot keys of ``left`` apart.

    ``on`` pairs a left with a right column; null equals null, and the right key
    columns are dropped.  ``how`` is ``inner`` or ``left``.  The rows of ``right``
    for hot keys (fewer than ``max_hot``, by the definition of hot) are
    broadcast, so rows of a hot key are joined where they are read and never
    land in one task.  The others meet in a shuffled join in which no key has
    more than one in ``max_hot`` of the rows.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how}")
    hot = F.broadcast(hot_keys(left, [a for a, _ in on], max_hot))
    at_left = [(a, f"_hot_{i}") for i, (a, _) in enumerate(on)]
    at_right = [(b, f"_hot_{i}") for i, (_, b) in enumerate(on)]
    few = F.broadcast(right.join(hot, _equal(right, hot, at_right), "left_semi"))
    # The few rows of ``right`` hold hot keys only: an inner join with them needs no choice of rows before it.
    of_hot = left if how == "inner" else left.join(hot, _equal(left, hot, at_left), "left_semi")
    others = left.join(hot, _equal(left, hot, at_left), "left_anti")
    drop = [b for _, b in on]
    joined = [side.join(dim, _equal(side, dim, on), how).drop(*drop) for side, dim in ((of_hot, few), (others, right))]
    return joined[0].unionByName(joined[1])


def dimension_join(fact: DataFrame, dim: DataFrame, on: list[tuple[str, str]], how: str = "inner",
                   max_rows: int | None = None) -> DataFrame:
    """Join rows to a table that is unique per key: broadcast if its size is within the bounds, else by ``hot_key_join``."""
    if within_bounds(dim, max_rows):
        small = F.broadcast(dim)
        return fact.join(small, _equal(fact, small, on), how).drop(*[b for _, b in on])
    return hot_key_join(fact, dim, on, how)
