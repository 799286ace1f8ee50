"""Proportional stratified interleaving into equal shards.

Rows of each source are shuffled by a seeded hash and ranked; row ``r`` of a
source with ``n`` rows gets the fractional rank ``(2r + 1) / 2n``.  All rows
sorted by fractional rank form one sequence in which every stretch holds each
source in its share of the corpus; it is cut into shards of equal counts (the
``rows`` law: at most one row apart).

No task ever sees a whole source or the whole sequence.  Equal rows are counted
(partial counts first) and numbered, and the number is hashed with the row, so
any number of them spreads evenly over the hash buckets.  The first rank is a
bucket offset plus the row number inside a (source, hash bucket) group of
about ``rows_per_bucket`` rows; the second likewise over buckets of the
fractional rank, whose sizes follow from the per-source counts by integer
arithmetic.  Offsets are running sums over groups of buckets, then inside each
group.  The narrow rows are written once, so texts are read once.

Nulls: a null source is a source of its own, a null text has size 16 and
checksum 0, a null id is shuffled like any value.  Repeated rows each get a
slot; equal rows are interchangeable.  An empty table gives no rows.  Texts of
any length count with their size only.  Columns of the input named like a
result are replaced, any other name may occur.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoscribe.llm.common import documents, materialize, null_safe

SHARDS = 40
SEED = 20_011
ROWS_PER_BUCKET = 2_000
ROW_OVERHEAD = 16
#: Numbers that one task makes of one row, and buckets whose running sum one task takes.
NUMBERS_AT_ONCE = 10_000
BUCKETS_AT_ONCE = 4_096


def _buckets(n_rows: int, rows_per_bucket: int) -> int:
    return max(1, -(-n_rows // rows_per_bucket))


def _numbered(rows: DataFrame, count: str, number: str) -> DataFrame:
    """Each row ``count`` times, numbered from 0; a large count is spread over tasks."""
    part = "_part"
    parts = rows.withColumn(part, F.explode(F.expr(f"sequence(0L, ({count} - 1) div {NUMBERS_AT_ONCE})")))
    parts = parts.repartition(*[F.col(c) for c in parts.columns])
    numbers = F.expr(f"sequence({part} * {NUMBERS_AT_ONCE}, least({count}, ({part} + 1) * {NUMBERS_AT_ONCE}) - 1)")
    return parts.withColumn(number, F.explode(numbers)).drop(part)


def _offsets(per_bucket: DataFrame) -> DataFrame:
    """``(source, _b, _off, _n)``: rows of the source before the bucket, and in all."""
    grouped = per_bucket.withColumn("_bg", F.expr(f"_b div {BUCKETS_AT_ONCE}"))
    sums = grouped.groupBy("source", "_bg").agg(F.sum("_c").alias("_s"))
    whole = Window.partitionBy("source")
    sums = sums.select("source", "_bg", F.sum("_s").over(whole).alias("_n"),
                       (F.sum("_s").over(whole.orderBy("_bg")) - F.col("_s")).alias("_start"))
    inside = Window.partitionBy("source", "_bg").orderBy("_b")
    return null_safe(grouped, sums, ["source", "_bg"], "inner").select(
        "source", "_b", (F.col("_start") + F.sum("_c").over(inside) - F.col("_c")).alias("_off"), "_n")


def interleave(rows: DataFrame, n_shards: int = SHARDS, seed: int = SEED,
               rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Add ``shard int, slot long, frac double`` to rows with a ``source``.

    The shuffle hashes whole rows; ties are broken by all columns, so reruns agree.
    """
    cols = [c for c in rows.columns if c not in ("shard", "slot", "frac")]
    packed = rows.select(F.struct(*cols).alias("row")).groupBy("row").agg(F.count(F.lit(1)).alias("_c"))
    h = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("row"), F.col("_copy")), 2)          # 62 bits
    drawn = materialize(_numbered(packed, "_c", "_copy").select("row", "_copy", h.alias("_h")), "shard_rows")
    n_rows = drawn.count()
    nb = _buckets(n_rows, rows_per_bucket)
    width = (1 << 62) // nb + 1
    keyed = drawn.withColumn("source", F.col("row")["source"]).withColumn(
        "_b", F.floor(F.col("_h") / F.lit(width)).cast("long"))

    per_bucket = keyed.groupBy("source", "_b").agg(F.count(F.lit(1)).alias("_c"))
    inside = Window.partitionBy("source", "_b").orderBy("_h", "row", "_copy")
    # The window needs the join's partitioning, so both run after one exchange.
    ranked = null_safe(keyed, _offsets(per_bucket), ["source", "_b"], "inner").withColumn(
        "_r", F.col("_off") + F.row_number().over(inside) - 1)
    ranked = (ranked.withColumn("_odd", 2 * F.col("_r") + 1)
              .withColumn("frac", F.col("_odd") / (2 * F.col("_n")))
              .withColumn("_fb", F.expr(f"(_odd * {nb}) div (2 * _n)")))

    # Rows before bucket b of the sequence: those of each source with (2r+1)*nb < 2n*b.
    per_source = per_bucket.groupBy("source").agg(F.sum("_c").alias("_n"))
    before = (_numbered(per_source, f"{nb}L", "_fb")
              .select("_fb", F.expr(f"least(_n, greatest(0, (2 * _n * _fb - {nb} + {2 * nb - 1}) div {2 * nb}))").alias("_k"))
              .groupBy("_fb").agg(F.sum("_k").cast("long").alias("_goff")))
    order = Window.partitionBy("_fb").orderBy("frac", "_h", "source", "row", "_copy")
    placed = ranked.join(before, "_fb").withColumn("_g", F.col("_goff") + F.row_number().over(order) - 1)
    total = max(n_rows, 1)
    placed = placed.withColumn("shard", F.expr(f"(_g * {n_shards}) div {total}").cast("int"))
    start = F.expr(f"(cast(shard as bigint) * {total} + {n_shards - 1}) div {n_shards}")
    return placed.select("row.*", "shard", (F.col("_g") - start).alias("slot"), "frac")


def shard_documents(docs: DataFrame, n_shards: int = SHARDS, seed: int = SEED, id_col: str = "doc_id",
                    text_col: str = "text", source_col: str = "source",
                    rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """``(id, size, text_crc32, law, shard, slot, grown_shard, source, frac)`` per row of ``docs``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                       (F.octet_length(text) + ROW_OVERHEAD).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"))
    return interleave(rows, n_shards, seed, rows_per_bucket).select(
        F.col("id").alias(id_col), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), F.col("source").alias(source_col), "frac")


def op9_interleaved_shards(spark, sf_dir: str) -> DataFrame:
    return shard_documents(documents(spark, sf_dir))
