"""Mixing sources to target weights by pivotal dependent rounding, all native.

``capped_targets`` shares a budget of words over the sources by weight, with
no source above ``max_copies`` times its size (water filling, one window over
the table of sources).  A document of a source with rate ``target / size`` gets
``floor(rate)`` copies for sure and one more with the fractional part ``p``.

``pivotal_round`` turns the fractional copies into whole ones while keeping
the expected copies of every document and the words of every source.  Two
fractional documents with sizes ``u, v`` and probabilities ``a, b`` exchange
words: either the first takes ``min((1-a)u, bv)`` words from the second, or it
gives ``min(au, (1-b)v)`` words, each with the probability that keeps both
expectations; one of them becomes 0 or 1.  Documents of a source are folded in
hash blocks of about ``BLOCK`` rows, each leaving one fractional document; the
leftovers meet in a reduction tree of fan-in ``BLOCK`` until one is left per
source, which goes to its nearer side.  So a source misses its target by at
most half of one document, no block or task grows with the corpus, and the
random draws are hashes of ids, so reruns and retries agree.

Nulls: a null source is a source of its own (sorted last); null and empty
texts have size 0 and take 0 words.  Rows that repeat an id, source and size
are decided together.  An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoscribe.llm.common import documents, materialize, null_safe, word_count

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_COPIES = 2
SEED = 8_117
BLOCK = 64


def capped_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
                   max_copies: int = MAX_COPIES) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size, ...)``.

    With sources sorted by ``cap / weight``, the water level is the largest of
    ``(budget - caps before) / (weights from here on)``: it rises while sources
    are below it and falls afterwards.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    pattern = F.array(*[F.lit(float(w)) for w in weights])
    w = sizes.withColumn("_w", F.get(pattern, (F.row_number().over(by_name) - 1) % len(weights)))
    w = w.withColumn("_cap", F.lit(float(max_copies)) * F.col("source_size"))
    w = w.withColumn("_ratio", F.col("_cap") / F.col("_w"))
    everything = Window.partitionBy(F.lit(1))
    earlier = (Window.partitionBy(F.lit(1)).orderBy("_ratio", F.col("source").asc_nulls_last())
               .rowsBetween(Window.unboundedPreceding, -1))
    budget = F.lit(float(share)) * F.sum("source_size").over(everything)
    w = w.withColumn("_level", (budget - F.coalesce(F.sum("_cap").over(earlier), F.lit(0.0)))
                     / (F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(earlier), F.lit(0.0))))
    level = F.max("_level").over(everything)
    w = w.withColumn("_level", level)
    return w.withColumn("target", F.least("_cap", F.col("_level") * F.col("_w"))).drop("_w", "_cap", "_ratio", "_level")


def _uniform(*parts: Column) -> Column:
    """A hash in [0, 1)."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / F.lit(float(1 << 53))


def _fold(units: Column, seed: int, level: int) -> Column:
    """Pair the units of a block one after the other.

    ``units`` is a sorted array of ``(h, id, size, m, p)``; the result holds the
    one fractional unit left (``cur``) and the decided ones (``done``).
    """
    first = F.get(units, 0)
    rest = F.slice(units, 2, F.greatest(F.size(units) - 1, F.lit(0)))

    def words(unit: Column) -> Column:
        return (unit["size"] * unit["m"]).cast("double")

    def with_p(unit: Column, p: Column) -> Column:
        return F.struct(*[unit[f].alias(f) for f in ("h", "id", "size", "m")], p.alias("p"))

    def decided(unit: Column, x: Column) -> Column:
        return F.struct(unit["id"].alias("id"), unit["size"].alias("size"), x.cast("int").alias("x"))

    def step(acc: Column, e: Column) -> Column:
        c = acc["cur"]
        u, v, a, b = words(c), words(e), c["p"], e["p"]
        gain, loss = F.least((1.0 - a) * u, b * v), F.least(a * u, (1.0 - b) * v)
        up = _uniform(F.lit(seed), F.lit(level), c["h"], e["h"], c["id"], e["id"]) * (gain + loss) < loss
        # up: the first takes words; otherwise it gives them.  Whoever hits 0 or 1 is decided.
        first_done = F.when(up, (1.0 - a) * u <= b * v).otherwise(a * u <= (1.0 - b) * v)
        left = F.when(first_done, F.when(up, b - gain / v).otherwise(b + loss / v)).otherwise(
            F.when(up, a + gain / u).otherwise(a - loss / u))
        # The first ends at 1 when it took, the second ends at 0 then, and the other way round.
        x = F.when(first_done, up).otherwise(~up)
        return F.struct(
            F.when(first_done, with_p(e, left)).otherwise(with_p(c, left)).alias("cur"),
            F.concat(acc["done"], F.array(F.when(first_done, decided(c, x)).otherwise(decided(e, x)))).alias("done"))

    none = F.slice(F.array(decided(first, F.lit(0))), 1, 0)
    return F.aggregate(rest, F.struct(with_p(first, first["p"]).alias("cur"), none.alias("done")), step)


def pivotal_round(units: DataFrame, seed: int = SEED, block: int = BLOCK) -> DataFrame:
    """``(source, id, size, x)`` with ``x`` 0 or 1 for units ``(source, id, size, m, p)``, 0 < p < 1.

    ``m`` rows share the unit.  ``(source, id, size)`` must be unique.
    """
    counts = units.groupBy("source").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).alias("_nb"))
    most = counts.agg(F.max("_nb")).first()[0] or 0
    h = F.xxhash64(F.lit(seed), F.col("id"), F.col("size"))
    level_in = null_safe(units, counts, ["source"], "inner").select(
        "source", F.pmod(h, F.col("_nb")).alias("_block"), F.struct(h.alias("h"), "id", "size", "m", "p").alias("_u"))
    parts, level = [], 0
    while True:
        folded = (level_in.groupBy("source", "_block").agg(F.array_sort(F.collect_list("_u")).alias("_us"))
                  .select("source", "_block", _fold(F.col("_us"), seed, level).alias("_f"))
                  .select("source", "_block", F.col("_f.cur").alias("_u"), F.col("_f.done").alias("_done")))
        folded = materialize(folded, f"pivotal_{level}")
        parts.append(folded.select("source", F.inline("_done")))
        if most <= 1:
            break
        # Blocks are numbered from 0 in every source, so a fan-in is a division.
        level_in = folded.select("source", F.expr(f"_block div {block}").alias("_block"), "_u")
        most, level = -(-most // block), level + 1
    root = folded.select("source", "_u.id", "_u.size", (F.col("_u.p") >= 0.5).cast("int").alias("x"))
    out = root
    for p in parts:
        out = out.unionByName(p)
    return out


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, max_copies: int = MAX_COPIES,
        seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``(id, source, size, source_size, target, copies, taken)`` per row of ``docs``."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                       word_count(F.col(text_col)).alias("size"))
    # Sizes are counted once per text; the narrow rows feed the rest.
    rows = materialize(rows, "mix_sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    targets = materialize(
        capped_targets(sizes, weights, share, max_copies).withColumn("_rate", rate)
        .withColumn("_whole", F.floor("_rate").cast("long")).withColumn("_p", F.col("_rate") - F.floor("_rate")),
        "mix_targets")
    # One row per source: small next to the documents; Spark's own estimate decides how to join it.
    rated = null_safe(rows, targets, ["source"], "inner")
    units = (rated.where((F.col("_p") > 0) & (F.col("size") > 0))
             .groupBy("source", "id", "size", F.col("_p").alias("p")).agg(F.count(F.lit(1)).alias("m")))
    decisions = pivotal_round(units, seed)
    joined = null_safe(rated, decisions.select("id", "source", "size", "x"), ["id", "source", "size"], "left")
    copies = F.col("_whole") + F.coalesce(F.col("x"), F.lit(0))
    return joined.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size",
                         F.col("target"), copies.alias("copies"), (F.col("size") * copies).alias("taken"))


def op8_pivotal_mix(spark, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")
