"""Naive Bayes place classifier without smoothing (the reference's Phase 2).

Model, for class ``c`` with ``n_c`` of ``N`` texts and distinct lower-cased
query words ``w_1..w_k`` (first-seen order), where ``d_c(w)`` is the number of
texts of ``c`` holding ``w`` as a blank-separated token::

    p(c) = n_c / N * d_c(w_1) / n_c * ... * d_c(w_k) / n_c

folded left to right exactly as the reference does (``x * d / n_c`` per word,
starting from ``n_c / N``), so the doubles agree to the last bit.  The fold
carries a power of two beside the mantissa (``scaled``), which is exact, so a
long query does not underflow: classes are ranked by ``scaled``, and ``p`` may
print as 0.0 for an answer below the range of doubles (``log_p`` still tells
its size).  The answer is every class with the maximum, and nothing when a word
of the query is in no class.

Design for scale:

* ``N`` is a scalar subquery (one value, computed once and shipped to every
  task), not a driver-side dictionary or a cross join.
* Word presence is an algebraic aggregate: a literal query becomes one
  ``sum(array_contains(...))`` per word in a single pass; a batch of queries
  filters document words by the query vocabulary before a partial aggregate.
* In the batch path equal word lists are scored once, whatever the number of
  queries that have them.  A class can only win if it holds the list's rarest
  word, so candidates come from that word's inverted list (the classes that hold
  it, with ``d``), and the other words are checked by an equi join on (class, word).
* Candidates are pruned by a bound: every factor of the fold is at most 1, so
  ``p(c) <= d_c(w) / N`` for each word ``w``.  A few classes with large ``d``
  of the rarest word are scored first; only classes whose ``d`` reaches ``N``
  times the best ``p`` among them are scored after that.  Inverted lists are cut by
  magnitude (the binary logarithm of ``d``), a join key, so entries below the
  bound are not even compared.  A word in every class no longer pairs its list
  with every class.
* The best classes per list are cut with ``rank() = 1``, which Catalyst applies
  partially before the shuffle (WindowGroupLimit).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoscribe.functions.text import lower_words
from geoscribe.operators.joins import checked_broadcast
from geoscribe.session import materialize


#: Power of two by which the fold rescales a small mantissa.
SCALE = 500


def _dedupe(words: list[str]) -> list[str]:
    return list(dict.fromkeys(words))


def total_of(counts: DataFrame, n: str) -> Column:
    """``N`` as the sum of per-class counts (NULL class included), a scalar
    subquery over the same aggregate, so Spark reuses its exchange instead of
    scanning the training data again."""
    return counts.select(F.sum(n)).scalar()


def class_counts(train: DataFrame, cls: str, n: str = "n") -> DataFrame:
    return train.groupBy(cls).agg(F.count(F.lit(1)).alias(n))


def priors(train: DataFrame, cls: str) -> DataFrame:
    """``(cls, n, prior)`` with ``prior = n / N``."""
    counts = class_counts(train, cls)
    return counts.select(cls, "n", (F.col("n") / total_of(counts, "n")).alias("prior"))


def scaled_fold(prior: Column, counts: Column, n_c: Column) -> Column:
    """``reduce(lambda x, d: x * d / n_c, counts, prior)`` as ``struct(e, m)``, worth ``m * 2^e``.

    A mantissa below ``2^-SCALE`` is multiplied by ``2^SCALE``, so structs
    compare as their values do (zeros aside).
    """
    def pair(e: Column, m: Column) -> Column:
        return F.struct(e.cast("int").alias("e"), m.cast("double").alias("m"))

    def step(acc: Column, d: Column) -> Column:
        x = acc["m"] * d / n_c
        return F.when((x > 0) & (x < 2.0 ** -SCALE), pair(acc["e"] - SCALE, x * 2.0 ** SCALE)).otherwise(pair(acc["e"], x))

    return F.aggregate(counts, pair(F.lit(0), prior), step)


def unscaled(scaled: Column) -> Column:
    return scaled["m"] * F.pow(F.lit(2.0), scaled["e"])


def log_score(scaled: Column) -> Column:
    """Natural logarithm of a scaled probability, null for 0."""
    return F.ln(scaled["m"]) + scaled["e"] * F.ln(F.lit(2.0))


def fold_probability(prior: Column, counts: Column, n_c: Column) -> Column:
    """The fold as a double."""
    return unscaled(scaled_fold(prior, counts, n_c))


def _presence_wide(train: DataFrame, cls: str, text: str, words: list[str]) -> DataFrame:
    toks = train.select(F.col(cls), lower_words(text).alias("_toks"))
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.sum(F.array_contains("_toks", F.lit(w)).cast("bigint")).alias(f"_d{i}") for i, w in enumerate(words)]
    return toks.groupBy(cls).agg(*aggs)


def word_presence(train: DataFrame, cls: str, text: str, words: list[str]) -> DataFrame:
    """``(cls, pos, word, d)``: texts of each class containing each query word, zeros included."""
    ws = _dedupe(words)
    wide = _presence_wide(train, cls, text, ws)
    entries = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(w).alias("word"), F.col(f"_d{i}").alias("d"))
                        for i, w in enumerate(ws)])
    return wide.select(cls, F.inline(entries))


def score_words(train: DataFrame, cls: str, text: str, words: list[str]) -> DataFrame:
    """``(cls, n, p, log_p, scaled)`` for every class, for one query given as a word list.

    The word list is first lower-cased and de-duplicated in first-seen order,
    as the reference does with its query line.  All words are counted
    in one pass (one conditional sum per word), whatever the length, and a
    NULL class is a class like any other.
    """
    ws = _dedupe([w.lower() for w in words])
    # One row per class, written once: the total below reads it again, not the texts.
    wide = materialize(_presence_wide(train, cls, text, ws), "nb_presence_wide")
    counts = F.array(*[F.col(f"_d{i}") for i in range(len(ws))]) if ws else F.array().cast("array<bigint>")
    # The prior is its own column: a subquery may not sit inside the fold lambda.
    with_prior = wide.withColumn("_prior", F.col("n") / total_of(wide, "n"))
    scored = with_prior.select(cls, "n", scaled_fold(F.col("_prior"), counts, F.col("n")).alias("scaled"))
    return scored.select(cls, "n", unscaled(F.col("scaled")).alias("p"), log_score(F.col("scaled")).alias("log_p"), "scaled")


def best_classes(scores: DataFrame, p: str = "p", by: list[str] = ()) -> DataFrame:
    """Rows whose ``p`` (a double or a scaled struct) is the maximum (of their ``by`` group) and above 0.

    ``rank() = 1`` keeps every tied row; Catalyst evaluates it partially on
    each map task (WindowGroupLimit) before the exchange.
    """
    value = F.col(p)["m"] if isinstance(scores.schema[p].dataType, T.StructType) else F.col(p)
    scores = scores.where(value > 0)
    if not by:
        return scores.where(F.col(p) == scores.select(F.max(p)).scalar())
    w = Window.partitionBy(*by).orderBy(F.col(p).desc())
    return scores.withColumn("_r", F.rank().over(w)).where(F.col("_r") == 1).drop("_r")


def query_word_table(queries: DataFrame, query_keys: list[str], words: str = "words") -> DataFrame:
    """``(query keys..., pos, word)``: query words lower-cased, repeats dropped in
    first-seen order (as the reference builds its word dictionary)."""
    distinct = F.array_distinct(F.transform(words, lambda w: F.lower(w)))
    return queries.select(*query_keys, F.posexplode(distinct).alias("pos", "word"))


def presence_for_vocabulary(train: DataFrame, cls: str, text: str, vocab: DataFrame) -> DataFrame:
    """``(cls, word, d)`` for the words in ``vocab`` only.

    Each text contributes each of its distinct words once (presence).  The
    vocabulary semi join sits below the partial aggregate, so only query words
    reach the shuffle.  The vocabulary is broadcast behind a size check (its
    static estimate is that of the whole query table), so document words are
    never shuffled by word; beyond the bound it is a shuffled semi join.
    """
    doc_words = train.select(F.col(cls), F.explode(F.array_distinct(lower_words(text))).alias("word"))
    vocab_words = checked_broadcast(vocab.select("word").distinct())
    return (doc_words.join(vocab_words, on="word", how="left_semi")
            .groupBy(cls, "word").agg(F.count(F.lit(1)).alias("d")))


#: Classes per word that are scored to find the bound: the one with the largest ``d`` of each hash group of classes.
FIRST_CANDIDATES = 8
#: The bound is lowered by this part, far above the rounding of the fold.
SLACK = 1e-9


def distinct_lists(queries: DataFrame, query_keys: list[str], words: str = "words") -> tuple[DataFrame, DataFrame]:
    """``(lists, named)``: distinct normalised word lists as ``(list_id, words)``, and every query's keys with its ``list_id``."""
    normal = F.array_distinct(F.transform(words, lambda w: F.lower(w)))
    asked = queries.select(*query_keys, normal.alias("words")).where(F.col("words").isNotNull())
    lists = asked.select("words").distinct().withColumn("list_id", F.monotonically_increasing_id())
    lists = materialize(lists, "nb_lists")
    return lists, asked.join(lists, "words").select(*query_keys, "list_id")


def _magnitude(d: Column) -> Column:
    return F.floor(F.log2(d)).cast("int")


def _matched(candidates: DataFrame, list_words: DataFrame, pres: DataFrame, sizes: DataFrame, cls: str) -> DataFrame:
    """``(list_id, cls, p, scaled)`` of the candidates ``(list_id, cls, k, least)`` that hold all ``k`` words,
    each in at least ``least`` texts."""
    held = pres.select(F.col(cls).alias("_cls"), F.col("word").alias("_word"), "d")
    matched = (candidates.join(list_words, "list_id")
               .join(held, F.col(cls).eqNullSafe(F.col("_cls")) & (F.col("word") == F.col("_word")) & (F.col("d") >= F.col("least")))
               .groupBy("list_id", cls, "k")
               .agg(F.count(F.lit(1)).alias("_m"), F.array_sort(F.collect_list(F.struct("pos", "d"))).alias("_ds"))
               .where(F.col("_m") == F.col("k")))
    scored = matched.join(sizes, F.col(cls).eqNullSafe(F.col("_cls")))
    scaled = scaled_fold(F.col("_prior"), F.transform("_ds", lambda s: s["d"]), F.col("n_c"))
    scored = scored.select("list_id", cls, scaled.alias("scaled"))
    return scored.select("list_id", cls, unscaled(F.col("scaled")).alias("p"), "scaled")


def candidate_classes(rarest: DataFrame, pres: DataFrame, cls: str) -> DataFrame:
    """``(list_id, cls, k, least)``: classes of each list's rarest word that hold it at least ``least`` times.

    ``rarest`` is ``(list_id, word, k, least)``.  Lists meet only the magnitudes of
    their word from that of ``least`` upwards.
    """
    entries = pres.select(cls, "word", "d", _magnitude(F.col("d")).alias("mag"))
    top = entries.groupBy("word").agg(F.max("mag").alias("_top"))
    wanted = (rarest.join(top, "word").withColumn("_low", _magnitude(F.greatest(F.col("least"), F.lit(1.0))))
              .where(F.col("_low") <= F.col("_top"))
              .select("list_id", "word", "k", "least", F.explode(F.sequence("_low", "_top")).alias("mag")))
    return wanted.join(entries, ["word", "mag"]).where(F.col("d") >= F.col("least")).select("list_id", cls, "k", "least")


def score_lists(train: DataFrame, lists: DataFrame, cls: str, text: str) -> DataFrame:
    """``(list_id, cls, p, scaled)`` of every class that can be the best of a list (and some that are not).

    Classes missing a word have ``p = 0`` and classes below the bound cannot win, so
    neither is generated.  A NULL class is a class like any other.
    """
    list_words = query_word_table(lists, ["list_id"])
    # The presence table (corpus-sized work) feeds several branches whose pruning
    # differs, so Spark cannot share it; it is written once.
    pres = materialize(presence_for_vocabulary(train, cls, text, list_words.select("word")), "nb_presence")
    n_c = materialize(class_counts(train, cls, "n_c"), "nb_classes")
    sizes = n_c.select(F.col(cls).alias("_cls"), "n_c", (F.col("n_c") / total_of(n_c, "n_c")).alias("_prior"))
    classes_per_word = pres.groupBy("word").agg(F.count(F.lit(1)).alias("n_cls"))
    # A word no class holds gets n_cls = 0 and becomes the list's rarest word,
    # which then finds no candidate: the list has no answer, as it should.
    rarity = (list_words.join(classes_per_word, on="word", how="left")
              .select("list_id", "pos", "word", F.coalesce("n_cls", F.lit(0)).alias("n_cls")))
    rarest = rarity.groupBy("list_id").agg(
        F.min_by("word", F.struct("n_cls", "pos")).alias("word"), F.count(F.lit(1)).alias("k"))
    rarest = materialize(rarest, "nb_rarest")

    group = F.pmod(F.xxhash64(cls), F.lit(FIRST_CANDIDATES)).alias("_group")
    first = pres.groupBy("word", group).agg(F.max(F.struct("d", cls)).alias("_first")).select("word", F.col("_first")[cls].alias(cls))
    tried = rarest.join(first, "word").select("list_id", cls, "k", F.lit(0.0).alias("least"))
    best = _matched(tried, list_words, pres, sizes, cls).where(F.col("scaled")["m"] > 0)
    best = best.groupBy("list_id").agg(F.max("scaled").alias("_best"))
    total = F.log2(total_of(n_c, "n_c"))
    least = F.pow(F.lit(2.0), F.log2(F.col("_best")["m"]) + F.col("_best")["e"] + F.col("_log_n")) * (1 - SLACK)
    bounded = (rarest.join(best, "list_id", "left").withColumn("_log_n", total)
               .select("list_id", "word", "k", F.coalesce(least, F.lit(0.0)).alias("least")))
    return _matched(candidate_classes(bounded, pres, cls), list_words, pres, sizes, cls)


def estimate_places(train: DataFrame, queries: DataFrame, cls: str, text: str,
                    query_keys: list[str] = ("query_id",), words: str = "words") -> DataFrame:
    """Most probable class(es) per query, ties kept; no row when the best ``p`` is 0."""
    keys = list(query_keys)
    lists, named = distinct_lists(queries, keys, words)
    best = best_classes(score_lists(train, lists, cls, text), "scaled", ["list_id"]).drop("scaled")
    return named.join(best, "list_id").select(*keys, cls, "p")
