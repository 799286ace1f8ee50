"""URL filter: rules first, a character language-model ratio for the rest.

Two variable-order Markov models of URL characters, one of accepted and one of
rejected URLs (those the rules decide), are smoothed by Witten-Bell back-off
from ``ORDER`` characters of context down to a uniform alphabet.  A URL's score
is the difference of its two log-likelihoods per character; a logistic curve
fitted to held-out labelled URLs (both classes weighing the same) calibrates
it into the probability of rejection.

Every term of a URL's log-likelihood depends on one ``ORDER + 1``-gram only.
So counts are one aggregation over the n-grams of all labelled URLs, back-off
runs once per *distinct* n-gram of the corpus, and URLs are scored by a join
of their n-grams with that table and a sum that is combined on the map side.
All URLs take part; nothing is sampled.  The table of n-gram scores is
broadcast only if it has at most ``MAX_BROADCAST_GRAMS`` rows.

Nulls: a null url, or one without ``://``, has empty host and path and fits no
rule; without any character it has score 0 and is allowed.  Repeated rows are
judged alike; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoscribe.llm.common import ascii_lower, materialize, pages
from geoscribe.operators.joins import checked_broadcast

RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
ORDER = 4
ALPHABET = 256
PAD = "\x02"
CALIBRATION_FOLDS = 5
BIN = 0.01
MAX_ABS_SCORE = 20.0
MAX_BROADCAST_GRAMS = 500_000


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    return ascii_lower(F.coalesce(F.regexp_extract(rest, r"^[^/?#]*", 0), F.lit("")))


def path_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    """``(rule, verdict)`` of the longest rule that fits, or null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: len(r[0])):      # later, longer ones win
        name, _, path_start = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{path_start}")
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _grams(url: Column, order: int) -> Column:
    """All ``order + 1``-grams, one for each character, the first ones padded."""
    padded = F.concat(F.lit(PAD * order), url)
    return F.transform(F.sequence(F.lit(1), F.length(url)), lambda i: F.substring(padded, i, F.lit(order + 1)))


def gram_scores(train: DataFrame, grams: DataFrame, order: int = ORDER) -> DataFrame:
    """``(gram, d)``: log P(last character | rest) under the allow model minus the block model.

    ``train`` has ``(gram, verdict)`` per character of a labelled URL; ``grams``
    the distinct n-grams to score.
    """
    counts = train.groupBy("gram").agg(F.count(F.when(F.col("verdict") == "allow", 1)).alias("a"),
                                       F.count(F.when(F.col("verdict") == "block", 1)).alias("b"))
    lengths = F.sequence(F.lit(1), F.lit(order + 1))
    levels = (counts.select(F.explode(F.transform(lengths, lambda k: F.right("gram", k))).alias("g"), "a", "b")
              .groupBy("g").agg(F.sum("a").alias("a"), F.sum("b").alias("b")))
    levels = materialize(levels, "url_counts")
    ctx = F.left(F.col("g"), F.length("g") - 1)
    contexts = levels.groupBy(ctx.alias("ctx")).agg(
        F.sum("a").alias("na"), F.sum("b").alias("nb"), F.count(F.when(F.col("a") > 0, 1)).alias("ta"),
        F.count(F.when(F.col("b") > 0, 1)).alias("tb"))
    steps = grams.select("gram", F.explode(lengths).alias("k")).withColumn("g", F.right("gram", F.col("k")))
    steps = steps.withColumn("ctx", F.left(F.col("g"), F.col("k") - 1))
    facts = (steps.join(levels, "g", "left").join(contexts, "ctx", "left")
             .groupBy("gram").agg(F.array_sort(F.collect_list(F.struct(
                 "k", *[F.coalesce(c, F.lit(0)).cast("double").alias(c) for c in ("a", "b", "na", "nb", "ta", "tb")]
             ))).alias("f")))

    def back_off(n: str, total: str, kinds: str) -> Column:
        return F.aggregate("f", F.lit(1.0 / ALPHABET), lambda p, s: F.when(
            s[total] + s[kinds] > 0, (s[n] + s[kinds] * p) / (s[total] + s[kinds])).otherwise(p))

    return facts.select("gram", (F.log(back_off("a", "na", "ta")) - F.log(back_off("b", "nb", "tb"))).alias("d"))


def fit_logistic(score: np.ndarray, blocked: np.ndarray, allowed: np.ndarray) -> tuple[float, float]:
    """Slope and offset of P(block) over binned scores, classes weighted equally; a weak ridge keeps it finite."""
    if not blocked.sum() or not allowed.sum():
        return -8.0, 0.0
    w1, w0 = blocked / blocked.sum(), allowed / allowed.sum()
    x, beta = np.stack([score, np.ones_like(score)], 1), np.zeros(2)
    ridge = np.diag([1e-4, 1e-6])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (w1 * (1 - p) - w0 * p) - ridge @ beta
        hess = (x * ((w1 + w0) * p * (1 - p))[:, None]).T @ x + ridge
        move = np.linalg.solve(hess, grad)
        size = float(np.abs(move).max())
        beta += move * min(1.0, 2.0 / max(size, 1e-12))
        if size < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def judge_urls(rows: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, order: int = ORDER,
               id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``(id, host, path, rule, verdict, score, block_probability)`` per row."""
    urls = rows.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    urls = (urls.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
            .withColumn("_m", matching_rule(F.col("host"), F.col("path"), rules)))
    chars = urls.select("url", F.col("_m.verdict").alias("verdict"),
                        (F.pmod(F.xxhash64("url"), F.lit(CALIBRATION_FOLDS)) == 0).alias("held"),
                        F.explode(_grams(ascii_lower(F.col("url")), order)).alias("gram"))
    train = chars.where(F.col("verdict").isNotNull() & ~F.col("held")).select("gram", "verdict")
    scores = materialize(gram_scores(train, chars.select("gram").distinct(), order), "url_gram_scores")

    # One score per distinct url: copies of a url share the work and the shuffle.
    distinct = urls.where(F.length("url") > 0).select("url", "_m.verdict").distinct()
    terms = distinct.select("url", "verdict", F.explode(_grams(ascii_lower(F.col("url")), order)).alias("gram"))
    per_url = (terms.join(checked_broadcast(scores, MAX_BROADCAST_GRAMS), "gram")
               .groupBy("url", "verdict").agg((F.sum("d") / F.count(F.lit(1))).alias("score")))
    per_url = materialize(per_url, "url_scores")

    clamped = F.greatest(F.lit(-MAX_ABS_SCORE), F.least(F.lit(MAX_ABS_SCORE), F.col("score")))
    labelled = per_url.where(F.col("verdict").isNotNull() & (F.pmod(F.xxhash64("url"), F.lit(CALIBRATION_FOLDS)) == 0))
    bins = (labelled.groupBy(F.floor(clamped / BIN).cast("long").alias("bin"))       # at most 4,001 rows
            .agg(F.count(F.when(F.col("verdict") == "block", 1)).alias("blocked"),
                 F.count(F.when(F.col("verdict") == "allow", 1)).alias("allowed")).orderBy("bin").collect())
    slope, offset = fit_logistic(np.array([(r.bin + 0.5) * BIN for r in bins]),
                                 np.array([float(r.blocked) for r in bins]), np.array([float(r.allowed) for r in bins]))

    judged = urls.join(per_url.select(F.col("url").alias("_u"), "score"), F.col("url") == F.col("_u"), "left")
    probability = F.when(F.col("score").isNotNull(),
                         1 / (1 + F.exp(-(F.lit(slope) * F.col("score") + F.lit(offset))))).otherwise(0.0)
    verdict = F.coalesce(F.col("_m.verdict"), F.when(probability >= 0.5, "block").otherwise("allow"))
    return judged.select(F.col("id").alias(id_col), "host", "path", F.col("_m.rule").alias("rule"),
                         verdict.alias("verdict"), F.coalesce("score", F.lit(0.0)).alias("score"),
                         probability.alias("block_probability"))


def op2_url_model_ratio(spark, sf_dir: str) -> DataFrame:
    return judge_urls(pages(spark, sf_dir))
