"""Quality rules by robust multivariate outliers.

Every text gets a vector of transformed statistics.  For each language and
source the minimum covariance determinant (MCD) estimate of location and
scatter is fitted to the vectors of the documents that pass the base rules;
a document whose squared Mahalanobis distance exceeds a chi-square quantile is
rejected.

The estimates use all documents, by distributed concentration steps: two
deterministic starts per group (medians with quartile ranges, and the spatial
sign scatter) are refined by turns of "histogram of squared distances per
group -> the half with the smallest distances -> their mean and scatter";
the start with the smaller determinant wins, and one reweighting step follows.
A turn is two aggregations with map-side combine over a narrow table of
vectors; a group is never held in one task.  Histograms have a fixed bin
width, so a group is cut at a bin (the half is rounded up to a whole bin) and
the result does not depend on partitioning.

A group needs ``MIN_ROWS`` documents; smaller sources of a language are pooled,
then what is left over all languages, and a pool that is still too small
rejects nothing.  Most clean texts agree exactly in some statistics (no
symbols, no repeated line), which would make any covariance singular; the
scatter gets the variance ``FLOOR[i] ** 2`` as the resolution of statistic i.

Nulls: a null text has no words and fails the base rule; null languages and
sources are groups of their own; a null id is returned as it is.  Repeated
rows are judged alike.  An empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoscribe.llm.common import WORD, documents, materialize
from geoscribe.operators.joins import checked_broadcast

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
MIN_ROWS = 60
STEPS = 4
ALPHA = 1e-4
#: Statistics of the vector and their resolutions.
STATS = ("log_words", "log_word_chars", "log_symbols", "log_upper", "log_dup_lines", "log_repeat", "log_marks")
FLOOR = (0.75, 0.10, 0.50, 0.50, 1.00, 1.00, 0.50)
#: At most this many group estimates are broadcast (about 1 KB each).
MAX_BROADCAST_GROUPS = 10_000
BINS_PER_OCTAVE = 16

_SYMBOL = re.compile(r"[#*$%&|<>]")
_MARK = re.compile(r"[^\w\s]|_")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")


# --- statistics of one text -------------------------------------------------

def repeated_window_words(words: list[str], width: int = WINDOW) -> int:
    """Words covered by ``width``-word windows that occur at least twice."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    ids: dict[str, int] = {}
    a = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.uint64, len(words))
    if len(ids) == len(words):
        return 0
    h = np.zeros(n, np.uint64)
    for k in range(width):
        h = (h ^ a[k:k + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(31)
    order = np.sort(h)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0                                  # equal windows always have equal hashes
    at = np.flatnonzero(np.isin(h, twice))
    exact = Counter(key := [a[i:i + width].tobytes() for i in at])
    at = at[np.fromiter((exact[k] > 1 for k in key), bool, len(key))]
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + width, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def text_statistics(text: str | None) -> tuple:
    """``(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, *vector)``."""
    text = text or ""
    words = WORD.findall(text)
    n, chars = len(words), sum(map(len, words))
    symbols = len(_SYMBOL.findall(text))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    dup = len(lines) - len(set(lines))
    repeat = repeated_window_words(words)
    if not n:
        return (0, 0, symbols, dup, repeat, *[0.0] * len(STATS))

    def percent(k: int, of: int) -> float:
        return math.log1p(100.0 * k / of)

    return (n, chars, symbols, dup, repeat, math.log(n), math.log(chars / n), percent(symbols, chars),
            percent(len(_UPPER.findall(text)), chars), percent(dup, len(lines)), percent(repeat, n),
            percent(len(_MARK.findall(text)), chars))


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [text_statistics(t.as_py()) for t in b.column("text")]
        cols = list(zip(*rows)) if rows else [()] * (5 + len(STATS))
        arrays = [pa.array(c, pa.int64()) for c in cols[:5]] + [pa.array(c, pa.float64()) for c in cols[5:]]
        yield pa.RecordBatch.from_arrays(
            [b.column("id"), b.column("lang"), b.column("source"), *arrays], names=_stat_names())


def _stat_names() -> list[str]:
    return ["id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            *(f"x{i}" for i in range(len(STATS)))]


# --- chi-square ---------------------------------------------------------------

def chi2_cdf(x: float, k: int) -> float:
    """Regularised lower incomplete gamma function at (k/2, x/2), by its series."""
    a, z = k / 2, x / 2
    if z <= 0:
        return 0.0
    if z > a + 60:
        return 1.0
    term = total = 1 / a
    i = a
    while term > total * 1e-16:
        i += 1
        term *= z / i
        total += term
    return min(1.0, total * math.exp(a * math.log(z) - z - math.lgamma(a)))


def chi2_quantile(q: float, k: int) -> float:
    lo, hi = 0.0, 200.0 + 4 * k
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, k) < q else (lo, mid)
    return (lo + hi) / 2


def consistency(share: float, k: int) -> float:
    """Factor that makes the scatter of the ``share`` innermost rows of a normal sample right."""
    return share / chi2_cdf(chi2_quantile(share, k), k + 2)


# --- estimates ------------------------------------------------------------------

def _pairs(p: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(p) for j in range(i, p)]


def _moments(p: int) -> list[Column]:
    return [F.count(F.lit(1)).alias("k"), F.array(*[F.sum(f"x{i}") for i in range(p)]).alias("s"),
            F.array(*[F.sum(F.col(f"x{i}") * F.col(f"x{j}")) for i, j in _pairs(p)]).alias("ss")]


_ESTIMATE = "mean array<double>, prec array<double>, logdet double"


def _as_estimate(mean: np.ndarray, cov: np.ndarray, floor: np.ndarray) -> tuple:
    cov = cov + np.diag(floor ** 2)
    return mean.tolist(), np.linalg.inv(cov).ravel().tolist(), float(np.linalg.slogdet(cov)[1])


def _solver(floor: tuple[float, ...]):
    """Scalar UDF from moments (and a scatter factor) to an estimate; a row per group, so tiny."""
    p, fl = len(floor), np.array(floor)

    @F.pandas_udf(_ESTIMATE)
    def solve(k: pd.Series, s: pd.Series, ss: pd.Series, factor: pd.Series) -> pd.DataFrame:
        out = []
        for n, a, b, f in zip(k, s, ss, factor):
            mean, cov = np.array(a) / n, np.zeros((p, p))
            for (i, j), v in zip(_pairs(p), b):
                cov[i, j] = cov[j, i] = v / n - mean[i] * mean[j]
            values, vectors = np.linalg.eigh(cov)           # rounding may leave tiny negative ones
            out.append(_as_estimate(mean, f * (vectors * np.maximum(values, 0)) @ vectors.T, fl))
        return pd.DataFrame(out, columns=["mean", "prec", "logdet"])

    return solve


def _distance(p: int) -> Column:
    """Squared Mahalanobis distance of x0.. to the joined ``mean`` and ``prec``."""
    diff = [F.col(f"x{i}") - F.get("mean", F.lit(i)) for i in range(p)]
    total = F.lit(0.0)
    for i, j in _pairs(p):
        total = total + F.get("prec", F.lit(i * p + j)) * diff[i] * diff[j] * (1.0 if i == j else 2.0)
    return F.greatest(total, F.lit(0.0))


def _bin(value: Column, floor: float = 2.0 ** -10) -> Column:
    return F.floor(F.lit(BINS_PER_OCTAVE) * F.log2(value + floor)).cast("long")


def _with(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(checked_broadcast(groups, MAX_BROADCAST_GROUPS), keys)


def _grouped(stats: DataFrame, min_rows: int) -> DataFrame:
    """Add ``grp``: language and source, or the language's or the overall pool of small groups, or null."""
    base = F.col("base_failed")
    exact = F.to_json(F.array("lang", "source"))
    pool = F.to_json(F.array(F.col("lang")))
    rows = stats.withColumn("_g", exact).withColumn("_p", pool)
    sizes = rows.where(~base).groupBy("_g", "_p").agg(F.count(F.lit(1)).alias("_n"))
    small = F.col("_n") < min_rows
    by_lang = Window.partitionBy("_p")
    pooled = F.sum(F.when(small, F.col("_n"))).over(by_lang)
    rest = F.sum(F.when(small & (F.col("_pooled") < min_rows), F.col("_n"))).over(Window.partitionBy(F.lit(1)))
    names = (sizes.withColumn("_pooled", pooled).withColumn("_rest", rest)
             .select("_g", F.when(~small, F.col("_g")).when(F.col("_pooled") >= min_rows, F.col("_p"))
                     .when(F.col("_rest") >= min_rows, F.lit("[]")).alias("grp")))
    named = rows.join(checked_broadcast(names, 10 * MAX_BROADCAST_GROUPS), "_g", "left")
    return named.drop("_g", "_p")


def _first_estimates(fit: DataFrame, floor: tuple[float, ...]) -> DataFrame:
    """``(grp, start, mean, prec, logdet)`` from quartiles and from the spatial sign scatter."""
    p, fl = len(floor), np.array(floor)
    step = 1 / 64
    long = fit.select("grp", F.posexplode(F.array(*[f"x{i}" for i in range(p)])).alias("i", "x"))
    hist = long.groupBy("grp", "i", F.floor(F.col("x") / step).cast("long").alias("b")).agg(
        F.count(F.lit(1)).alias("c"))
    run = Window.partitionBy("grp", "i").orderBy("b")
    cum = hist.withColumn("_c", F.sum("c").over(run)).withColumn(
        "_n", F.sum("c").over(Window.partitionBy("grp", "i")))
    quart = [F.min(F.when(F.col("_c") >= q * F.col("_n"), (F.col("b") + 0.5) * step)).alias(f"q{int(q * 4)}")
             for q in (0.25, 0.5, 0.75)]
    dims = cum.groupBy("grp", "i").agg(*quart)
    centre = dims.groupBy("grp").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "q2"))), lambda s: s["q2"]).alias("mid"),
        F.transform(F.array_sort(F.collect_list(F.struct("i", ((F.col("q3") - F.col("q1")) / 1.349).alias("w")))),
                    lambda s: s["w"]).alias("width"))
    centre = materialize(centre, "mcd_centre")

    scale = [F.sqrt(F.pow(F.get("width", F.lit(i)), 2) + floor[i] ** 2) for i in range(p)]
    z = _with(fit, centre, ["grp"]).select(
        "grp", *[((F.col(f"x{i}") - F.get("mid", F.lit(i))) / scale[i]).alias(f"z{i}") for i in range(p)])
    norm = F.sqrt(sum((F.pow(F.col(f"z{i}"), 2) for i in range(p)), F.lit(0.0)))
    signs = z.withColumn("_r", norm).where(F.col("_r") > 0).groupBy("grp").agg(
        F.array(*[F.sum(F.col(f"z{i}") * F.col(f"z{j}") / F.pow(F.col("_r"), 2)) for i, j in _pairs(p)]).alias("ss"),
        F.count(F.lit(1)).alias("k"))

    @F.pandas_udf(f"array<struct<{_ESTIMATE.replace(' array', ': array').replace(' double', ': double')}>>")
    def starts(mid: pd.Series, width: pd.Series, k: pd.Series, ss: pd.Series) -> pd.Series:
        out = []
        for m, w, n, s in zip(mid, width, k, ss):
            m, d = np.array(m), np.sqrt(np.array(w) ** 2 + fl ** 2)
            both = [np.diag(d ** 2)]
            if n and n == n and s is not None:
                c = np.zeros((p, p))
                for (i, j), v in zip(_pairs(p), s):
                    c[i, j] = c[j, i] = v / n * p
                both.append(c * np.outer(d, d))
            out.append([dict(zip(("mean", "prec", "logdet"), _as_estimate(m, c, fl))) for c in both])
        return pd.Series(out)

    return (centre.join(signs, "grp", "left")
            .select("grp", F.posexplode(starts("mid", "width", "k", "ss")).alias("start", "e"))
            .select("grp", "start", "e.mean", "e.prec", "e.logdet"))


def mcd_estimates(fit: DataFrame, floor: tuple[float, ...] = FLOOR, steps: int = STEPS) -> DataFrame:
    """``(grp, mean, prec, logdet)``: the reweighted MCD estimate of every group of ``(grp, x0..)``."""
    p = len(floor)
    solve = _solver(floor)
    sizes = fit.groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
    # The half with the smallest distances, as MCD with the highest breakdown point has it.
    half = materialize(sizes.withColumn("h", F.expr(f"(n + {p} + 2) div 2")), "mcd_sizes")
    state = materialize(_first_estimates(fit, floor), "mcd_start")
    factor = F.lit(consistency(0.5, p))
    for k in range(steps):
        binned = _with(fit, state, ["grp"]).withColumn("_b", _bin(_distance(p)))
        hist = binned.groupBy("grp", "start", "_b").agg(F.count(F.lit(1)).alias("c"))
        run = F.sum("c").over(Window.partitionBy("grp", "start").orderBy("_b"))
        cut = (hist.withColumn("_c", run).join(half.select("grp", "h"), "grp").where(F.col("_c") >= F.col("h"))
               .groupBy("grp", "start").agg(F.min("_b").alias("_cut")))
        joined = state.join(cut, ["grp", "start"])
        inner = (_with(fit, materialize(joined, f"mcd_cut_{k}"), ["grp"]).where(_bin(_distance(p)) <= F.col("_cut"))
                 .groupBy("grp", "start").agg(*_moments(p)))
        state = materialize(inner.withColumn("e", solve("k", "s", "ss", factor)).select("grp", "start", "e.*"),
                            f"mcd_step_{k}")
    best = state.groupBy("grp").agg(F.min_by(F.struct("mean", "prec", "logdet"), F.struct("logdet", "start")).alias("e"))
    best = materialize(best.select("grp", "e.*"), "mcd_best")
    inner = (_with(fit, best, ["grp"]).where(_distance(p) <= chi2_quantile(0.975, p))
             .groupBy("grp").agg(*_moments(p)))
    final = inner.withColumn("e", solve("k", "s", "ss", F.lit(consistency(0.975, p)))).select("grp", "e.*")
    return materialize(final, "mcd_final")


def judge_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  source_col: str = "source", alpha: float = ALPHA, min_rows: int = MIN_ROWS) -> DataFrame:
    """Statistics and verdict per row of ``docs``; ``distance`` is null where no estimate exists."""
    p = len(STATS)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                         F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"))
    types = {"id": source.schema["id"].dataType.simpleString(), "lang": "string", "source": "string"}
    schema = ", ".join(f"{n} {types.get(n, 'double' if n[0] == 'x' else 'bigint')}" for n in _stat_names())
    stats = source.mapInArrow(_statistics, schema).withColumn(
        "base_failed", (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    stats = materialize(stats, "quality_stats")
    rows = materialize(_grouped(stats, min_rows), "quality_groups")
    fit = rows.where(~F.col("base_failed") & F.col("grp").isNotNull())
    estimates = mcd_estimates(fit.select("grp", *[f"x{i}" for i in range(p)]))
    judged = rows.join(checked_broadcast(estimates, MAX_BROADCAST_GROUPS), "grp", "left").withColumn(
        "distance", F.when(F.col("mean").isNotNull(), _distance(p)))
    outlier = F.coalesce(F.col("distance") > chi2_quantile(1 - alpha, p), F.lit(False))
    return judged.select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", (~F.col("base_failed") & ~outlier).alias("kept"),
                         "distance", F.col("grp").alias("estimate_group"))


def op1_mcd_quality(spark, sf_dir: str) -> DataFrame:
    return judge_quality(documents(spark, sf_dir))
