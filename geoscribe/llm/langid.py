"""Language identification by words first, character n-grams for the rest.

A word known to the model scores its log frequency in every language.  An
unseen word falls back to its character n-grams: the longest order that knows
any of them decides, with the mean log frequency of the known ones.  A text's
language has the largest sum; the score is its posterior under equal priors.

The model is fitted on at most ``FIT_DOCS`` distinct texts per language (those with
the smallest hashes; none more once they hold ``FIT_CHARS`` characters) and keeps
every word and every n-gram of that sample, counted by Spark.  The sample bounds
the model, which travels with the task.  All texts are scored whole.

Nulls: rows with a null id or language are not learned from; a null text, or
one without a letter, is ``und`` with score 0, as is everything if nothing
could be learned.  Of languages with equal sums the first by name is taken.
Repeated rows are predicted alike; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoscribe.llm.common import documents, materialize

#: Bounds of the fit sample, per language: texts, and characters after which no further text is taken.
FIT_DOCS = 2_000
FIT_CHARS = 8_000_000
LONGEST = 5
SMOOTH = 0.5
FOLDS, HELD_OUT = 4, 2
#: Log frequencies of unseen words that a task keeps, and words summed at a time (the least room of that cache).
MEMO_VALUES = 1_000_000
BLOCK_WORDS = 1_000
UNDETERMINED = "und"

_LETTERS = re.compile(r"[^\W\d_]+")


def held_out(id_: Column) -> Column:
    return F.coalesce(F.crc32(id_.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def words_of(text: str | None) -> list[str]:
    return _LETTERS.findall(text.lower()) if text else []


def _grams(word: str, n: int) -> list[str]:
    w = f" {word} "
    return [w[i:i + n] for i in range(len(w) - n + 1)] if n > 1 else list(word)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        seen: Counter = Counter()
        for lang, text in zip(b.column("lang").to_pylist(), b.column("text")):
            seen.update((lang, w) for w in words_of(text.as_py()))
        yield _counted(seen)


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        seen: Counter = Counter()
        for lang, word, c in zip(*(b.column(k).to_pylist() for k in ("lang", "item", "c"))):
            for n in range(1, LONGEST + 1):
                for g in _grams(word, n):
                    seen[lang, g] += c
        yield _counted(seen)


def _counted(seen: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([k[0] for k in seen], pa.string()),
                                       pa.array([k[1] for k in seen], pa.string()),
                                       pa.array(list(seen.values()), pa.int64())], names=["lang", "item", "c"])


_COUNTED = "lang string, item string, c bigint"


class Model:
    """Log frequencies: ``tables[0]`` of words, ``tables[n]`` of n-grams, each item -> row of a matrix."""

    def __init__(self, langs: list[str], counts: list[dict[str, np.ndarray]], totals: list[np.ndarray]):
        self.langs = langs
        self.tables = []
        for items, total in zip(counts, totals):
            c = np.array(list(items.values()), np.float64).reshape(len(items), len(langs))
            self.tables.append((dict(zip(items, range(len(items)))),
                                np.log((c + SMOOTH) / (total + SMOOTH * max(len(items), 1)))))

    def scorer(self) -> Callable[[str | None], tuple[str, float]]:
        known, log_words = self.tables[0]
        rows = _Rows(known, log_words, self._unseen, max(1_000, MEMO_VALUES // max(len(self.langs), 1)))

        def score(text: str | None) -> tuple[str, float]:
            found = words_of(text)
            if not found or not self.langs:
                return UNDETERMINED, 0.0
            total = np.zeros(len(self.langs))
            for i in range(0, len(found), BLOCK_WORDS):
                total += rows.total(found[i:i + BLOCK_WORDS])
            best = int(total.argmax())
            return self.langs[best], float(1 / np.exp(np.clip(total - total[best], -700, 0)).sum())

        return score

    def _unseen(self, word: str) -> np.ndarray:
        for n in range(LONGEST, 0, -1):
            index, logs = self.tables[n]
            at = [r for r in map(index.get, _grams(word, n)) if r is not None]
            if at:
                return logs[at].mean(0)
        return np.zeros(len(self.langs))


class _Rows(dict):
    """Word -> row of a matrix of log frequencies; rows of unseen words are added as they come.

    The added rows are a cache: when it is full they are dropped and computed again.
    """

    def __init__(self, known: dict[str, int], logs: np.ndarray, unseen: Callable[[str], np.ndarray], room: int):
        super().__init__(known)
        self.known, self.unseen, self.room = known, unseen, room
        self.matrix = np.concatenate([logs, np.zeros((room, logs.shape[1]))])

    def __missing__(self, word: str) -> int:
        row = len(self)
        self.matrix[row] = self.unseen(word)
        self[word] = row
        return row

    def total(self, words: list[str]) -> np.ndarray:
        if len(self) + len(words) > len(self.matrix):
            self.clear()
            self.update(self.known)
        return self.matrix[list(map(self.__getitem__, words))].sum(0)


def fit_sample(train: DataFrame, fit_docs: int, fit_chars: int = FIT_CHARS) -> DataFrame:
    """At most ``fit_docs`` distinct whole texts of each language, those with the smallest hashes.

    A text is left out if those before it hold ``fit_chars`` characters or more.

    The counts by language give a hash that about twice as many texts stay below (fewer where most rows are
    copies), so that only those are ranked; a text repeated often counts once, before and after the shuffle.
    """
    room = F.lit(2.0 * fit_docs + 100)
    counts = train.groupBy("lang").agg(F.count(F.lit(1)).alias("_n"))
    share = {r.lang: r.share for r in counts.select("lang", (room / F.col("_n")).alias("share")).where("share < 1").collect()}
    low = F.expr("shiftrightunsigned(xxhash64(text), 1)") / F.lit(float(1 << 63))
    near = train.where(F.col("text").isNotNull()).select("lang", "text", low.alias("_low"))
    if share:
        bound = F.create_map(*[F.lit(x) for kv in sorted(share.items()) for x in kv])
        near = near.where(F.col("_low") < F.coalesce(F.try_element_at(bound, F.col("lang")), F.lit(1.0)))
    first = Window.partitionBy("lang").orderBy("_low", "text")
    before = first.rowsBetween(Window.unboundedPreceding, -1)
    return (near.groupBy("lang", "text", "_low").agg(F.count(F.lit(1)).alias("_n"))
            .withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= fit_docs)
            .withColumn("_chars", F.coalesce(F.sum(F.length("text")).over(before), F.lit(0)))
            .where(F.col("_chars") < fit_chars).select("lang", "text"))


def fit(train: DataFrame, fit_docs: int = FIT_DOCS, fit_chars: int = FIT_CHARS) -> Model:
    """Fit on ``(lang, text)`` rows; null languages must be gone."""
    sample = fit_sample(train, fit_docs, fit_chars).select("lang", "text")

    def summed(df: DataFrame) -> DataFrame:
        return df.groupBy("lang", "item").agg(F.sum("c").alias("c"))

    words = materialize(summed(sample.mapInArrow(_count_words, _COUNTED)), "lang_words").withColumn("n", F.lit(0))
    grams = summed(words.select("lang", "item", "c").mapInArrow(_count_grams, _COUNTED)).withColumn(
        "n", F.length("item"))
    both = materialize(words.unionByName(grams), "lang_items")
    totals = {(r.lang, r.n): r.s for r in both.groupBy("lang", "n").agg(F.sum("c").alias("s")).collect()}
    kept = both.select("lang", "n", "item", "c").toArrow()             # bounded by the sample
    langs = sorted({lang for lang, _ in totals})
    at = {lang: i for i, lang in enumerate(langs)}
    counts: list[dict[str, np.ndarray]] = [{} for _ in range(LONGEST + 1)]
    for lang, n, item, c in zip(*(kept.column(k).to_pylist() for k in ("lang", "n", "item", "c"))):
        counts[n].setdefault(item, np.zeros(len(langs)))[at[lang]] = c
    return Model(langs, [dict(sorted(c.items())) for c in counts],
                 [np.array([float(totals.get((lang, n), 0)) for lang in langs]) for n in range(LONGEST + 1)])


def predict_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                     fit_docs: int = FIT_DOCS) -> DataFrame:
    """``(id, held_out, lang_pred, score)`` per row; learned from rows that are not held out."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       F.col(lang_col).cast("string").alias("lang"))
    train = rows.where(F.col("id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("id")))
    model = fit(train, fit_docs)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = model.scorer()
        for b in batches:
            got = [score(t.as_py()) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                names=["id", "lang_pred", "score"])

    kind = rows.schema["id"].dataType.simpleString()
    out = rows.select("id", "text").mapInArrow(predict, f"id {kind}, lang_pred string, score double")
    return out.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "lang_pred", "score")


def op4_word_backoff_language(spark, sf_dir: str) -> DataFrame:
    return predict_language(documents(spark, sf_dir))
