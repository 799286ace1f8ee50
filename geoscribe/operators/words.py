"""Token table, stop-word removal and word counts.

Tokens follow the reference exactly: split the text on every single blank,
keep tokens of at least two characters (counted before lower-casing), then
lower-case.  Counting is ``groupBy(word).count()`` with map-side combine; a
very frequent word costs one partial row per partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoscribe.functions.text import words as split_words
from geoscribe.operators.joins import anti_join

# A short English stop-word list used by the catalogue queries.
STOP_WORDS = ("the", "of", "and", "to", "is", "in")


def token_table(df: DataFrame, text: str, keep: list[str] = (), min_len: int = 2, word: str = "word") -> DataFrame:
    """One row per kept token: ``keep`` columns plus ``word`` (lower-cased)."""
    exploded = df.select(*keep, F.explode(split_words(text)).alias("_tok"))
    return exploded.where(F.length("_tok") >= min_len).select(*keep, F.lower("_tok").alias(word))


def remove_stopwords(tokens: DataFrame, stop, word: str = "word") -> DataFrame:
    """Drop every token equal to a stop word; other duplicates are kept (bag difference).

    ``stop`` is a Python collection (a literal ``IN`` set evaluated in the scan
    stage, no join) or a one-column DataFrame of words: an anti join with the
    word list broadcast behind a size check, and beyond it behind a Bloom filter,
    so tokens are not shuffled by word either way.
    """
    if isinstance(stop, DataFrame):
        return anti_join(tokens, stop, word)
    return tokens.where(~F.col(word).isin(list(stop)))


def word_counts(tokens: DataFrame, by: list[str] = (), word: str = "word", n: str = "n") -> DataFrame:
    return tokens.groupBy(*by, word).agg(F.count(F.lit(1)).alias(n))


def top_words(tokens: DataFrame, k: int, word: str = "word", n: str = "n") -> DataFrame:
    """The ``k`` most frequent words, ties broken by word ascending (a global
    TakeOrdered: each partition keeps its own top ``k`` before the merge)."""
    return word_counts(tokens, (), word, n).orderBy(F.col(n).desc(), F.col(word).asc()).limit(k)


def token_stats(tokens: DataFrame, by: list[str], word: str = "word") -> DataFrame:
    """Tokens and distinct tokens per group."""
    return tokens.groupBy(*by).agg(F.count(F.lit(1)).alias("n_tokens"),
                                   F.count_distinct(word).alias("n_distinct"))
