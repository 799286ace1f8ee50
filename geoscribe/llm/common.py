"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoscribe.session import materialize
from geoscribe.sources.tables import table

__all__ = ["WORD", "JAVA_WORD", "ASCII_LOWER", "documents", "pages", "benchmark", "materialize", "null_safe", "free_name",
           "word_count", "ascii_lower"]

#: Words are maximal runs of anything but the six ASCII white-space characters.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
JAVA_WORD = r"[^\x20\x09-\x0D]+"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ASCII_LOWER = str.maketrans(_UPPER, _LOWER)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark")


def word_count(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(JAVA_WORD)), F.lit(0)).cast("long")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, _UPPER, _LOWER)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on ``keys`` with null equal to null; the right side's keys are dropped."""
    other = {k: free_name(left, f"_r_{k}") for k in keys}
    renamed = right.select(*[F.col(c).alias(other.get(c, c)) for c in right.columns])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(renamed[other[k]])
        cond = c if cond is None else cond & c
    joined = left.join(renamed, cond, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*other.values())
