"""Row sampling without replacement.

The reference draws ``sample(False, 0.1, 5)``: each row by itself, with a fixed
seed.  ``sample_rows`` makes that draw a function of (seed, file name, row
position), a counter-based generator: rows that are copies of one another are
drawn apart, and the same rows come back however the scan is split, on any
engine that can number the rows of a file.  ``sample_hash`` draws by a key instead
(copies of a key go together), and ``sample_native`` is Spark's own sampler, whose
rows depend on how the input is partitioned.  All are filters in the scan stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoscribe.operators.index import numbered_lines

HASH_BITS = 60


def sample_native(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def key_hash(key: str | Column) -> Column:
    """First 60 bits of md5(key as text)."""
    k = F.col(key) if isinstance(key, str) else key
    return F.conv(F.substring(F.md5(k.cast("string")), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def sample_hash(df: DataFrame, key: str | Column, fraction: float) -> DataFrame:
    """Rows whose key hash lies below ``fraction`` of the hash range, at full resolution."""
    return df.where(key_hash(key) < int(fraction * (1 << HASH_BITS)))


def position_draw(seed: int, file_name: Column, position: Column) -> Column:
    """The draw of one row: 60 bits that depend on the seed and the row's place in its file."""
    return key_hash(F.concat_ws(":", F.lit(str(seed)), file_name, position.cast("string")))


def sample_rows(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """Bernoulli sample of a Parquet scan (``spark.read.parquet``, not yet projected) by row position.

    Files are told apart by their names without folders, so a moved table gives the same rows.
    """
    draw = position_draw(seed, F.col("_metadata.file_name"), F.col("_metadata.row_index"))
    return df.where(draw < int(fraction * (1 << HASH_BITS)))


def sample_lines(spark: SparkSession, path: str, fraction: float, seed: int) -> DataFrame:
    """Bernoulli sample of text lines by (file name, line number): one column ``value``."""
    name = F.element_at(F.split("file", "/"), -1)
    lines = numbered_lines(spark, path)
    return lines.where(position_draw(seed, name, F.col("line")) < int(fraction * (1 << HASH_BITS))).select("value")
