"""Positions of rows: line numbers over a folder of text files, and a global index in an order.

Both number rows without bringing them to one task: every split (or sorted
partition) counts its own rows, the counts, one per split or partition, become
offsets by a running sum, and each row adds its place to its split's offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geoscribe.operators.joins import checked_broadcast
from geoscribe.session import materialize

#: ``monotonically_increasing_id`` is the partition number above this many bits, the row's place below.
PLACE_BITS = 33


def _partition(mid: str) -> Column:
    return F.shiftright(mid, PLACE_BITS)


def _before(order: list[str], by: list[str] = ()):
    w = Window.partitionBy(*by).orderBy(*order) if by else Window.orderBy(*order)
    return w.rowsBetween(Window.unboundedPreceding, -1)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, line, index, value)`` for every line of the text files under ``path``.

    ``line`` counts from 0 in each file; ``index`` counts from 0 over all files in
    the order of their paths.  Splits of one file may be read by different tasks
    in any order.  The text is scanned twice: once to count each split's lines (a
    row per split, so a row per 128 MB of input by default, goes on), once to
    number them.  Both scans read the same listed files and their splits are named
    by file and start, so the counts fit whatever partition a split is packed in.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_mid"), "value")
    splits = lines.groupBy("file", "_start").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    files = splits.groupBy("file").agg(F.sum("_n").alias("_n"))
    files = files.select("file", F.coalesce(F.sum("_n").over(_before(["file"])), F.lit(0)).alias("_file_offset"))
    in_file = F.coalesce(F.sum("_n").over(_before(["_start"], ["file"])), F.lit(0))
    offsets = (splits.withColumn("_line_offset", in_file).join(files, "file")
               .select("file", "_start", (F.col("_line_offset") - F.col("_first")).alias("_line_shift"), "_file_offset"))
    offsets = checked_broadcast(materialize(offsets, "line_offsets"))
    line = F.col("_mid") + F.col("_line_shift")
    return lines.join(offsets, ["file", "_start"]).select(
        "file", line.alias("line"), (F.col("_file_offset") + line).alias("index"), "value")


def global_index(df: DataFrame, order: list[Column], index: str = "index") -> DataFrame:
    """``df`` with every row's position (from 0) in ``order``, over all partitions.

    The rows are range-sorted and written once, so that counting and numbering see
    the same places; rows that ``order`` does not tell apart keep the place they
    were written at.  One offset per sorted partition is broadcast.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_mid", F.monotonically_increasing_id())
    placed = materialize(placed, "global_index")
    counts = placed.groupBy(_partition("_mid").alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(_before(["_part"])), F.lit(0)).alias("_offset"))
    place = F.col("_mid").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return (placed.withColumn("_part", _partition("_mid")).join(F.broadcast(offsets), "_part")
            .select(*df.columns, (F.col("_offset") + place).alias(index)))
