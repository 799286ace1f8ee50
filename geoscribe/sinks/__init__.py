"""Sinks: tab-separated text, headed CSV, one-value-per-line metrics.

Results are written by the executors straight from the DataFrame; nothing is
collected and re-parallelised.  Ordered text is written in range-sorted parts, in
parallel; in name order the parts concatenate to the sorted list, and a
``_manifest`` beside them (JSON lines: part, file, rows, rows before it, first
line) lets a reader go to any position without listing or counting anything.
``single_file=True`` mirrors the reference's one ``part-00000`` per result; one
task then sorts and writes all of it, so it is for results of a bounded size
(top-k, one row, a fixed list of metrics).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoscribe.functions.text import python_float_text
from geoscribe.operators.index import numbered_lines

#: Readers of the folder skip names that begin with an underscore.
MANIFEST = "_manifest"


def _as_text(df: DataFrame | None, c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    if df is not None and isinstance(c, str) and isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
        return python_float_text(col)          # 1e-05, not Java's 1.0E-5
    return col.cast("string")


def tsv_line(*cols: str | Column, sep: str = "\t", df: DataFrame | None = None) -> Column:
    """``'{}\\t{}'.format(...)`` as a column: every value as text, doubles
    written as Python writes them when the source DataFrame is given."""
    return F.concat_ws(sep, *[_as_text(df, c) for c in cols])


def write_tsv(df: DataFrame, path: str, cols: list[str], order_by: list[Column] | None = None,
              single_file: bool = False, mode: str = "overwrite") -> str:
    out = df
    if order_by:
        out = out.orderBy(*order_by)
    out = out.select(tsv_line(*cols, df=out).alias("value"))
    if single_file:
        out = out.coalesce(1)
    out.write.mode(mode).text(path)
    if order_by and not single_file:
        write_manifest(df.sparkSession, path)
    return path


def write_manifest(spark: SparkSession, path: str) -> None:
    """``_manifest`` of the ordered text parts in ``path``: one row per part, read by one task."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_name").alias("file"), "value",
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("place"))
    parts = lines.groupBy("file").agg(F.count(F.lit(1)).alias("rows"), F.min_by("value", "place").alias("first_line"))
    by_name = Window.orderBy("file")
    before = F.coalesce(F.sum("rows").over(by_name.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    manifest = parts.select((F.row_number().over(by_name) - 1).alias("part"), "file", "rows",
                            before.alias("rows_before"), "first_line")
    manifest.coalesce(1).write.mode("overwrite").json(f"{path}/{MANIFEST}")


def read_ordered(spark: SparkSession, path: str) -> DataFrame:
    """``(index, value)`` of ordered parts: the manifest's offset of the part plus the line's number in it."""
    manifest = spark.read.schema("file string, rows_before long").json(f"{path}/{MANIFEST}")
    lines = numbered_lines(spark, path).withColumn("file", F.element_at(F.split("file", "/"), -1))
    # One row per part: at most as many as the writer had partitions.
    return lines.join(F.broadcast(manifest), "file").select((F.col("rows_before") + F.col("line")).alias("index"), "value")


def write_csv(df: DataFrame, path: str, header: bool = True, order_by: list[Column] | None = None,
              single_file: bool = False, mode: str = "overwrite") -> str:
    out = df.orderBy(*order_by) if order_by else df
    if single_file:
        out = out.coalesce(1)
    out.write.mode(mode).option("header", header).csv(path)
    return path


def write_metric_lines(profile: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Long-form profile ``(ord, metric, value)``, a fixed list of metrics, as one value per line, in ``ord`` order."""
    return write_tsv(profile, path, ["value"], order_by=[F.col("ord")], single_file=True, mode=mode)
