"""Text sources: tab-separated posts, word lists and query lines.

``spark.read.csv`` is not used for the posts: it honours quotes (an unbalanced
``"`` swallows tabs) and turns empty fields into NULL.  The reference splits
every line on every tab and keeps empty fields, which is ``read.text`` plus a
literal split with limit -1.  Scans stay splittable, so a 100 TB input is read
in ``spark.sql.files.maxPartitionBytes`` slices by every executor at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoscribe.functions.text import query_word_list, split_literal
from geoscribe.operators.index import numbered_lines
from geoscribe.schema import field_spec, post_schema
from geoscribe.session import scratch_path

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _typed(raw: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return raw
    if isinstance(dtype, _INTEGRAL):
        # float() semantics of the reference: "3600.0" is a valid offset.
        return F.coalesce(raw.try_cast(dtype), raw.try_cast(T.DoubleType()).try_cast(dtype))
    return raw.try_cast(dtype)


def parse_fields(lines: DataFrame, schema=None, sep: str = "\t", value_col: str = "value") -> DataFrame:
    """Split each line on every ``sep`` and type the fields by position.

    Missing fields (short lines) and unparsable numbers become NULL instead of
    failing the job; empty fields stay empty strings.
    """
    spec = field_spec(schema if schema is not None else post_schema())
    parts = split_literal(F.col(value_col), sep)
    return lines.select(*[_typed(F.get(parts, i), dtype).alias(name) for i, (name, dtype) in enumerate(spec)])


def reject_reason(schema=None, sep: str = "\t", value_col: str = "value") -> Column:
    """Why a line is not a whole record, NULL for one that is.

    ``short line`` for missing fields, else ``not a number: <field>`` for the first
    field whose text is not one.  Extra fields are no fault.
    """
    spec = field_spec(schema if schema is not None else post_schema())
    parts = split_literal(F.col(value_col), sep)
    wrong = [F.when(_typed(F.get(parts, i), dtype).isNull(), F.lit(f"not a number: {name}"))
             for i, (name, dtype) in enumerate(spec) if not isinstance(dtype, T.StringType)]
    return F.when(F.size(parts) < len(spec), F.lit("short line")).otherwise(F.coalesce(*wrong, F.lit(None).cast("string")))


def scan_delimited(spark: SparkSession, path: str, schema=None, sep: str = "\t") -> DataFrame:
    """Read delimited text lines into typed, named columns."""
    return parse_fields(spark.read.text(path), schema, sep)


def scan_with_rejects(spark: SparkSession, path: str, schema=None, sep: str = "\t",
                      observation: Observation | None = None) -> DataFrame:
    """The typed columns of every line with ``_reject`` (its reason) and ``_line`` (its text, for rejects only).

    An ``Observation`` gets ``n_lines`` and ``n_rejected`` from whatever action
    first reads the result, in that same pass.
    """
    spec = field_spec(schema if schema is not None else post_schema())
    lines = spark.read.text(path).withColumn("_reject", reject_reason(spec, sep))
    if observation is not None:
        lines = lines.observe(observation, F.count(F.lit(1)).alias("n_lines"), F.count("_reject").alias("n_rejected"))
    parts = split_literal(F.col("value"), sep)
    typed = [_typed(F.get(parts, i), dtype).alias(name) for i, (name, dtype) in enumerate(spec)]
    return lines.select(*typed, "_reject", F.when(F.col("_reject").isNotNull(), F.col("value")).alias("_line"))


def stage_delimited(spark: SparkSession, path: str, schema=None, sep: str = "\t",
                    observation: Observation | None = None) -> tuple[DataFrame, DataFrame]:
    """Parse a delimited input once into staged Parquet: ``(whole records, rejects)``.

    One pass over the text writes both, apart by folder, so later reads of the
    records prune columns and never see the rejects ``(reason, line)``.
    """
    out = scratch_path(spark, "staged_lines")
    scanned = scan_with_rejects(spark, path, schema, sep, observation)
    scanned.withColumn("_rejected", F.col("_reject").isNotNull()).write.partitionBy("_rejected").parquet(out)
    staged = spark.read.schema(scanned.schema.add("_rejected", "boolean")).parquet(out)
    records = staged.where(~F.col("_rejected")).drop("_reject", "_line", "_rejected")
    rejects = staged.where(F.col("_rejected")).select(F.col("_reject").alias("reason"), F.col("_line").alias("line"))
    return records, rejects


def scan_word_list(spark: SparkSession, path: str, col: str = "word") -> DataFrame:
    """One word per line (a stop-word file)."""
    return spark.read.text(path).select(F.col("value").alias(col))


def scan_query_lines(spark: SparkSession, path: str, first_line_only: bool = True) -> DataFrame:
    """Query texts, one per line: ``(query_id, file, line, words)``.

    ``query_id`` is the line's index over all files in the order of their paths, and
    ``line`` its number in its file (both from 0), whatever the splits.  With
    ``first_line_only`` only the first line of the first file is a query, as in
    the reference's classifier; the top-1 is a global TakeOrdered over one scan.
    """
    if not first_line_only:
        numbered = numbered_lines(spark, path)
        return numbered.select(F.col("index").alias("query_id"), "file", "line", query_word_list("value").alias("words"))
    df = spark.read.text(path).select(
        F.monotonically_increasing_id().alias("place"), F.col("value").alias("first"),
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    first = df.orderBy("file", "start", "place").limit(1)
    zero = F.lit(0).cast("bigint")
    return first.select(zero.alias("query_id"), "file", zero.alias("line"), query_word_list("first").alias("words"))
