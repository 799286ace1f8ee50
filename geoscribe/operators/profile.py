"""Dataset profile: counts, distinct counts, extremes and text means in one pass.

The reference runs eleven separate jobs (eleven scans) for its profile.  Here
every plain metric is one aggregate expression of a single ``agg`` call: one scan,
partial aggregation on every partition, one small shuffle.  Exact distinct
counts are an aggregate per column: each reads only its own column, reduces
it to distinct values on the map side and deals these out by hash, so every
(column, hash bucket) is counted by itself.  Catalyst's plan for several
distinct counts in one ``agg`` multiplies every row by the number of columns
(``Expand``) before the first reduction instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoscribe.functions.text import word_count


def _extreme(agg, df: DataFrame, c: str) -> Column:
    """min/max; for floating point the sign of zero is normalised (``+ 0.0``):
    0.0 and -0.0 compare equal, so which one an extreme returns would depend
    on row order."""
    if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
        return agg(c) + 0.0
    return agg(c)


def distinct_count(df: DataFrame, c: str) -> Column:
    """Exact number of distinct non-null values of a column, as a scalar subquery over that column."""
    return df.select(c).where(F.col(c).isNotNull()).distinct().select(F.count(F.lit(1))).scalar()


def profile_wide(df: DataFrame, text: str | None = None, distinct_cols: list[str] = (),
                 minmax_cols: list[str] = ()) -> DataFrame:
    """One row: n_rows, n_distinct_<c>..., min_<c>..., max_<c>..., avg_chars, avg_words."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    aggs += [_extreme(F.min, df, c).alias(f"min_{c}") for c in minmax_cols]
    aggs += [_extreme(F.max, df, c).alias(f"max_{c}") for c in minmax_cols]
    if text is not None:
        aggs += [F.avg(F.length(text)).alias("avg_chars"), F.avg(word_count(text)).alias("avg_words")]
    plain = df.agg(*aggs)
    distinct = [distinct_count(df, c).alias(f"n_distinct_{c}") for c in distinct_cols]
    return plain.select("n_rows", *distinct, *plain.columns[1:])


def profile_long(wide: DataFrame) -> DataFrame:
    """Turn the one-row profile into ``(ord, metric, value double)`` rows, in column order."""
    stack_args = ", ".join(f"{i + 1}, '{c}', cast(`{c}` as double)" for i, c in enumerate(wide.columns))
    return wide.selectExpr(f"stack({len(wide.columns)}, {stack_args}) as (ord, metric, value)").select(
        F.col("ord").cast("int").alias("ord"), "metric", "value")


def dataset_profile(df: DataFrame, text: str | None = None, distinct_cols: list[str] = (),
                    minmax_cols: list[str] = ()) -> DataFrame:
    return profile_long(profile_wide(df, text, distinct_cols, minmax_cols))


#: Columns of the post table that the profile counts and takes extremes of, in the order of the result.
POST_DISTINCT = ["username", "country_name", "place_name", "language"]
POST_EXTREMES = ["latitude", "longitude"]


def post_profile(posts: DataFrame) -> DataFrame:
    """The eleven metrics of the 13-field post table, one row each."""
    return dataset_profile(posts, "tweet_text", POST_DISTINCT, POST_EXTREMES)


# The published output names of the SQL profile, each with its aggregate.
# (Extremes are taken on doubles, with the sign of zero normalised like ``profile_wide``.)
POST_SQL_METRICS = {
    "number_of_tweets": "count(*)",
    "distinct_users": "count(DISTINCT username)",
    "distinct_countries": "count(DISTINCT country_name)",
    "distinct_places": "count(DISTINCT place_name)",
    "distinct_languages": "count(DISTINCT language)",
    "minimum_latitude": "min(latitude) + 0.0",
    "minimum_longitude": "min(longitude) + 0.0",
    "maximum_latitude": "max(latitude) + 0.0",
    "maximum_longitude": "max(longitude) + 0.0",
}


def aggregate_statement(metrics: dict[str, str], view: str = "{view}") -> str:
    """An SQL statement with one aggregate per named metric."""
    return "SELECT " + ", ".join(f"{agg} AS {name}" for name, agg in metrics.items()) + f" FROM {view}"


def sql_profile(spark: SparkSession, df: DataFrame, sql_template: str) -> DataFrame:
    """Run an aggregate SQL statement on ``df``, which it names ``{view}``.

    Spark registers ``df`` under a name of its own for the statement and drops
    it afterwards, so no view of the session is replaced.
    """
    return spark.sql(sql_template, view=df)
