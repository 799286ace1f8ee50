"""Registered queries that write files and read them back: numbered query files,
ordered sinks with their manifest, the metrics file, and the reference's Tasks 2-4
run from 13-field TSV with rejects apart.  Each has a DuckDB twin over the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from geoscribe import sinks
from geoscribe.functions.text import lines, python_float_text
from geoscribe.operators import groups, profile
from geoscribe.plans import posts, tasks
from geoscribe.schema import field_spec, post_schema
from geoscribe.session import scratch_path
from geoscribe.sources import scan_query_lines, stage_delimited, table

# Folders of the query file set, and which events also leave a broken line.
QUERY_FOLDERS = 8
SHORT_EVERY, WORD_EVERY, OFFSET_EVERY = 97, 101, 103


def query_file_lines(spark, d):
    """Every line of a folder of query files: its number in its file, its index over all files, its words.

    The benchmark's lines are written as one file per folder, in item order, and scanned
    as a multi-file query input.
    """
    per_line = (table(spark, d, "benchmark").select("item_id", F.posexplode(lines("text")).alias("line_no", "value"))
                .withColumn("folder", F.pmod("item_id", F.lit(QUERY_FOLDERS))))
    path = scratch_path(spark, "query_files")
    dealt = per_line.repartition(QUERY_FOLDERS, "folder").sortWithinPartitions("folder", "item_id", "line_no")
    dealt.select("folder", "value").write.partitionBy("folder").text(path)
    numbered = scan_query_lines(spark, path, first_line_only=False)
    folder = F.regexp_extract("file", "folder=([0-9]+)/", 1).cast("bigint")
    return numbered.select(folder.alias("folder"), "line", F.col("query_id").alias("index"),
                           F.array_join("words", " ").alias("words"))


def metrics_file(spark, d):
    """The dataset profile written as one value per line, and read back by line number."""
    long = profile.dataset_profile(table(spark, d, "documents"), text="text",
                                   distinct_cols=["source", "lang"], minmax_cols=["n_chars"])
    as_text = F.when(F.col("metric").startswith("avg_"), python_float_text("value")).otherwise(
        F.col("value").cast("bigint").cast("string"))
    path = scratch_path(spark, "metrics")
    sinks.write_metric_lines(long.select("ord", as_text.alias("value")), path)
    back = sinks.numbered_lines(spark, path)
    return back.select((F.col("line") + 1).cast("int").alias("ord"), F.round(F.col("value").cast("double"), 6).alias("value"))


def sink_ordered(spark, d):
    """Users ranked by their events, written in ordered parts, and read back with each line's position."""
    ranked = groups.count_by_key(table(spark, d, "events"), "user_id")
    path = scratch_path(spark, "ranked_users")
    sinks.write_tsv(ranked, path, ["user_id", "n"], order_by=groups.rank_order("user_id"))
    parts = F.split("value", "\t", -1)
    return sinks.read_ordered(spark, path).select("index", F.get(parts, 0).cast("bigint").alias("user_id"),
                                                  F.get(parts, 1).cast("bigint").alias("n"))


def _post_lines(spark, d) -> DataFrame:
    """The derived posts as TSV lines; some events leave a broken line as well."""
    ev = table(spark, d, "events")
    whole = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c, _ in field_spec(post_schema())]
    lines_of = posts.derived_posts(spark, d).select(F.concat_ws("\t", *whole).alias("value"))
    broken = ev.select(F.explode(F.filter(F.array(
        F.when(F.col("event_id") % SHORT_EVERY == 0, F.concat_ws("\t", F.lit("0"), F.lit("nowhere"), "event_type")),
        F.when(F.col("event_id") % WORD_EVERY == 0, _broken_line("0", "north")),
        F.when(F.col("event_id") % OFFSET_EVERY == 0, _broken_line("UTC+1", "0.5"))), lambda v: v.isNotNull())).alias("value"))
    return lines_of.unionByName(broken)


def _broken_line(offset: str, latitude: str):
    odd = {"utc_time": "0", "timezone_offset": offset, "number_of_friends": "1", "latitude": latitude, "longitude": "0.5"}
    return F.lit("\t".join(odd.get(c, "x") for c, _ in field_spec(post_schema())))


def _staged_posts(spark, d, observation: Observation | None = None) -> tuple[DataFrame, DataFrame]:
    path = scratch_path(spark, "posts_tsv")
    _post_lines(spark, d).write.text(path)
    return stage_delimited(spark, path, observation=observation)


def post_tsv_tasks(spark, d):
    """Tasks 2, 3 and 4 from the scanned text: ``(task, country_name, a, b)``."""
    records, _ = _staged_posts(spark, d)
    null = F.lit(None).cast("double")
    as_double = [F.col(c).cast("double") for c in ("n", "hour")]
    sizes = tasks.task2_country_counts(records).select(F.lit(2).alias("task"), "country_name", as_double[0].alias("a"), null.alias("b"))
    centroids = tasks.task3_country_centroids(records).select(
        F.lit(3).alias("task"), "country_name", F.round("latitude", 6).alias("a"), F.round("longitude", 6).alias("b"))
    peaks = tasks.task4_peak_hour(records).select(
        F.lit(4).alias("task"), "country_name", as_double[1].alias("a"), as_double[0].alias("b"))
    return sizes.unionByName(centroids).unionByName(peaks)


def post_tsv_rejects(spark, d):
    """Lines that are not whole records, by reason."""
    _, rejects = _staged_posts(spark, d)
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    "query_file_lines": query_file_lines,
    "metrics_file": metrics_file,
    "sink_ordered": sink_ordered,
    "post_tsv_tasks": post_tsv_tasks,
    "post_tsv_rejects": post_tsv_rejects,
}


# ------------------------------------------------------------------- oracle SQL

_POSTS = posts._POSTS_CTE

ORACLE_SQL = {
    "sink_ordered": """
        SELECT row_number() OVER (ORDER BY n DESC, user_id) - 1 AS index, user_id, n
        FROM (SELECT user_id, count(*) AS n FROM events GROUP BY user_id)""",
    "post_tsv_tasks": f"""
        WITH {_POSTS},
        h AS (SELECT country_name,
                     CAST(floor(((utc_time + CAST(timezone_offset AS BIGINT) * 1000) % 86400000 + 86400000)
                                % 86400000 / 3600000) AS BIGINT) AS hour FROM posts),
        c AS (SELECT country_name, hour, count(*) AS n FROM h GROUP BY country_name, hour),
        p AS (SELECT country_name, hour, n,
                     row_number() OVER (PARTITION BY country_name ORDER BY n DESC, hour ASC) AS rn FROM c)
        SELECT 2 AS task, country_name, CAST(count(*) AS DOUBLE) AS a, CAST(NULL AS DOUBLE) AS b
        FROM posts GROUP BY country_name
        UNION ALL SELECT 3, country_name, round(avg(latitude), 6), round(avg(longitude), 6)
        FROM posts GROUP BY country_name HAVING count(*) >= 11
        UNION ALL SELECT 4, country_name, CAST(hour AS DOUBLE), CAST(n AS DOUBLE) FROM p WHERE rn = 1""",
    "post_tsv_rejects": f"""
        SELECT * FROM (
            SELECT 'short line' AS reason, count(*) AS n FROM events WHERE event_id % {SHORT_EVERY} = 0
            UNION ALL SELECT 'not a number: latitude', count(*) FROM events WHERE event_id % {WORD_EVERY} = 0
            UNION ALL SELECT 'not a number: timezone_offset', count(*) FROM events WHERE event_id % {OFFSET_EVERY} = 0)
        WHERE n > 0""",
}
