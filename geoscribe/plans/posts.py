"""The reference's own tasks, run on a 13-field post table derived from the
driver tables, each with a DuckDB twin.

The post table is derived only through the tables' keys: one post per event,
written by the event's customer, in the customer's nation and region.

    utc_time          epoch milliseconds of events.ts
    country_name      nation.n_name
    country_code      region.r_name
    place_type        lower(customer.c_mktsegment)
    place_name        c_mktsegment || ', ' || n_name
    language          events.event_type
    username          customer.c_name       (user_screen_name: upper case)
    timezone_offset   (n_nationkey - 12) * 3600 seconds
    number_of_friends floor(c_acctbal)
    tweet_text        event_type || ' ' || props
    latitude          events.value
    longitude         props.k

The queries call the same task functions as the command line, with the
country filter set to a region present in the data instead of 'US'.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoscribe.operators import words
from geoscribe.operators.joins import dimension_join
from geoscribe.plans import tasks
from geoscribe.sources import table

# The filters standing in for the reference's 'US' / 'city'.
POST_CODE = "AMERICA"
POST_PLACE_TYPE = "building"
POST_STOP = words.STOP_WORDS


def _epoch():
    """The epoch as a TIMESTAMP_NTZ literal parsed from text: no time zone involved."""
    return F.lit("1970-01-01 00:00:00").cast(T.TimestampNTZType())


def derived_posts(spark, d: str) -> DataFrame:
    ev = table(spark, d, "events")
    cust = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment", "c_acctbal")
    nation = table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, d, "region").select("r_regionkey", "r_name")
    # customer x nation x region is unique per customer; events meet one join, by broadcast
    # while that table is small and with hot customers apart beyond.
    who = (cust.join(nation, cust.c_nationkey == nation.n_nationkey)
           .join(region, nation.n_regionkey == region.r_regionkey))
    posts = dimension_join(ev, who, [("user_id", "c_custkey")])
    return posts.select(
        F.timestamp_diff("MILLISECOND", _epoch(), F.col("ts")).alias("utc_time"),
        F.col("n_name").alias("country_name"),
        F.col("r_name").alias("country_code"),
        F.lower("c_mktsegment").alias("place_type"),
        F.concat_ws(", ", "c_mktsegment", "n_name").alias("place_name"),
        F.col("event_type").alias("language"),
        F.col("c_name").alias("username"),
        F.upper("c_name").alias("user_screen_name"),
        ((F.col("n_nationkey") - 12) * 3600).cast("int").alias("timezone_offset"),
        F.floor("c_acctbal").cast("bigint").alias("number_of_friends"),
        F.concat_ws(" ", "event_type", "props").alias("tweet_text"),
        F.col("value").alias("latitude"),
        F.get_json_object("props", "$.k").try_cast(T.DoubleType()).alias("longitude"),
    )


def post_profile(spark, d):
    return tasks.task1_profile(derived_posts(spark, d)).withColumn("value", F.round("value", 6))


def post_country_counts(spark, d):
    return tasks.task2_country_counts(derived_posts(spark, d))


def post_centroids(spark, d):
    c = tasks.task3_country_centroids(derived_posts(spark, d))
    return c.select("country_name", F.round("latitude", 6).alias("latitude"), F.round("longitude", 6).alias("longitude"))


def post_peak_hour(spark, d):
    return tasks.task4_peak_hour(derived_posts(spark, d))


def post_place_counts(spark, d):
    return tasks.task5_us_city_counts(derived_posts(spark, d), POST_CODE, POST_PLACE_TYPE)


def post_top_words(spark, d):
    return tasks.task6_top_us_words(derived_posts(spark, d), POST_STOP, code=POST_CODE)


def post_top_place_words(spark, d):
    ranked = tasks.task7_top_words_of_top_cities(derived_posts(spark, d), POST_STOP, wide=False,
                                                 code=POST_CODE, place_type=POST_PLACE_TYPE)
    return ranked.select("place_name", F.col("rank").cast("bigint").alias("rank"), "word", "n")


def post_sql_profile(spark, d):
    return tasks.task8_sql_profile(spark, derived_posts(spark, d))


def post_classify(spark, d):
    """Most probable place for each event type used as a one-word query."""
    queries = (table(spark, d, "events").select(F.col("event_type").alias("query_id")).distinct()
               .select("query_id", F.array(F.lower("query_id")).alias("words")))
    return tasks.classify(derived_posts(spark, d), queries)


QUERIES = {
    "post_profile": post_profile,
    "post_country_counts": post_country_counts,
    "post_centroids": post_centroids,
    "post_peak_hour": post_peak_hour,
    "post_place_counts": post_place_counts,
    "post_top_words": post_top_words,
    "post_top_place_words": post_top_place_words,
    "post_sql_profile": post_sql_profile,
    "post_classify": post_classify,
}


# ------------------------------------------------------------------- oracle SQL

_STOP_SQL = ", ".join(f"'{w}'" for w in POST_STOP)

_POSTS_CTE = """
    posts AS (
        SELECT epoch_ms(e.ts) AS utc_time, n.n_name AS country_name, r.r_name AS country_code,
               lower(c.c_mktsegment) AS place_type, c.c_mktsegment || ', ' || n.n_name AS place_name,
               e.event_type AS language, c.c_name AS username,
               CAST((n.n_nationkey - 12) * 3600 AS INTEGER) AS timezone_offset,
               e.event_type || ' ' || e.props AS tweet_text, e.value AS latitude,
               try_cast(json_extract_string(e.props, '$.k') AS DOUBLE) AS longitude
        FROM events e JOIN customer c ON e.user_id = c.c_custkey
        JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)
"""

_TOKENS_CTE = """
    tok AS (SELECT country_code, place_name, unnest(string_split(tweet_text, ' ')) AS t FROM posts),
    tw AS (SELECT country_code, place_name, lower(t) AS word FROM tok WHERE length(t) >= 2)
"""

_METRICS = [
    ("n_rows", "count(*)"),
    ("n_distinct_username", "count(DISTINCT username)"),
    ("n_distinct_country_name", "count(DISTINCT country_name)"),
    ("n_distinct_place_name", "count(DISTINCT place_name)"),
    ("n_distinct_language", "count(DISTINCT language)"),
    ("min_latitude", "min(latitude) + 0.0"),
    ("min_longitude", "min(longitude) + 0.0"),
    ("max_latitude", "max(latitude) + 0.0"),
    ("max_longitude", "max(longitude) + 0.0"),
    ("avg_chars", "avg(length(tweet_text))"),
    ("avg_words", "avg(len(string_split(tweet_text, ' ')))"),
]

_PROFILE_SQL = f"WITH {_POSTS_CTE}\n" + "\nUNION ALL\n".join(
    f"SELECT {i + 1} AS ord, '{name}' AS metric, round(CAST({expr} AS DOUBLE), 6) AS value FROM posts"
    for i, (name, expr) in enumerate(_METRICS))

ORACLE_SQL = {
    "post_profile": _PROFILE_SQL,
    "post_country_counts": f"""
        WITH {_POSTS_CTE}
        SELECT country_name, count(*) AS n FROM posts GROUP BY country_name ORDER BY n DESC, country_name""",
    "post_centroids": f"""
        WITH {_POSTS_CTE}
        SELECT country_name, round(avg(latitude), 6) AS latitude, round(avg(longitude), 6) AS longitude
        FROM posts GROUP BY country_name HAVING count(*) >= 11""",
    "post_peak_hour": f"""
        WITH {_POSTS_CTE},
        h AS (SELECT country_name,
                     CAST(floor(((utc_time + CAST(timezone_offset AS BIGINT) * 1000) % 86400000 + 86400000)
                                % 86400000 / 3600000) AS BIGINT) AS hour FROM posts),
        c AS (SELECT country_name, hour, count(*) AS n FROM h GROUP BY country_name, hour)
        SELECT country_name, hour, n FROM (
            SELECT *, row_number() OVER (PARTITION BY country_name ORDER BY n DESC, hour ASC) AS rn FROM c)
        WHERE rn = 1""",
    "post_place_counts": f"""
        WITH {_POSTS_CTE}
        SELECT place_name, count(*) AS n FROM posts
        WHERE country_code = '{POST_CODE}' AND place_type = '{POST_PLACE_TYPE}' GROUP BY place_name""",
    "post_top_words": f"""
        WITH {_POSTS_CTE}, {_TOKENS_CTE}
        SELECT word, count(*) AS n FROM tw WHERE country_code = '{POST_CODE}' AND word NOT IN ({_STOP_SQL})
        GROUP BY word ORDER BY n DESC, word ASC LIMIT 10""",
    "post_top_place_words": f"""
        WITH {_POSTS_CTE}, {_TOKENS_CTE},
        top_places AS (SELECT place_name, count(*) AS n FROM posts
                       WHERE country_code = '{POST_CODE}' AND place_type = '{POST_PLACE_TYPE}'
                       GROUP BY place_name ORDER BY n DESC, place_name ASC LIMIT 5),
        wc AS (SELECT place_name, word, count(*) AS n FROM tw
               WHERE place_name IN (SELECT place_name FROM top_places) AND word NOT IN ({_STOP_SQL})
               GROUP BY place_name, word),
        ranked AS (SELECT place_name, row_number() OVER (PARTITION BY place_name ORDER BY n DESC, word ASC) AS rank,
                          word, n FROM wc)
        SELECT place_name, rank, word, n FROM ranked WHERE rank <= 10""",
    "post_sql_profile": f"""
        WITH {_POSTS_CTE}
        SELECT count(*) AS number_of_tweets, count(DISTINCT username) AS distinct_users,
               count(DISTINCT country_name) AS distinct_countries, count(DISTINCT place_name) AS distinct_places,
               count(DISTINCT language) AS distinct_languages, min(latitude) + 0.0 AS minimum_latitude,
               min(longitude) + 0.0 AS minimum_longitude, max(latitude) + 0.0 AS maximum_latitude,
               max(longitude) + 0.0 AS maximum_longitude FROM posts""",
    "post_classify": f"""
        WITH {_POSTS_CTE},
        q AS (SELECT DISTINCT event_type AS query_id, lower(event_type) AS word FROM events),
        pw AS (SELECT place_name, string_split(lower(tweet_text), ' ') AS ws FROM posts),
        nc AS (SELECT place_name, count(*) AS n_c FROM posts GROUP BY place_name),
        d AS (SELECT q.query_id, pw.place_name, count(*) AS d FROM q JOIN pw ON list_contains(pw.ws, q.word)
              GROUP BY q.query_id, pw.place_name),
        s AS (SELECT d.query_id, d.place_name,
                     (nc.n_c / (SELECT count(*) FROM posts)) * d.d / nc.n_c AS p
              FROM d JOIN nc ON d.place_name = nc.place_name)
        SELECT query_id, place_name, p FROM s
        WHERE p > 0 AND p = (SELECT max(p) FROM s s2 WHERE s2.query_id = s.query_id)""",
}
