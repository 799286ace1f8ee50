"""The reference's analyses on the 13-field post table, as DataFrame plans.

``task1`` .. ``task8`` and ``classify`` return DataFrames; ``run_phase1`` and
``run_classifier`` write them in the reference's output layout (one
tab-separated line per record, one part file per result).  Defects of the
reference are not reproduced (see README): counts are exact whatever the
partitioning, Task 7 removes stop words, Task 8 takes extremes of numbers and
counts languages, local hours are computed in UTC.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoscribe import sinks
from geoscribe.functions.text import python_float_text
from geoscribe.functions.time import local_hour_from_epoch_ms
from geoscribe.operators import bayes, groups, profile, ranking, words
from geoscribe.session import materialize
from geoscribe.sources import scan_delimited, scan_query_lines, scan_with_rejects, scan_word_list

# Parameters of the reference's tasks.
MIN_POSTS_FOR_CENTROID = 11       # countries with fewer than 11 posts have no centroid
TOP_CITIES = 5
TOP_WORDS = 10
MIN_WORD_LENGTH = 2
COUNTRY_CODE = "US"
PLACE_TYPE = "city"


def _in_country(posts: DataFrame, code: str) -> DataFrame:
    return posts.where(F.col("country_code") == code)


def _cities(code: str, place_type: str):
    return (F.col("country_code") == code) & (F.col("place_type") == place_type)


def task1_profile(posts: DataFrame) -> DataFrame:
    """Eleven metrics ``(ord, metric, value)``."""
    return profile.post_profile(posts)


def task2_country_counts(posts: DataFrame) -> DataFrame:
    return groups.group_count_sorted(posts, "country_name")


def task3_country_centroids(posts: DataFrame, min_n: int = MIN_POSTS_FOR_CENTROID) -> DataFrame:
    return groups.group_centroid(posts, "country_name", "latitude", "longitude", min_n,
                                 lat_out="latitude", lon_out="longitude")


def task4_peak_hour(posts: DataFrame) -> DataFrame:
    hour = local_hour_from_epoch_ms("utc_time", "timezone_offset")
    # A line without a time or an offset has no local hour and votes for none.
    return groups.peak_hour(posts.where(hour.isNotNull()), "country_name", hour, hour_out="hour")


def task5_us_city_counts(posts: DataFrame, code: str = COUNTRY_CODE, place_type: str = PLACE_TYPE) -> DataFrame:
    return groups.filtered_group_count(posts, "place_name", _cities(code, place_type))


def task6_top_us_words(posts: DataFrame, stop, k: int = TOP_WORDS, code: str = COUNTRY_CODE) -> DataFrame:
    toks = words.token_table(_in_country(posts, code), "tweet_text", min_len=MIN_WORD_LENGTH)
    return words.top_words(words.remove_stopwords(toks, stop), k)


def task7_top_words_of_top_cities(posts: DataFrame, stop, k_cities: int = TOP_CITIES,
                                  k_words: int = TOP_WORDS, wide: bool = True,
                                  code: str = COUNTRY_CODE, place_type: str = PLACE_TYPE) -> DataFrame:
    """Top words in each of the five busiest US cities.

    As in the reference, the five cities come from US posts of place type
    'city', but the texts are all posts carrying those place names.
    """
    cities = ranking.top_keys(posts.where(_cities(code, place_type)), "place_name", k_cities)
    city_posts = ranking.semi_join_keys(posts, cities, "place_name")
    toks = words.token_table(city_posts, "tweet_text", keep=["place_name"], min_len=MIN_WORD_LENGTH)
    counts = words.word_counts(words.remove_stopwords(toks, stop), ["place_name"])
    ranked = ranking.top_n_per_group(counts, "place_name", "word", k_words)
    return ranking.wide_rows(ranked, "place_name", "word") if wide else ranked


def task8_sql_profile(spark: SparkSession, posts: DataFrame) -> DataFrame:
    return profile.sql_profile(spark, posts, profile.aggregate_statement(profile.POST_SQL_METRICS))


def classify(posts: DataFrame, queries: DataFrame) -> DataFrame:
    """Most probable place(s) per query: ``(query_id, place_name, p)``."""
    return bayes.estimate_places(posts.select("place_name", "tweet_text"), queries,
                                 "place_name", "tweet_text", query_keys=["query_id"])


def run_phase1(spark: SparkSession, posts_path: str, stop_words_path: str, out_dir: str,
               stage_as_parquet: bool = True) -> dict[str, str]:
    """Run Tasks 1-8 and write each result under ``out_dir`` (reference layout).

    The text input is split and typed once and staged as parquet under the
    shared checkpoint directory; every task then reads only its own columns
    (pruning, pushed filters) instead of re-parsing the whole text file.
    Lines that are not whole records still count where their fields are there;
    ``rejects.tsv`` says how many there are by reason, counted in the staging pass' output.
    """
    posts = scan_with_rejects(spark, posts_path)
    if stage_as_parquet:
        posts = materialize(posts, "posts")
    rejects = posts.where(F.col("_reject").isNotNull())
    posts = posts.drop("_reject", "_line")
    stop = scan_word_list(spark, stop_words_path)
    out = out_dir.rstrip("/")
    paths = {}
    # One line per reason: at most one per numeric field, and short lines.
    sinks.write_tsv(groups.count_by_key(rejects, "_reject"), f"{out}/rejects.tsv", ["_reject", "n"],
                    order_by=groups.rank_order("_reject"), single_file=True)
    # Countries and cities are free text, an open-ended dimension: their ordered parts
    # are written in parallel (part files in name order concatenate to the sorted list).
    paths["result_1"] = sinks.write_metric_lines(_post_profile_lines(posts), f"{out}/result_1.tsv")
    paths["result_2"] = sinks.write_tsv(task2_country_counts(posts), f"{out}/result_2.tsv", ["country_name", "n"],
                                        order_by=groups.rank_order("country_name"), single_file=False)
    paths["result_3"] = sinks.write_tsv(task3_country_centroids(posts), f"{out}/result_3.tsv",
                                        ["country_name", "latitude", "longitude"], order_by=[F.col("country_name")],
                                        single_file=False)
    sinks.write_csv(task3_country_centroids(posts).select(
        F.col("country_name").alias("Country"), F.col("latitude").alias("Lat"), F.col("longitude").alias("Lon")),
        f"{out}/result_3_map.csv", order_by=[F.col("Country")], single_file=False)
    paths["result_4"] = sinks.write_tsv(task4_peak_hour(posts), f"{out}/result_4.tsv", ["country_name", "hour", "n"],
                                        order_by=[F.col("country_name")], single_file=False)
    paths["result_5"] = sinks.write_tsv(task5_us_city_counts(posts), f"{out}/result_5.tsv", ["place_name", "n"],
                                        order_by=groups.rank_order("place_name"), single_file=False)
    paths["result_6"] = sinks.write_tsv(task6_top_us_words(posts, stop), f"{out}/result_6.tsv", ["word", "n"],
                                        order_by=groups.rank_order("word"), single_file=True)
    paths["result_7"] = sinks.write_tsv(task7_top_words_of_top_cities(posts, stop), f"{out}/result_7.tsv",
                                        ["place_name", "top_words"], order_by=[F.col("place_name")], single_file=True)
    sql = task8_sql_profile(spark, posts)
    paths["result_8"] = sinks.write_tsv(sql, f"{out}/result_8.tsv", sql.columns, single_file=True)
    return paths


def _post_profile_lines(posts: DataFrame) -> DataFrame:
    """Task 1 as ``(ord, value)`` text: counts print as integers, the rest as doubles."""
    long = task1_profile(posts)
    as_text = F.when(F.col("ord") <= 5, F.col("value").cast("bigint").cast("string")).otherwise(
        python_float_text("value"))
    return long.select("ord", as_text.alias("value"))


def run_classifier(spark: SparkSession, training_path: str, input_path: str, output_path: str,
                   all_lines: bool = False) -> str:
    """``classify <training> <input> <output>``: the first line of ``input`` is the query.

    With ``all_lines`` every line is one, and the output names the line's id
    before each place, in parallel parts.
    """
    posts = scan_delimited(spark, training_path)
    queries = scan_query_lines(spark, input_path, first_line_only=not all_lines)
    best = classify(posts, queries)
    if all_lines:
        return sinks.write_tsv(best, output_path, ["query_id", "place_name", "p"],
                               order_by=[F.col("query_id"), F.col("place_name")], single_file=False)
    return sinks.write_tsv(best, output_path, ["place_name", "p"], order_by=[F.col("place_name")], single_file=True)
