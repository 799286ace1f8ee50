"""The query catalogue on the driver tables, with an independent SQL oracle.

Each entry maps one operator family of the reference onto the generic driver
tables (stand-ins: text -> ``documents.text``, place/class ->
``documents.source``, language -> ``documents.lang``, country ->
``nation.n_name``, user -> ``events.user_id``, time -> ``events.ts``, offset ->
``(n_nationkey - 12) * 3600`` s, latitude/longitude -> ``events.value`` and
``props.k``).  Every query reads whole tables.  Column names and types are the
same on the Spark side and in the DuckDB SQL; averages are rounded to 6
places on both sides; probabilities are compared unrounded because the fold
order is the same.  The reference's own tasks, run on a post table derived
from the same tables, are added from ``plans.posts`` (the ``post_*`` keys).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoscribe import sinks
from geoscribe.functions.text import PY_WHITESPACE, lines, query_word_list
from geoscribe.functions.time import second_of_day
from geoscribe.operators import bayes, groups, hours, index, joins, profile, ranking, sample, words
from geoscribe.plans import files as file_queries
from geoscribe.plans import posts as post_queries
from geoscribe.session import materialize, scratch_path
from geoscribe.sources import scan_delimited, scan_word_list, table
from geoscribe.sources.tables import spread

# Fixed values used by the catalogue (parameters of the registered queries).
STOP = words.STOP_WORDS                     # stop words removed from token counts
SMALL_MAX = 60                              # users with at most 60 events are "small"
TOP_K_KEYS = 5                              # top sources within lang = 'en'
TOP_K_WORDS = 10                            # words per report
TOP_MAP_KEYS = 3                            # entries of a bounded map
NB_WORDS = ["the", "and", "de"]             # the literal classifier query
SAMPLE_FRACTION, SAMPLE_SEED = 0.1, 5       # the reference's sample parameters

QueryFn = Callable[[SparkSession, str], DataFrame]


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return table(spark, d, name)


def _docs(spark: SparkSession, d: str) -> DataFrame:
    """``documents`` spread over the cluster before texts are split (see ``spread``)."""
    return spread(table(spark, d, "documents"), ["doc_id"])


def _props_k():
    """``props.k`` of an event as a double (the longitude stand-in)."""
    return F.get_json_object("props", "$.k").try_cast(T.DoubleType())


# ---------------------------------------------------------------- profile family

def count_rows(spark, d):
    return _t(spark, d, "events").agg(F.count(F.lit(1)).alias("n_rows"))


def distinct_counts(spark, d):
    docs, ev = _t(spark, d, "documents"), _t(spark, d, "events")
    return spark.range(1).select(*[profile.distinct_count(df, c).alias(name) for df, c, name in (
        (ev, "user_id", "n_users"), (ev, "event_type", "n_event_types"), (docs, "lang", "n_langs"), (docs, "source", "n_sources"))])


def distinct_values(spark, d):
    return _t(spark, d, "documents").select("lang").distinct()


def min_max(spark, d):
    # "+ 0.0": the sign of a zero extreme is normalised (see profile._extreme).
    return _t(spark, d, "events").agg((F.min("value") + 0.0).alias("min_value"),
                                      (F.max("value") + 0.0).alias("max_value"))


def total_length(spark, d):
    return _t(spark, d, "documents").agg(F.sum(F.length("text")).cast("bigint").alias("total_length"))


def avg_text_length(spark, d):
    wide = profile.profile_wide(_t(spark, d, "documents"), text="text")
    return wide.select(F.round("avg_chars", 6).alias("avg_chars"), F.round("avg_words", 6).alias("avg_words"))


def dataset_profile(spark, d):
    long = profile.dataset_profile(_t(spark, d, "documents"), text="text",
                                   distinct_cols=["source", "lang"], minmax_cols=["n_chars"])
    return long.withColumn("value", F.round("value", 6))


def sql_profile(spark, d):
    template = """
        SELECT count(*)               AS n_rows,
               count(DISTINCT source) AS n_sources,
               count(DISTINCT lang)   AS n_langs,
               min(n_chars)           AS min_chars,
               max(n_chars)           AS max_chars
        FROM {view}
    """
    return profile.sql_profile(spark, _t(spark, d, "documents"), template)


def sample_native(spark, d):
    """The reference's seeded draw, by file and row position."""
    return sample.sample_rows(_t(spark, d, "documents"), SAMPLE_FRACTION, SAMPLE_SEED).select("doc_id", "source", "lang")


def sample_hash(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", "source", "lang")
    return sample.sample_hash(docs, "doc_id", SAMPLE_FRACTION)


def sampled_profile(spark, d):
    """The profile of a reproducible 10 % sample (the reference's draft Task 1)."""
    sampled = sample.sample_hash(_t(spark, d, "documents"), "doc_id", SAMPLE_FRACTION)
    long = profile.dataset_profile(sampled, text="text", distinct_cols=["source", "lang"], minmax_cols=["n_chars"])
    return long.withColumn("value", F.round("value", 6))


# ------------------------------------------------------------------ group family

def group_count_sorted(spark, d):
    """Customers per nation name, ranked.  Customers are counted per nation key
    first (partial aggregation), so only <= 25 rows per task meet the join."""
    per_key = groups.count_by_key(_t(spark, d, "customer"), "c_nationkey")
    nation = _t(spark, d, "nation").select("n_nationkey", "n_name")
    named = per_key.join(nation, per_key.c_nationkey == nation.n_nationkey)
    ranked = named.groupBy("n_name").agg(F.sum("n").cast("bigint").alias("n"))
    return ranked.orderBy(*groups.rank_order("n_name"))


def small_groups(spark, d):
    return groups.small_groups(_t(spark, d, "events"), "user_id", SMALL_MAX)


def large_groups_anti(spark, d):
    """Rows per user after removing small users by key (anti join).  Counting
    first and removing keys from the per-user counts gives the same result as
    removing raw rows, but only aggregates reach the shuffle and the join.  The
    counts are written once, as both sides of the anti join read them."""
    counts = materialize(groups.count_by_key(_t(spark, d, "events"), "user_id"), "user_counts")
    return groups.without_keys(counts, counts.where(F.col("n") <= SMALL_MAX), "user_id")


def _round_centroid(df: DataFrame) -> DataFrame:
    return df.select("user_id", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"))


def group_centroid(spark, d):
    ev = _t(spark, d, "events")
    c = groups.group_centroid(ev, "user_id", "value", _props_k(), min_n=SMALL_MAX + 1)
    return _round_centroid(c)


def key_join_aggregates(spark, d):
    ev = _t(spark, d, "events")
    c = groups.centroid_by_join(ev, "user_id", "value", _props_k(), max_small=SMALL_MAX)
    return _round_centroid(c)


def centroid_csv(spark, d):
    path = scratch_path(spark, "centroid_csv")
    # One centroid per user is not bounded: write in parallel parts, each with a header.
    sinks.write_csv(group_centroid(spark, d), path, header=True, single_file=False)
    schema = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("lat", T.DoubleType()),
                           T.StructField("lon", T.DoubleType())])
    return spark.read.option("header", True).schema(schema).csv(path)


def events_without_keys(spark, d):
    """Events of users who are no customer with an urgent order: raw rows against a key set from
    another table, taken as past the broadcast bound (so through the Bloom filter)."""
    urgent = _t(spark, d, "orders").where(F.col("o_orderpriority") == "1-URGENT").select("o_custkey")
    ev = _t(spark, d, "events").select("event_id", "user_id")
    return joins.bloom_anti_join(ev, urgent, "user_id")


def key_join_tables(spark, d):
    """Order and event aggregates of each customer with both, joined 1:1."""
    spent = _t(spark, d, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"), F.round(F.avg("o_totalprice"), 6).alias("avg_price"))
    seen = _t(spark, d, "events").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_events"), F.round(F.avg("value"), 6).alias("avg_value"))
    return groups.join_aggregates(spent, seen, "o_custkey", "user_id")


def global_index(spark, d):
    """Position of every user in the order of event counts."""
    counts = groups.count_by_key(_t(spark, d, "events"), "user_id")
    return index.global_index(counts, groups.rank_order("user_id"))


def _hour_counts(spark, d, max_rows: int | None = None) -> DataFrame:
    """``(n_name, hour, n)``: events per nation and local hour, as histograms (``operators.hours``)."""
    cust = _t(spark, d, "customer").select("c_custkey", "c_nationkey")
    nation = _t(spark, d, "nation").select("n_nationkey", "n_name", ((F.col("n_nationkey") - 12) * 3600).alias("offset_s"))
    who = cust.join(nation, cust.c_nationkey == nation.n_nationkey)
    # The offsets are the nations', so their divisor is taken from that table.
    return hours.hour_histogram(_t(spark, d, "events"), "user_id", second_of_day("ts"), who, "c_custkey", "n_name", "offset_s",
                                max_rows=max_rows, slot=hours.slot_seconds(nation, "offset_s"))


def local_hour(spark, d):
    per = _hour_counts(spark, d)
    return per.groupBy(F.col("hour").alias("local_hour")).agg(F.sum("n").cast("bigint").alias("n"))


def peak_hour(spark, d):
    return groups.peak_of_counts(_hour_counts(spark, d), "n_name", "hour")


def peak_hour_hot_keys(spark, d):
    """The peak hour with the customers taken as past the broadcast bound: hot users apart."""
    return groups.peak_of_counts(_hour_counts(spark, d, max_rows=0), "n_name", "hour")


def filtered_group_count(spark, d):
    orders = _t(spark, d, "orders")
    cond = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "5-LOW")
    return groups.filtered_group_count(orders, "o_custkey", cond)


# ------------------------------------------------------------------- text family

def _top_sources(spark, d) -> DataFrame:
    en = _t(spark, d, "documents").where(F.col("lang") == "en")
    return ranking.top_keys(en, "source", TOP_K_KEYS)


def top_keys(spark, d):
    return _top_sources(spark, d)


def semi_join_top_keys(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", "source")
    return ranking.semi_join_keys(docs, _top_sources(spark, d), "source")


def tokens(spark, d):
    toks = words.token_table(_docs(spark, d), "text", keep=["lang"])
    return words.token_stats(toks, ["lang"])


def stopword_anti(spark, d):
    """Stop words given as a one-column table: an anti join on the word (the
    optimizer broadcasts the small side by its size estimate)."""
    toks = words.token_table(_docs(spark, d), "text", keep=["lang"])
    stop = spark.createDataFrame([(w,) for w in STOP], "word string")
    return groups.count_by_key(words.remove_stopwords(toks, stop), "lang", "n_tokens")


def stopword_anti_bloom(spark, d):
    """The same with the list taken as past the broadcast bound: a Bloom filter in the scan stage."""
    toks = words.token_table(_docs(spark, d), "text", keep=["lang"])
    stop = spark.createDataFrame([(w,) for w in STOP], "word string")
    return groups.count_by_key(joins.bloom_anti_join(toks, stop, "word"), "lang", "n_tokens")


def word_freq_topk(spark, d):
    en = _docs(spark, d).where(F.col("lang") == "en")
    toks = words.remove_stopwords(words.token_table(en, "text"), STOP)
    return words.top_words(toks, TOP_K_WORDS)


def _top_source_word_counts(spark, d) -> DataFrame:
    docs = ranking.semi_join_keys(_docs(spark, d), _top_sources(spark, d), "source")
    toks = words.remove_stopwords(words.token_table(docs, "text", keep=["source"]), STOP)
    return words.word_counts(toks, ["source"])


def group_word_counts(spark, d):
    return _top_source_word_counts(spark, d)


def top_words_per_top_key(spark, d):
    ranked = ranking.top_n_per_group(_top_source_word_counts(spark, d), "source", "word", TOP_K_WORDS)
    return ranked.select("source", F.col("rank").cast("bigint").alias("rank"), "word", "n")


def top_words_wide(spark, d):
    ranked = ranking.top_n_per_group(_top_source_word_counts(spark, d), "source", "word", TOP_K_WORDS)
    return ranking.wide_rows(ranked, "source", "word")


def counts_as_map(spark, d):
    m = ranking.counts_as_map(_t(spark, d, "documents"), "lang", "source")
    return m.select("lang", ranking.map_as_text(F.col("counts")).alias("counts"))


def counts_table(spark, d):
    return ranking.counts_table(_t(spark, d, "documents"), "lang", "source")


def top_counts_map(spark, d):
    m = ranking.top_counts_map(_t(spark, d, "documents"), "lang", "source", TOP_MAP_KEYS)
    return m.select("lang", ranking.map_as_text(F.col("counts")).alias("counts"))


# -------------------------------------------------------------- classifier family

def _benchmark_queries(spark, d) -> DataFrame:
    """One query per line of every benchmark item (whole texts, every line)."""
    b = _t(spark, d, "benchmark")
    per_line = b.select("item_id", F.posexplode(lines("text")).alias("line_no", "line"))
    return per_line.select("item_id", F.col("line_no").cast("bigint").alias("line_no"),
                           query_word_list("line").alias("words"))


def query_words(spark, d):
    q = _benchmark_queries(spark, d)
    return q.select("item_id", "line_no", F.size("words").cast("bigint").alias("n_words"),
                    F.array_join("words", " ").alias("words"))


def nb_priors(spark, d):
    return bayes.priors(_t(spark, d, "documents"), "source")


def nb_word_presence(spark, d):
    pres = bayes.word_presence(_docs(spark, d), "source", "text", NB_WORDS)
    return pres.select("source", F.col("pos").cast("bigint").alias("pos"), "word", "d")


def nb_scores(spark, d):
    """Scores of every class, best first."""
    scores = bayes.score_words(_docs(spark, d), "source", "text", NB_WORDS)
    return scores.orderBy(F.col("p").desc(), "source").select("source", "n", "p")


def nb_argmax_ties(spark, d):
    scores = bayes.score_words(_docs(spark, d), "source", "text", NB_WORDS)
    return bayes.best_classes(scores, "scaled").select("source", "p")


def nb_batch(spark, d):
    docs = _docs(spark, d).select("source", "text")
    return bayes.estimate_places(docs, _benchmark_queries(spark, d), "source", "text",
                                 query_keys=["item_id", "line_no"])


# ------------------------------------------------------------ sources and sinks

_DOC_TSV = [("doc_id", T.LongType()), ("lang", T.StringType()), ("source", T.StringType()),
            ("n_chars", T.LongType()), ("text", T.StringType())]


def scan_delimited_roundtrip(spark, d):
    docs = _t(spark, d, "documents")
    flat = docs.select("doc_id", "lang", "source", "n_chars",
                       F.regexp_replace("text", "[\t\r\n]", " ").alias("text"))
    path = scratch_path(spark, "documents_tsv")
    sinks.write_tsv(flat, path, [c for c, _ in _DOC_TSV], single_file=False)
    back = scan_delimited(spark, path, _DOC_TSV)
    return back.select("doc_id", "lang", "source", "n_chars", F.length("text").cast("bigint").alias("text_len"))


def scan_word_list_roundtrip(spark, d):
    vocab = _benchmark_queries(spark, d).select(F.explode("words").alias("word")).distinct()
    path = scratch_path(spark, "word_list")
    vocab.write.mode("overwrite").text(path)
    return scan_word_list(spark, path).distinct()


def sink_tsv(spark, d):
    path = scratch_path(spark, "group_count_tsv")
    ranked = group_count_sorted(spark, d)
    sinks.write_tsv(ranked, path, ["n_name", "n"], order_by=groups.rank_order("n_name"))
    parts = F.split(F.col("value"), "\t", -1)
    return spark.read.text(path).select(F.get(parts, 0).alias("n_name"), F.get(parts, 1).cast("bigint").alias("n"))


def sink_tsv_double(spark, d):
    """Centroids written as range-sorted TSV parts, with doubles as text, and read back."""
    path = scratch_path(spark, "centroid_tsv")
    schema = [("user_id", T.LongType()), ("lat", T.DoubleType()), ("lon", T.DoubleType())]
    sinks.write_tsv(group_centroid(spark, d), path, [c for c, _ in schema], order_by=[F.col("user_id")], single_file=False)
    return scan_delimited(spark, path, schema)


QUERIES: dict[str, QueryFn] = {
    "count_rows": count_rows,
    "distinct_counts": distinct_counts,
    "distinct_values": distinct_values,
    "min_max": min_max,
    "total_length": total_length,
    "avg_text_length": avg_text_length,
    "dataset_profile": dataset_profile,
    "sql_profile": sql_profile,
    "sample_native": sample_native,
    "sample_hash": sample_hash,
    "sampled_profile": sampled_profile,
    "group_count_sorted": group_count_sorted,
    "small_groups": small_groups,
    "large_groups_anti": large_groups_anti,
    "events_without_keys": events_without_keys,
    "key_join_tables": key_join_tables,
    "global_index": global_index,
    "group_centroid": group_centroid,
    "key_join_aggregates": key_join_aggregates,
    "centroid_csv": centroid_csv,
    "local_hour": local_hour,
    "peak_hour": peak_hour,
    "peak_hour_hot_keys": peak_hour_hot_keys,
    "filtered_group_count": filtered_group_count,
    "top_keys": top_keys,
    "semi_join_top_keys": semi_join_top_keys,
    "tokens": tokens,
    "stopword_anti": stopword_anti,
    "stopword_anti_bloom": stopword_anti_bloom,
    "word_freq_topk": word_freq_topk,
    "group_word_counts": group_word_counts,
    "top_words_per_top_key": top_words_per_top_key,
    "top_words_wide": top_words_wide,
    "counts_as_map": counts_as_map,
    "counts_table": counts_table,
    "top_counts_map": top_counts_map,
    "query_words": query_words,
    "nb_priors": nb_priors,
    "nb_word_presence": nb_word_presence,
    "nb_scores": nb_scores,
    "nb_argmax_ties": nb_argmax_ties,
    "nb_batch": nb_batch,
    "scan_delimited": scan_delimited_roundtrip,
    "scan_word_list": scan_word_list_roundtrip,
    "sink_tsv": sink_tsv,
    "sink_tsv_double": sink_tsv_double,
}


# ------------------------------------------------------------------- oracle SQL

def _sql_str_list(items) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in items)


_STOP_SQL = _sql_str_list(STOP)
_WS_SQL = " || ".join(f"chr({ord(c)})" for c in PY_WHITESPACE)

_TOKENS_CTE = """
    tok AS (SELECT lang, source, unnest(string_split(text, ' ')) AS t FROM documents),
    tw AS (SELECT lang, source, lower(t) AS word FROM tok WHERE length(t) >= 2)
"""

_TOP_SOURCES_SQL = """
    SELECT source, count(*) AS n FROM documents WHERE lang = 'en'
    GROUP BY source ORDER BY n DESC, source ASC LIMIT 5
"""

_SOURCE_WORDS_CTE = f"""
    top_src AS ({_TOP_SOURCES_SQL}),
    {_TOKENS_CTE.strip()},
    swc AS (SELECT source, word, count(*) AS n FROM tw
            WHERE source IN (SELECT source FROM top_src) AND word NOT IN ({_STOP_SQL})
            GROUP BY source, word),
    ranked AS (SELECT source, row_number() OVER (PARTITION BY source ORDER BY n DESC, word ASC) AS rank, word, n
               FROM swc)
"""

_QUERY_LINES_CTE = f"""
    parts AS (SELECT item_id, regexp_split_to_array(text, '\\r\\n|\\r|\\n') AS p FROM benchmark),
    l0 AS (SELECT item_id, unnest(range(len(p))) AS line_no, unnest(p) AS line, len(p) AS n_parts FROM parts),
    l1 AS (SELECT item_id, line_no, rtrim(line, {_WS_SQL}) AS line FROM l0
           WHERE NOT (line_no = n_parts - 1 AND line = '')),
    w0 AS (SELECT item_id, line_no, string_split(lower(line), ' ') AS ws FROM l1),
    w1 AS (SELECT item_id, line_no, unnest(range(len(ws))) AS pos0, unnest(ws) AS word FROM w0),
    qw AS (SELECT item_id, line_no, word, min(pos0) AS pos FROM w1 GROUP BY item_id, line_no, word)
"""

_CENTROID_SQL = """
    SELECT user_id, round(avg(value), 6) AS lat,
           round(avg(try_cast(json_extract_string(props, '$.k') AS DOUBLE)), 6) AS lon
    FROM events GROUP BY user_id HAVING count(*) > 60
"""

_GROUP_COUNT_SQL = """
    SELECT n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey
    GROUP BY n_name ORDER BY n DESC, n_name ASC
"""

_HOURS_CTE = """
    h AS (SELECT n_name, CAST(hour(ts + to_seconds((n_nationkey - 12) * 3600)) AS BIGINT) AS hour
          FROM events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey)
"""

_NB_COUNTS_CTE = """
    dw AS (SELECT source, string_split(lower(text), ' ') AS ws FROM documents),
    c AS (SELECT source, count(*) AS n,
                 CAST(sum(CASE WHEN list_contains(ws, 'the') THEN 1 ELSE 0 END) AS BIGINT) AS d0,
                 CAST(sum(CASE WHEN list_contains(ws, 'and') THEN 1 ELSE 0 END) AS BIGINT) AS d1,
                 CAST(sum(CASE WHEN list_contains(ws, 'de') THEN 1 ELSE 0 END) AS BIGINT) AS d2
          FROM dw GROUP BY source),
    s AS (SELECT source, n, ((((((n / (SELECT count(*) FROM documents)) * d0) / n) * d1) / n) * d2) / n AS p FROM c)
"""

_SAMPLE_SQL = """
    SELECT * FROM documents
    WHERE CAST(concat('0x', substr(md5(CAST(doc_id AS VARCHAR)), 1, 15)) AS BIGINT) < 115292150460684704"""

_ROW_SAMPLE_SQL = """
    SELECT doc_id, source, lang FROM (SELECT doc_id, source, lang, row_number() OVER () - 1 AS pos FROM documents)
    WHERE CAST(concat('0x', substr(md5('5:documents.parquet:' || CAST(pos AS VARCHAR)), 1, 15)) AS BIGINT)
          < 115292150460684704"""

_PEAK_SQL = """
        c AS (SELECT n_name, hour, count(*) AS n FROM h GROUP BY n_name, hour)
        SELECT n_name, hour, n FROM (
            SELECT *, row_number() OVER (PARTITION BY n_name ORDER BY n DESC, hour ASC) AS rn FROM c)
        WHERE rn = 1"""

_PROFILE_SQL = """
    WITH a AS (SELECT count(*) AS n_rows, count(DISTINCT source) AS ds, count(DISTINCT lang) AS dl,
                      min(n_chars) AS mn, max(n_chars) AS mx, avg(length(text)) AS ac,
                      avg(len(string_split(text, ' '))) AS aw FROM {src})
    SELECT 1 AS ord, 'n_rows' AS metric, round(CAST(n_rows AS DOUBLE), 6) AS value FROM a
    UNION ALL SELECT 2, 'n_distinct_source', round(CAST(ds AS DOUBLE), 6) FROM a
    UNION ALL SELECT 3, 'n_distinct_lang', round(CAST(dl AS DOUBLE), 6) FROM a
    UNION ALL SELECT 4, 'min_n_chars', round(CAST(mn AS DOUBLE), 6) FROM a
    UNION ALL SELECT 5, 'max_n_chars', round(CAST(mx AS DOUBLE), 6) FROM a
    UNION ALL SELECT 6, 'avg_chars', round(ac, 6) FROM a
    UNION ALL SELECT 7, 'avg_words', round(aw, 6) FROM a"""

ORACLE_SQL: dict[str, str] = {
    "count_rows": "SELECT count(*) AS n_rows FROM events",
    "distinct_counts": """
        SELECT (SELECT count(DISTINCT user_id) FROM events) AS n_users,
               (SELECT count(DISTINCT event_type) FROM events) AS n_event_types,
               (SELECT count(DISTINCT lang) FROM documents) AS n_langs,
               (SELECT count(DISTINCT source) FROM documents) AS n_sources""",
    "distinct_values": "SELECT DISTINCT lang FROM documents",
    "min_max": "SELECT min(value) + 0.0 AS min_value, max(value) + 0.0 AS max_value FROM events",
    "total_length": "SELECT CAST(sum(length(text)) AS BIGINT) AS total_length FROM documents",
    "avg_text_length": """
        SELECT round(avg(length(text)), 6) AS avg_chars,
               round(avg(len(string_split(text, ' '))), 6) AS avg_words FROM documents""",
    "dataset_profile": _PROFILE_SQL.format(src="documents"),
    "sampled_profile": _PROFILE_SQL.format(src=f"({_SAMPLE_SQL})"),
    "sql_profile": """
        SELECT count(*) AS n_rows, count(DISTINCT source) AS n_sources, count(DISTINCT lang) AS n_langs,
               min(n_chars) AS min_chars, max(n_chars) AS max_chars FROM documents""",
    "sample_hash": f"SELECT doc_id, source, lang FROM ({_SAMPLE_SQL})",
    # Row positions as the table's one file has them.
    "sample_native": _ROW_SAMPLE_SQL,
    "group_count_sorted": _GROUP_COUNT_SQL,
    "events_without_keys": """
        SELECT event_id, user_id FROM events
        WHERE user_id NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
    "key_join_tables": """
        SELECT o_custkey, n_orders, avg_price, n_events, avg_value
        FROM (SELECT o_custkey, count(*) AS n_orders, round(avg(o_totalprice), 6) AS avg_price FROM orders GROUP BY o_custkey)
        JOIN (SELECT user_id, count(*) AS n_events, round(avg(value), 6) AS avg_value FROM events GROUP BY user_id)
          ON o_custkey = user_id""",
    "global_index": """
        SELECT user_id, n, row_number() OVER (ORDER BY n DESC, user_id) - 1 AS index
        FROM (SELECT user_id, count(*) AS n FROM events GROUP BY user_id)""",
    "small_groups": "SELECT user_id, count(*) AS n FROM events GROUP BY user_id HAVING count(*) <= 60",
    "large_groups_anti": """
        SELECT user_id, count(*) AS n FROM events
        WHERE user_id NOT IN (SELECT user_id FROM events GROUP BY user_id HAVING count(*) <= 60)
        GROUP BY user_id""",
    "group_centroid": _CENTROID_SQL,
    "key_join_aggregates": _CENTROID_SQL,
    "centroid_csv": _CENTROID_SQL,
    "local_hour": f"WITH {_HOURS_CTE} SELECT hour AS local_hour, count(*) AS n FROM h GROUP BY hour",
    "peak_hour": f"""
        WITH {_HOURS_CTE}, {_PEAK_SQL}""",
    "peak_hour_hot_keys": f"""
        WITH {_HOURS_CTE}, {_PEAK_SQL}""",
    "filtered_group_count": """
        SELECT o_custkey, count(*) AS n FROM orders
        WHERE o_orderstatus = 'F' AND o_orderpriority = '5-LOW'
        GROUP BY o_custkey ORDER BY n DESC, o_custkey ASC""",
    "top_keys": _TOP_SOURCES_SQL,
    "semi_join_top_keys": f"""
        SELECT doc_id, source FROM documents
        WHERE source IN (SELECT source FROM ({_TOP_SOURCES_SQL}))""",
    "tokens": f"""
        WITH {_TOKENS_CTE}
        SELECT lang, count(*) AS n_tokens, count(DISTINCT word) AS n_distinct FROM tw GROUP BY lang""",
    "stopword_anti": f"""
        WITH {_TOKENS_CTE}
        SELECT lang, count(*) AS n_tokens FROM tw WHERE word NOT IN ({_STOP_SQL}) GROUP BY lang""",
    "stopword_anti_bloom": f"""
        WITH {_TOKENS_CTE}
        SELECT lang, count(*) AS n_tokens FROM tw WHERE word NOT IN ({_STOP_SQL}) GROUP BY lang""",
    "word_freq_topk": f"""
        WITH {_TOKENS_CTE}
        SELECT word, count(*) AS n FROM tw WHERE lang = 'en' AND word NOT IN ({_STOP_SQL})
        GROUP BY word ORDER BY n DESC, word ASC LIMIT 10""",
    "group_word_counts": f"WITH {_SOURCE_WORDS_CTE} SELECT source, word, n FROM swc",
    "top_words_per_top_key": f"WITH {_SOURCE_WORDS_CTE} SELECT source, rank, word, n FROM ranked WHERE rank <= 10",
    "top_words_wide": f"""
        WITH {_SOURCE_WORDS_CTE}
        SELECT source, string_agg(word || chr(9) || CAST(n AS VARCHAR), chr(9) ORDER BY rank) AS top_words
        FROM ranked WHERE rank <= 10 GROUP BY source""",
    "counts_as_map": """
        SELECT lang, string_agg(source || '=' || CAST(n AS VARCHAR), ',' ORDER BY source) AS counts
        FROM (SELECT lang, source, count(*) AS n FROM documents GROUP BY lang, source) GROUP BY lang""",
    "counts_table": "SELECT lang, source, count(*) AS n FROM documents GROUP BY lang, source",
    "top_counts_map": """
        SELECT lang, string_agg(source || '=' || CAST(n AS VARCHAR), ',' ORDER BY source) AS counts
        FROM (SELECT lang, source, n, row_number() OVER (PARTITION BY lang ORDER BY n DESC, source) AS rn
              FROM (SELECT lang, source, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY lang, source))
        WHERE rn <= 3 GROUP BY lang""",
    "query_file_lines": f"""
        WITH {_QUERY_LINES_CTE},
        wl AS (SELECT item_id, line_no, string_agg(word, ' ' ORDER BY pos) AS words FROM qw GROUP BY item_id, line_no)
        SELECT item_id % 8 AS folder,
               row_number() OVER (PARTITION BY item_id % 8 ORDER BY item_id, line_no) - 1 AS line,
               row_number() OVER (ORDER BY item_id % 8, item_id, line_no) - 1 AS index, words
        FROM wl""",
    "metrics_file": f"SELECT ord, value FROM ({_PROFILE_SQL.format(src='documents')})",
    "query_words": f"""
        WITH {_QUERY_LINES_CTE}
        SELECT item_id, line_no, count(*) AS n_words, string_agg(word, ' ' ORDER BY pos) AS words
        FROM qw GROUP BY item_id, line_no""",
    "nb_priors": """
        SELECT source, count(*) AS n, count(*) / (SELECT count(*) FROM documents) AS prior
        FROM documents GROUP BY source""",
    "nb_word_presence": """
        WITH dw AS (SELECT source, string_split(lower(text), ' ') AS ws FROM documents)
        SELECT source, CAST(w.pos AS BIGINT) AS pos, w.word,
               CAST(sum(CASE WHEN list_contains(ws, w.word) THEN 1 ELSE 0 END) AS BIGINT) AS d
        FROM dw, (VALUES (0, 'the'), (1, 'and'), (2, 'de')) AS w(pos, word)
        GROUP BY source, w.pos, w.word""",
    "nb_scores": f"WITH {_NB_COUNTS_CTE} SELECT source, n, p FROM s ORDER BY p DESC, source",
    "nb_argmax_ties": f"""
        WITH {_NB_COUNTS_CTE}
        SELECT source, p FROM s WHERE p = (SELECT max(p) FROM s) AND p > 0""",
    "nb_batch": f"""
        WITH {_QUERY_LINES_CTE},
        k AS (SELECT item_id, line_no, count(*) AS k FROM qw GROUP BY item_id, line_no),
        vocab AS (SELECT DISTINCT word FROM qw),
        dtok AS (SELECT DISTINCT doc_id, source, unnest(string_split(lower(text), ' ')) AS word FROM documents),
        pres AS (SELECT source, word, count(*) AS d FROM dtok WHERE word IN (SELECT word FROM vocab)
                 GROUP BY source, word),
        nc AS (SELECT source, count(*) AS n_c FROM documents GROUP BY source),
        m AS (SELECT qw.item_id, qw.line_no, pres.source, count(*) AS m,
                     list(pres.d ORDER BY qw.pos) AS ds
              FROM qw JOIN pres ON qw.word = pres.word
              GROUP BY qw.item_id, qw.line_no, pres.source),
        sc AS (SELECT m.item_id, m.line_no, m.source,
                      list_reduce(ds, lambda x, y: x * y / nc.n_c,
                                  nc.n_c / (SELECT count(*) FROM documents)) AS p
               FROM m JOIN k ON m.item_id = k.item_id AND m.line_no = k.line_no AND m.m = k.k
               JOIN nc ON m.source = nc.source)
        SELECT item_id, line_no, source, p FROM sc
        WHERE p > 0 AND p = (SELECT max(p) FROM sc s2 WHERE s2.item_id = sc.item_id AND s2.line_no = sc.line_no)""",
    "scan_delimited": """
        SELECT doc_id, lang, source, n_chars, CAST(length(text) AS BIGINT) AS text_len FROM documents""",
    "scan_word_list": f"WITH {_QUERY_LINES_CTE} SELECT DISTINCT word FROM qw",
    "sink_tsv": _GROUP_COUNT_SQL,
    "sink_tsv_double": _CENTROID_SQL,
}


# The reference's own tasks on the post table derived from the driver tables.
QUERIES.update(post_queries.QUERIES)
ORACLE_SQL.update(post_queries.ORACLE_SQL)
# Queries over written files.
QUERIES.update(file_queries.QUERIES)
ORACLE_SQL.update(file_queries.ORACLE_SQL)
