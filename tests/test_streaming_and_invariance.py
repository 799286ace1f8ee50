"""Streaming forms equal the batch operators; results do not depend on partitioning."""

from __future__ import annotations

import fixtures
import pytest
from pyspark.sql import functions as F

from geoscribe.operators import bayes, groups
from geoscribe.plans import tasks
from geoscribe.streaming import read_post_stream, running_group_counts, running_word_counts, start_to_table


def test_stream_counts_equal_batch_and_resume(spark, tmp_path, recs):
    folder = tmp_path / "incoming"
    folder.mkdir()
    lines = fixtures.post_lines()
    half = len(lines) // 2
    (folder / "part1.tsv").write_text("\n".join(lines[:half]) + "\n", encoding="utf-8")
    ckpt = str(tmp_path / "ckpt")

    q = start_to_table(running_group_counts(read_post_stream(spark, str(folder)), "country_name"),
                       "country_counts_t", checkpoint=ckpt)
    q.awaitTermination()
    first = {r.country_name: r.n for r in spark.table("country_counts_t").collect()}
    assert first == dict(fixtures.ranked_counts(r["country_name"] for r in fixtures.parse(lines[:half])))

    # A new file arrives; the restarted query reads only it and updates the totals.
    (folder / "part2.tsv").write_text("\n".join(lines[half:]) + "\n", encoding="utf-8")
    q = start_to_table(running_group_counts(read_post_stream(spark, str(folder)), "country_name"),
                       "country_counts_t2", checkpoint=ckpt)
    q.awaitTermination()
    total = {r.country_name: r.n for r in spark.table("country_counts_t2").collect()}
    assert total == dict(fixtures.model_country_counts(recs))


def test_stream_word_counts(spark, tmp_path, recs):
    folder = tmp_path / "words"
    folder.mkdir()
    (folder / "a.tsv").write_text("\n".join(fixtures.post_lines()) + "\n", encoding="utf-8")
    us = read_post_stream(spark, str(folder)).where(F.col("country_code") == "US")
    q = start_to_table(running_word_counts(us, "tweet_text", fixtures.STOP_WORDS), "us_words_t")
    q.awaitTermination()
    got = sorted(((r.word, r.n) for r in spark.table("us_words_t").collect()), key=lambda kv: (-kv[1], kv[0]))[:10]
    assert got == fixtures.model_top_us_words(recs, set(fixtures.STOP_WORDS))


def _collect(df, order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


@pytest.mark.parametrize("parts", [1, 2, 8])
def test_partition_invariance(spark, posts, parts):
    p = posts.repartition(parts)
    base = posts.coalesce(1)
    checks = [
        (lambda d: tasks.task2_country_counts(d), ["country_name"]),
        (lambda d: tasks.task3_country_centroids(d), ["country_name"]),
        (lambda d: tasks.task4_peak_hour(d), ["country_name"]),
        (lambda d: tasks.task5_us_city_counts(d), ["place_name"]),
        (lambda d: tasks.task6_top_us_words(d, fixtures.STOP_WORDS), ["word"]),
        (lambda d: tasks.task7_top_words_of_top_cities(d, fixtures.STOP_WORDS), ["place_name"]),
        (lambda d: bayes.score_words(d, "place_name", "tweet_text", ["love", "the"]), ["place_name"]),
        (lambda d: groups.small_groups(d, "country_name", 10), ["country_name"]),
    ]
    for fn, order in checks:
        a, b = _collect(fn(p), order), _collect(fn(base), order)
        assert len(a) == len(b)
        for ra, rb in zip(a, b):
            for x, y in zip(ra, rb):
                assert x == y or (isinstance(x, float) and abs(x - y) <= 1e-9 * max(1.0, abs(y)))
