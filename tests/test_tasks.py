"""The reference's tasks on the hand-made post fixture, against the plain model."""

from __future__ import annotations

import math

import fixtures
import pytest
from pyspark.sql import functions as F

from geoscribe.plans import tasks
from geoscribe.sources import scan_word_list


def close(a, b, tol=1e-9):
    if a is None or b is None:
        return a is b
    return math.isclose(a, b, rel_tol=tol, abs_tol=tol)


@pytest.fixture(scope="module")
def stop(spark, data_dir):
    return scan_word_list(spark, str(data_dir / "stop_words.txt"))


def test_scan_handles_short_and_bad_lines(posts, recs):
    rows = posts.collect()
    assert len(rows) == len(recs)
    short = [r for r in rows if r.country_code == "NO" and r.place_name is None]
    assert len(short) == 1 and short[0].tweet_text is None
    bad = [r for r in rows if r.username == "badlat"]
    assert bad[0].latitude is None and bad[0].longitude == 18.0
    assert any(r.country_name == "" for r in rows)          # blank is a value, not NULL


def test_task1_profile(posts, recs):
    got = [r.value for r in tasks.task1_profile(posts).orderBy("ord").collect()]
    want = fixtures.model_profile(recs)
    assert len(got) == 11
    for g, w in zip(got, want):
        assert close(g, float(w)), (got, want)


def test_task2_country_counts(posts, recs):
    got = [(r.country_name, r.n) for r in tasks.task2_country_counts(posts).collect()]
    assert got == fixtures.model_country_counts(recs)
    assert sum(n for _, n in got) == len(recs)              # golden invariant: sum = total


def test_task3_centroids_threshold(posts, recs):
    got = {r.country_name: (r.latitude, r.longitude) for r in tasks.task3_country_centroids(posts).collect()}
    want = fixtures.model_centroids(recs)
    assert set(got) == set(want)
    assert "Belize" not in got and "Norway" in got          # 10 excluded, 11 kept
    for k in want:
        assert close(got[k][0], want[k][0]) and close(got[k][1], want[k][1])


def test_task4_peak_hour(posts, recs):
    got = {r.country_name: (r.hour, r.n) for r in tasks.task4_peak_hour(posts).collect()}
    want = fixtures.model_peak_hour(recs)
    assert got == want
    assert got["Fiji"] == (2, 2)                            # tie goes to the earlier hour
    # 23:59 UTC + 14 h is 13:59 the next day; 00:01 UTC - 11 h is 13:01 the day before.
    assert got["Kiribati"][0] == 13 and got["Samoa"][0] == 13


def test_task5_us_city_counts(posts, recs):
    got = [(r.place_name, r.n) for r in tasks.task5_us_city_counts(posts).collect()]
    assert got == fixtures.model_us_city_counts(recs)


def test_task6_top_us_words(posts, recs, stop):
    got = [(r.word, r.n) for r in tasks.task6_top_us_words(posts, stop).collect()]
    assert got == fixtures.model_top_us_words(recs, set(fixtures.STOP_WORDS))


def test_task6_literal_stop_list_equals_file(posts, stop):
    a = tasks.task6_top_us_words(posts, stop).collect()
    b = tasks.task6_top_us_words(posts, fixtures.STOP_WORDS).collect()
    assert a == b


def test_task7_top_words_of_top_cities(posts, recs, stop):
    ranked = tasks.task7_top_words_of_top_cities(posts, stop, wide=False)
    got = {}
    for r in ranked.orderBy("place_name", "rank").collect():
        got.setdefault(r.place_name, []).append((r.word, r.n))
    want = fixtures.model_top_words_of_top_cities(recs, set(fixtures.STOP_WORDS))
    assert got == want
    # Portland is a US city and an Australian admin area: all its posts count (D9).
    wide = {r.place_name: r.top_words for r in tasks.task7_top_words_of_top_cities(posts, stop).collect()}
    for city, pairs in want.items():
        assert wide[city] == "\t".join(f"{w}\t{n}" for w, n in pairs)


def test_task8_sql_profile(spark, posts, recs):
    row = tasks.task8_sql_profile(spark, posts).collect()[0]
    m = fixtures.model_profile(recs)
    assert row.number_of_tweets == m[0]
    assert (row.distinct_users, row.distinct_countries, row.distinct_places, row.distinct_languages) == tuple(m[1:5])
    assert (row.minimum_latitude, row.minimum_longitude, row.maximum_latitude, row.maximum_longitude) == tuple(m[5:9])


def test_run_phase1_writes_reference_layout(spark, data_dir, tmp_path, recs):
    out = tmp_path / "results"
    paths = tasks.run_phase1(spark, str(data_dir / "posts.tsv"), str(data_dir / "stop_words.txt"), str(out))
    part = lambda name: sorted((out / name).glob("part-*"))
    assert len(part("result_2.tsv")) == 1
    lines2 = part("result_2.tsv")[0].read_text(encoding="utf-8").splitlines()
    assert lines2 == [f"{k}\t{n}" for k, n in fixtures.model_country_counts(recs)]
    lines1 = part("result_1.tsv")[0].read_text(encoding="utf-8").splitlines()
    assert len(lines1) == 11 and lines1[0] == str(len(recs))
    header = part("result_3_map.csv")[0].read_text(encoding="utf-8").splitlines()[0]
    assert header == "Country,Lat,Lon"
    assert set(paths) == {f"result_{i}" for i in range(1, 9)}


def test_stop_words_file_keeps_duplicates_of_other_words(spark, posts, stop):
    from geoscribe.operators import words

    toks = words.token_table(posts.where(F.col("username") == "special7"), "tweet_text")
    kept = [r.word for r in words.remove_stopwords(toks, stop).orderBy("word").collect()]
    assert kept == ["chicago", "city", "love"]               # "the" twice removed, others kept


def test_command_line_profile(spark, data_dir, recs, capsys):
    from geoscribe.__main__ import main

    assert main(["profile", str(data_dir / "posts.tsv")]) == 0
    lines = capsys.readouterr().out.splitlines()
    assert len(lines) == 11 and lines[0] == f"n_rows\t{float(len(recs))}"
    assert main(["profile", str(data_dir / "posts.tsv"), "0.5"]) == 0
    sampled = float(capsys.readouterr().out.splitlines()[0].split("\t")[1])
    assert 0 < sampled < len(recs)


def test_golden_invariants(posts, recs):
    # The cross-checks that hold on the reference's committed outputs.
    counts = dict((r.country_name, r.n) for r in tasks.task2_country_counts(posts).collect())
    peaks = {r.country_name: r.n for r in tasks.task4_peak_hour(posts).collect()}
    timed = {r["country_name"] for r in recs if r["utc_time"] is not None and r["timezone_offset"] is not None}
    assert set(peaks) == timed <= set(counts)                       # Task 4 keys are Task 2 keys
    assert all(peaks[k] <= counts[k] for k in peaks)                 # a peak never exceeds its group
    cities = tasks.task5_us_city_counts(posts).collect()
    us_rows = sum(1 for r in recs if r["country_code"] == "US")
    assert sum(r.n for r in cities) <= us_rows                       # US-city rows within US rows
    centroids = {r.country_name for r in tasks.task3_country_centroids(posts).collect()}
    assert centroids == {k for k, n in counts.items() if n >= 11}    # boundary: 10 out, 11 in


def test_city_counts_parts_concatenate_in_order(spark, data_dir, tmp_path, recs):
    out = tmp_path / "res"
    tasks.run_phase1(spark, str(data_dir / "posts.tsv"), str(data_dir / "stop_words.txt"), str(out))
    lines = [ln for part in sorted((out / "result_5.tsv").glob("part-*"))
             for ln in part.read_text(encoding="utf-8").splitlines()]
    assert lines == [f"{k}\t{n}" for k, n in fixtures.model_us_city_counts(recs)]
