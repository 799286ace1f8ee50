"""Naive Bayes classifier: brute force on the fixture, ties, empty answers, batch form."""

from __future__ import annotations

import math

import fixtures
import pytest
from pyspark.sql import functions as F

from geoscribe.operators import bayes
from geoscribe.plans import tasks
from geoscribe.sources import scan_query_lines


def _queries(spark, lists):
    rows = [(i, ws) for i, ws in enumerate(lists)]
    return spark.createDataFrame(rows, "query_id long, words array<string>")


QUERIES = [
    ["love", "the", "city"],
    ["LOVE", "love", "Coffee"],        # upper case and a repeat
    ["zzz-unseen"],                    # no place holds it: empty answer
    ["tie"],                           # only Fiji texts
    ["the"],
    [""],                              # a double blank makes '' a word
    ["photo", "near", "art", "east", "we", "my"],
]


@pytest.mark.parametrize("ws", QUERIES)
def test_score_words_matches_brute_force(posts, recs, ws):
    got = {r.place_name: r.p for r in bayes.score_words(posts, "place_name", "tweet_text", ws).collect()
           if r.place_name is not None}
    want = fixtures.model_scores(recs, ws)
    assert got == want                                      # bit-equal: same fold order


def test_batch_equals_single_query_answers(spark, posts, recs):
    q = _queries(spark, QUERIES)          # raw word lists: the operator lower-cases and de-duplicates
    got = {}
    for r in tasks.classify(posts, q).collect():
        got.setdefault(r.query_id, {})[r.place_name] = r.p
    for i, ws in enumerate(QUERIES):
        want = fixtures.model_best(fixtures.model_scores(recs, ws))
        assert got.get(i, {}) == want, (ws, got.get(i), want)


def test_unseen_word_gives_no_answer(spark, posts):
    scores = bayes.score_words(posts.where(F.col("country_name") == "Norway").union(
        posts.where(F.col("country_name") == "Sweden")), "place_name", "tweet_text", ["zzz-unseen"])
    assert bayes.best_classes(scores.select("place_name", "p")).count() == 0


def test_two_classes_tied(spark):
    train = spark.createDataFrame(
        [("A", "x y"), ("A", "x"), ("B", "x y"), ("B", "x"), ("C", "y")], "place_name string, tweet_text string")
    q = _queries(spark, [["x"], ["y", "x"], ["q"]])
    got = sorted((r.query_id, r.place_name) for r in tasks.classify(train, q).collect())
    assert got == [(0, "A"), (0, "B"), (1, "A"), (1, "B")]


def test_first_line_of_query_file(spark, posts, recs, tmp_path):
    path = tmp_path / "input.txt"
    path.write_text("Love THE city  \t\nsecond line ignored\n", encoding="utf-8")
    q = scan_query_lines(spark, str(path))
    rows = q.collect()
    assert len(rows) == 1 and rows[0].words == ["love", "the", "city"]
    got = {r.place_name: r.p for r in tasks.classify(posts, q).collect()}
    assert got == fixtures.model_best(fixtures.model_scores(recs, ["love", "the", "city"]))


def test_empty_query_file_gives_no_answer(spark, posts, tmp_path):
    path = tmp_path / "empty.txt"
    path.write_text("", encoding="utf-8")
    assert tasks.classify(posts, scan_query_lines(spark, str(path))).count() == 0


def test_priors_sum_to_one(posts):
    total = sum(r.prior for r in bayes.priors(posts, "place_name").collect())
    assert abs(total - 1.0) < 1e-12


def test_run_classifier_output(spark, data_dir, tmp_path, recs):
    q = tmp_path / "q.txt"
    q.write_text("tie\n", encoding="utf-8")
    out = tmp_path / "out.tsv"
    tasks.run_classifier(spark, str(data_dir / "posts.tsv"), str(q), str(out))
    lines = sorted(next(out.glob("part-*")).read_text(encoding="utf-8").splitlines())
    best = fixtures.model_best(fixtures.model_scores(recs, ["tie"]))
    assert [ln.split("\t")[0] for ln in lines] == sorted(best)
    assert [float(ln.split("\t")[1]) for ln in lines] == [best[k] for k in sorted(best)]


def test_command_line_classify(spark, data_dir, tmp_path, recs):
    from geoscribe.__main__ import main

    q = tmp_path / "q.txt"
    q.write_text("Love the CITY\n", encoding="utf-8")
    out = tmp_path / "cli_out"
    assert main(["classify", str(data_dir / "posts.tsv"), str(q), str(out)]) == 0
    lines = next(out.glob("part-*")).read_text(encoding="utf-8").splitlines()
    best = fixtures.model_best(fixtures.model_scores(recs, ["love", "the", "city"]))
    assert {ln.split("\t")[0]: float(ln.split("\t")[1]) for ln in lines} == best
    assert main(["bogus"]) == 2


def test_fold_reproduces_the_published_probability(spark):
    # The reference's committed classifier output: a place with 48 of 2,715,066
    # posts and presence counts whose product is 2 scores 3.197180310001877e-10.
    df = spark.createDataFrame([(48, 2715066, [2, 1, 1])], "n long, total long, d array<long>")
    p = df.select(bayes.fold_probability(F.col("n") / F.col("total"), F.col("d"), F.col("n"))).first()[0]
    assert p == 3.197180310001877e-10


def test_long_literal_query_uses_candidate_path(posts, recs):
    words = list(fixtures.VOCAB) + [f"w{i}" for i in range(60)]          # > 64 distinct words
    got = {r.place_name: r.p for r in bayes.score_words(posts, "place_name", "tweet_text", words).collect()
           if r.place_name is not None}
    assert got == fixtures.model_scores(recs, words)
    short = ["love", "the"]
    got_short = {r.place_name: r.p for r in bayes.score_words(posts, "place_name", "tweet_text", short).collect()
                 if r.place_name is not None}
    assert got_short == fixtures.model_scores(recs, short)


def test_classifier_output_prints_probabilities_as_python_does(spark, data_dir, tmp_path, recs):
    q = tmp_path / "q2.txt"
    q.write_text("love the city\n", encoding="utf-8")
    out = tmp_path / "out2.tsv"
    tasks.run_classifier(spark, str(data_dir / "posts.tsv"), str(q), str(out))
    lines = next(out.glob("part-*")).read_text(encoding="utf-8").splitlines()
    best = fixtures.model_best(fixtures.model_scores(recs, ["love", "the", "city"]))
    assert lines == [f"{k}\t{best[k]!r}" for k in sorted(best)]


def test_long_queries_do_not_underflow_and_null_is_a_class(spark):
    words = [f"w{i}" for i in range(400)]
    rows = [("A", " ".join(words))] + [("A", "x")] * 99 + [("B", " ".join(words))] + [("B", "x")] * 149
    train = spark.createDataFrame(rows, "place_name string, tweet_text string")
    scores = bayes.score_words(train, "place_name", "tweet_text", words)
    assert [r.place_name for r in bayes.best_classes(scores, "scaled").collect()] == ["A"]
    logs = {r.place_name: r.log_p for r in scores.collect()}
    assert abs(logs["A"] - (math.log(0.4) - 400 * math.log(100))) < 1e-6
    assert [r.place_name for r in tasks.classify(train, _queries(spark, [words])).collect()] == ["A"]
    for k in (64, 65):
        nulls = spark.createDataFrame([(None, " ".join(words[:k])), ("A", "x")], "place_name string, tweet_text string")
        scores = bayes.score_words(nulls, "place_name", "tweet_text", words[:k])
        literal = [(r.place_name, r.p) for r in bayes.best_classes(scores, "scaled").collect()]
        batch = [(r.place_name, r.p) for r in tasks.classify(nulls, _queries(spark, [words[:k]])).collect()]
        assert literal == batch == [(None, 0.5)]


def _train(spark, n_classes=300, seed=11):
    """Many classes; every text holds 'the', so its list of classes is all of them."""
    import random

    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(25)]
    rows = [(None if c == 0 else f"c{c}", " ".join(["The"] + rng.choices(vocab, k=rng.randrange(1, 6))))
            for c in range(n_classes) for _ in range(rng.randrange(1, 12) if c else 30)]
    return rows, spark.createDataFrame(rows, "cls string, text string")


def _brute(rows, words):
    from collections import defaultdict
    from functools import reduce

    texts = defaultdict(list)
    for c, t in rows:
        texts[c].append(set(t.lower().split(" ")))
    ws = list(dict.fromkeys(w.lower() for w in words))
    p = {c: reduce(lambda x, w: x * sum(w in t for t in ts) / len(ts), ws, len(ts) / len(rows)) for c, ts in texts.items()}
    best = max(p.values())
    return {(c, v) for c, v in p.items() if v == best and v > 0}


def test_pruned_batch_equals_brute_force(spark):
    from geoscribe.operators import bayes

    rows, train = _train(spark)
    lists = [["the"], ["the", "w1"], ["w2", "The", "w3"], ["w4", "w5", "w6", "w7"], ["nowhere", "the"], ["w8"] * 3, ["w9", "w10"]]
    queries = [(i, ws) for i, ws in enumerate(lists * 20)]
    got = {}
    for r in bayes.estimate_places(train, spark.createDataFrame(queries, "query_id int, words array<string>"), "cls", "text").collect():
        got.setdefault(r.query_id, set()).add((r.cls, r.p))
    for i, ws in queries:
        assert got.get(i, set()) == _brute(rows, ws)


def test_candidates_are_bounded_by_distinct_lists(spark):
    """Equal lists are scored once, and classes below the bound are never paired with a list."""
    from geoscribe.operators import bayes

    rows, train = _train(spark)
    queries = spark.createDataFrame([(i, ["the", "W1"] if i % 2 else ["The"]) for i in range(500)], "query_id int, words array<string>")
    lists, named = bayes.distinct_lists(queries, ["query_id"])
    assert lists.count() == 2 and named.count() == 500
    scored = bayes.score_lists(train, lists, "cls", "text")
    assert scored.count() < 2 * 300 / 4
    pres = bayes.presence_for_vocabulary(train, "cls", "text", spark.createDataFrame([("the",)], "word string"))
    rarest = spark.createDataFrame([(0, "the", 1, 11.0), (1, "the", 1, 0.0)], "list_id long, word string, k int, least double")
    per_list = {r.list_id: r["count"] for r in bayes.candidate_classes(rarest, pres, "cls").groupBy("list_id").count().collect()}
    assert per_list[1] == 300 and per_list[0] == pres.where("d >= 11").count() < 60
