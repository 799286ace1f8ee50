"""Numbered lines, global index, ordered sinks, rejects and positional samples."""

import json

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF_SMALL
from geoscribe import sinks
from geoscribe.operators import index, profile, sample
from geoscribe.sources import scan_query_lines, scan_with_rejects, stage_delimited

CONF = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def small_splits(spark):
    spark.conf.set(CONF, "700")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset(CONF)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.fixture
def folder(tmp_path):
    sizes = {"b.txt": 400, "a.txt": 3, "c.txt": 0, "d/e.txt": 150}
    texts = {}
    for name, n in sizes.items():
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        texts[name] = [f"{name} line {i} " + "x" * (i * 37 % 90) for i in range(n)]
        end = "\r\n" if name == "b.txt" else "\n"
        (tmp_path / "in" / name).write_text("".join(t + end for t in texts[name]), newline="")
    return tmp_path / "in", texts


@pytest.mark.parametrize("bound", [None, 0])
def test_numbered_lines_over_many_splits(spark, small_splits, folder, bound, monkeypatch):
    from geoscribe.operators import joins

    if bound is not None:
        monkeypatch.setattr(joins, "MAX_BROADCAST_ROWS", bound)      # the offsets are joined by shuffle
    path, texts = folder
    reader = spark.read.option("recursiveFileLookup", "true")
    monkeypatch.setattr(type(spark), "read", property(lambda s: reader))
    rows = index.numbered_lines(spark, str(path)).collect()
    got = {}
    for r in rows:
        got.setdefault(r.file.split("/in/")[1], {})[r.line] = r.value
    assert {k: [v[i] for i in range(len(v))] for k, v in got.items()} == {k: v for k, v in texts.items() if v}
    everything = [line for name in ("a.txt", "b.txt", "d/e.txt") for line in texts[name]]
    assert [r.value for r in sorted(rows, key=lambda r: r["index"])] == everything
    assert [r["index"] for r in sorted(rows, key=lambda r: r["index"])] == list(range(len(everything)))


def test_query_lines_are_numbered_whatever_the_splits(spark, small_splits, tmp_path):
    (tmp_path / "q2.txt").write_text("Other words\n")
    (tmp_path / "q1.txt").write_text("".join(f"Word{i} the word{i}\n" for i in range(300)))
    rows = scan_query_lines(spark, str(tmp_path), first_line_only=False).orderBy("query_id").collect()
    assert [(r.query_id, r.line) for r in rows] == [(i, i) for i in range(300)] + [(300, 0)]
    assert rows[17].words == ["word17", "the"] and rows[300].words == ["other", "words"]
    assert [(r.query_id, r.line, r.words) for r in scan_query_lines(spark, str(tmp_path)).collect()] == [(0, 0, ["word0", "the"])]


def test_global_index(spark, small_splits):
    rows = [(i * 7919 % 1000 // 3, i) for i in range(1000)] + [(None, -1), (None, -2)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(6, "b")
    got = index.global_index(df, [F.col("a").desc_nulls_last(), F.col("b")]).orderBy("index").collect()
    want = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert [(r.a, r.b) for r in got] == want and [r["index"] for r in got] == list(range(len(rows)))
    assert index.global_index(df.limit(0), [F.col("a")]).count() == 0
    ties = index.global_index(df.withColumn("a", F.lit(1)), [F.col("a")])
    assert sorted(r["index"] for r in ties.collect()) == list(range(len(rows)))


def test_ordered_sink_has_parts_in_order_and_a_manifest(spark, small_splits, tmp_path):
    df = spark.range(3_000).select((F.col("id") * 7919 % 3000).alias("k"), "id").repartition(9, "id")
    out = str(tmp_path / "out")
    sinks.write_tsv(df, out, ["k", "id"], order_by=[F.col("k").desc()])
    parts = sorted((tmp_path / "out").glob("part-*"))
    assert len(parts) > 2
    lines = [line for p in parts for line in p.read_text().splitlines()]
    assert [int(line.split("\t")[0]) for line in lines] == list(range(2999, -1, -1))
    manifest = [json.loads(x) for p in (tmp_path / "out" / sinks.MANIFEST).glob("part-*") for x in p.read_text().splitlines()]
    manifest.sort(key=lambda m: m["part"])
    assert [m["file"] for m in manifest] == [p.name for p in parts]
    assert [m["rows"] for m in manifest] == [len(p.read_text().splitlines()) for p in parts]
    assert [m["first_line"] for m in manifest] == [p.read_text().splitlines()[0] for p in parts]
    assert [m["rows_before"] for m in manifest] == [sum(x["rows"] for x in manifest[:i]) for i in range(len(manifest))]
    back = sinks.read_ordered(spark, out).orderBy("index").collect()
    assert [r.value for r in back] == lines and [r["index"] for r in back] == list(range(3000))
    assert spark.read.text(out).count() == 3000            # plain readers do not see the manifest


def test_rejects_in_the_same_pass(spark, tmp_path):
    schema = [("name", T.StringType()), ("n", T.LongType()), ("x", T.DoubleType())]
    (tmp_path / "in.tsv").write_text("a\t1\t0.5\nshort\t1\nb\tone\ttwo\nc\t3\t\nd\t4\t1e3\textra\n\n")
    observed = Observation("lines")
    records, rejects = stage_delimited(spark, str(tmp_path / "in.tsv"), schema, observation=observed)
    assert sorted(tuple(r) for r in records.collect()) == [("a", 1, 0.5), ("d", 4, 1000.0)]
    assert sorted(tuple(r) for r in rejects.collect()) == [
        ("not a number: n", "b\tone\ttwo"), ("not a number: x", "c\t3\t"), ("short line", ""), ("short line", "short\t1")]
    assert observed.get == {"n_lines": 6, "n_rejected": 4}
    every = scan_with_rejects(spark, str(tmp_path / "in.tsv"), schema)
    assert every.count() == 6 and every.where("_line is not null").count() == 4
    (tmp_path / "empty.tsv").write_text("")
    records, rejects = stage_delimited(spark, str(tmp_path / "empty.tsv"), schema)
    assert records.count() == rejects.count() == 0


def test_sample_by_position_is_the_same_for_any_split(spark, tmp_path):
    src = spark.range(4_000).select(F.lit("copy").alias("v"), (F.col("id") % 10).alias("g"))
    path = str(tmp_path / "rows.parquet")
    src.coalesce(1).write.option("parquet.block.size", 1 << 12).parquet(path)
    draws = []
    for size in ("1000000", "500"):
        spark.conf.set(CONF, size)
        try:
            df = sample.sample_rows(spark.read.parquet(path), 0.25, 5)
            draws.append(sorted(map(tuple, df.select("g", F.col("_metadata.row_index")).repartition(7).collect())))
        finally:
            spark.conf.unset(CONF)
    assert draws[0] == draws[1] and 850 < len(draws[0]) < 1_150          # equal rows are drawn one by one
    other = sample.sample_rows(spark.read.parquet(path), 0.25, 6).count()
    assert 850 < other < 1_150
    assert sample.sample_rows(spark.read.parquet(path), 0.0, 5).count() == 0
    assert sample.sample_rows(spark.read.parquet(path), 1.0, 5).count() == 4_000


def test_sample_of_lines_is_the_same_for_any_split(spark, tmp_path):
    (tmp_path / "lines.txt").write_text("".join(f"line {i}\n" for i in range(2_000)))
    draws = []
    for size in ("1000000", "900"):
        spark.conf.set(CONF, size)
        try:
            draws.append(sorted(r.value for r in sample.sample_lines(spark, str(tmp_path / "lines.txt"), 0.1, 5).collect()))
        finally:
            spark.conf.unset(CONF)
    assert draws[0] == draws[1] and 140 < len(draws[0]) < 260


def test_distinct_counts_without_row_multiplication(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    wide = profile.profile_wide(docs, "text", ["source", "lang"], ["n_chars"])
    assert "Expand" not in wide._jdf.queryExecution().optimizedPlan().toString()
    rows = docs.collect()
    got = wide.first()
    assert (got.n_rows, got.n_distinct_source, got.n_distinct_lang) == (
        len(rows), len({r.source for r in rows} - {None}), len({r.lang for r in rows} - {None}))


def test_bounded_maps(spark):
    from geoscribe.operators import ranking

    df = spark.createDataFrame([("a", k) for k in "xxyyzw"] + [("a", None), ("b", None)], "o string, k string")
    assert {(r.o, r.k, r.n) for r in ranking.counts_table(df, "o", "k").collect()} == {
        ("a", "x", 2), ("a", "y", 2), ("a", "z", 1), ("a", "w", 1), ("a", None, 1), ("b", None, 1)}
    assert [(r.o, r.counts) for r in ranking.top_counts_map(df, "o", "k", 3).collect()] == [("a", {"x": 2, "y": 2, "w": 1})]
    plan = ranking.top_counts_map(df, "o", "k", 3)._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
