"""Scale helpers: narrow-scan spread, checked broadcast, shared scratch output."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from conftest import SF_SMALL
from geoscribe.operators.joins import checked_broadcast
from geoscribe.session import BATCH_BYTES, BATCH_CONF, CLEANUP_CONF, ensure_checkpoint_dir, materialize, scratch_path
from geoscribe.sources.tables import spread, table


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_spread_only_narrow_scans(spark):
    narrow = table(spark, SF_SMALL, "documents")            # one row group: one scan task
    assert narrow.rdd.getNumPartitions() == 1
    spread_df = spread(narrow, ["doc_id"])
    assert spread_df.rdd.getNumPartitions() == 2 * spark.sparkContext.defaultParallelism
    wide = narrow.repartition(spark.sparkContext.defaultParallelism * 3)
    assert spread(wide, ["doc_id"]) is wide                 # already wider than the cluster
    assert sorted(spread_df.select("doc_id").collect()) == sorted(narrow.select("doc_id").collect())


def test_checked_broadcast_within_and_beyond_bound(spark):
    big = table(spark, SF_SMALL, "events").select("event_type")
    small = spark.createDataFrame([("click",), ("view",)], "event_type string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # only explicit hints broadcast
    try:
        hinted = big.join(checked_broadcast(small, max_rows=2), "event_type", "left_semi")
        unhinted = big.join(checked_broadcast(small, max_rows=1), "event_type", "left_semi")
        assert "BroadcastExchange" in _plan(hinted)
        assert "BroadcastExchange" not in _plan(unhinted)
        assert hinted.count() == unhinted.count() == big.where(F.col("event_type").isin("click", "view")).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_scratch_output_lives_under_the_checkpoint_dir(spark):
    base = ensure_checkpoint_dir(spark)
    p1, p2 = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert p1.startswith(base + "/") and p1 != p2
    df = table(spark, SF_SMALL, "nation")
    m = materialize(df, "nation_copy")

    def norm(uri: str) -> str:          # file:/x and file:///x name the same folder
        return "/" + uri.split(":", 1)[-1].lstrip("/") if uri.startswith("file:") else uri

    assert all(norm(f).startswith(norm(base) + "/") for f in m.inputFiles())
    assert sorted(m.collect()) == sorted(df.collect())


def test_null_map_keys_are_counted(spark):
    from geoscribe.operators.ranking import counts_as_map

    df = spark.createDataFrame([("x", None), ("x", "k"), ("y", None)], "g string, k string")
    got = {r.g: (r.counts, r.n_null) for r in counts_as_map(df, "g", "k").collect()}
    assert got == {"x": ({"k": 1}, 1), "y": ({}, 1)}


def test_hash_sample_keeps_its_resolution(spark):
    from geoscribe.operators.sample import sample_hash

    n = sample_hash(spark.range(20_000_000), "id", 4e-7).count()
    assert 1 <= n <= 24


def test_broadcast_is_bounded_in_bytes(spark):
    from geoscribe.operators.joins import checked_broadcast

    words = spark.createDataFrame([("a" * 50,), (None,)], "word string")
    plan = lambda df: df._jdf.queryExecution().logical().toString()
    assert "broadcast" in plan(checked_broadcast(words))
    assert "broadcast" not in plan(checked_broadcast(words, max_bytes=49))


def test_first_query_line_is_of_the_first_file_by_name(spark, tmp_path):
    from geoscribe.sources import scan_query_lines

    (tmp_path / "a.txt").write_text("first line\n", encoding="utf-8")
    (tmp_path / "b.txt").write_text("other line\n" * 500, encoding="utf-8")
    assert [r.words for r in scan_query_lines(spark, str(tmp_path)).collect()] == [["first", "line"]]


def _shuffle_files(spark) -> int:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum("shuffle_" in files.apply(i).getName() for i in range(files.size()))


def test_materialize_drops_its_shuffle_files(spark):
    keyed = spark.range(5000, numPartitions=4).withColumn("k", F.col("id") % 500)
    before = _shuffle_files(spark)
    written = materialize(keyed.groupBy("k").agg(F.sum("id").alias("s")), "cleanup_test")
    deadline = time.time() + 20
    while _shuffle_files(spark) > before and time.time() < deadline:       # they go in the background
        time.sleep(0.2)
    assert _shuffle_files(spark) <= before
    assert written.count() == 500 and written.agg(F.sum("s")).first()[0] == 5000 * 4999 // 2


def test_materialize_hands_small_batches_to_python_and_restores_settings(spark):
    import pyarrow as pa

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["n"])

    texts = spark.range(6000, numPartitions=1).select(F.repeat(F.lit("x"), 3000).alias("t"))
    keys = (CLEANUP_CONF, BATCH_CONF)
    old = [spark.conf.get(k, None) for k in keys]
    got = [r.n for r in materialize(texts.mapInArrow(sizes, "n long"), "batches_test").collect()]
    assert sum(got) == 6000 and max(got) * 3000 <= BATCH_BYTES + 8000
    spark.conf.set(BATCH_CONF, "65536")                                    # a smaller one of the caller's stays
    try:
        got = [r.n for r in materialize(texts.mapInArrow(sizes, "n long"), "batches_test").collect()]
        assert sum(got) == 6000 and max(got) * 3000 <= 65536 + 8000
        assert spark.conf.get(BATCH_CONF) == "65536"
    finally:
        spark.conf.unset(BATCH_CONF)
    assert [spark.conf.get(k, None) for k in keys] == old
