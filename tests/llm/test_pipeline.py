"""Every stage of the pipeline against what its operator says of the stage's own input."""

from pyspark.sql import functions as F

import corpus_pipeline as cp
from geoscribe.llm import common, jaccard, quality

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = common.documents(spark, SF)
    kept = cp.quality_rules(spark, docs, SF)
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in quality.judge_quality(docs).where("kept").collect()}
    once = cp.near_duplicates(spark, docs, SF)
    groups = jaccard.jaccard_components(docs).collect()
    assert sorted(r.doc_id for r in once.collect()) == sorted({r.component_id for r in groups})
    mixed = cp.source_mixture(spark, docs, SF)
    assert mixed.columns == docs.columns and mixed.count() > docs.count()
    final = cp.run(spark, SF)
    per = [r["count"] for r in final.groupBy("shard").count().collect()]
    assert len(per) == 40 and max(per) - min(per) <= 1


def test_empty(spark):
    docs = common.documents(spark, SF).limit(0)
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
        if "shard" in docs.columns:
            break


def _words(start, n=40):
    return " ".join(f"word{chr(97 + start)}{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(n))


def test_rejected_rows_leave_clean_rows_of_their_id(spark):
    item = next(r.text for r in common.benchmark(spark, SF).collect() if r.text)
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for doc_id in (None, 7):
        clean = [(doc_id, _words(k), "en", "s", 1) for k in range(2)]
        kept = cp.quality_rules(spark, spark.createDataFrame([*clean, (doc_id, "too short", "en", "s", 1)], schema), SF)
        assert sorted(r.text for r in kept.collect()) == sorted(r[1] for r in clean)
        leak = (doc_id, f"{_words(5)} {item} {_words(6)}", "en", "s", 1)
        kept = cp.decontamination(spark, spark.createDataFrame([*clean, leak], schema), SF)
        assert sorted(r.text for r in kept.collect()) == sorted(r[1] for r in clean)


def test_near_duplicates_of_rows_without_ids(spark):
    def near(start):
        return _words(start) + " end"

    rows = [(5, near(1)), (None, _words(1)), (None, _words(3)), (None, near(3)), (None, None), (None, None), (None, "")]
    df = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = sorted(cp.near_duplicates(spark, df, SF).select("doc_id", "text").collect(), key=str)
    assert len(kept) == 4 and (5, near(1)) in kept and (None, None) in kept and (None, "") in kept
    assert sum(r.text in (_words(3), near(3)) for r in kept) == 1


def test_columns_named_like_internal_ones_are_carried(spark):
    names = ["_row_key", "_Size_in_words", "_copies_in_mixture", "_r__row_key", "id", "kept", "n", "c", "u", "size", "shard"]
    docs = common.documents(spark, SF).select("*", *[F.concat(F.lit(f"{k} "), F.col("doc_id").cast("string")).alias(k) for k in names])
    for _, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        assert out.where(" or ".join(f"not `{k}` <=> concat('{k} ', doc_id)" for k in names)).isEmpty()
    assert cp.shards(spark, docs, SF).count() == docs.count()


def test_near_duplicates_leave_other_texts_of_a_repeated_id(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, _words(1), "en", "s", 1), (2, _words(1), "en", "s", 1), (2, _words(3), "en", "s", 1),
            (None, _words(4), "en", "s", 1), (None, _words(8), "en", "s", 1)]
    kept = cp.near_duplicates(spark, spark.createDataFrame(rows, schema), SF)
    assert sorted(map(str, kept.collect())) == sorted(str(r) for r in spark.createDataFrame([rows[0], *rows[2:]], schema).collect())
