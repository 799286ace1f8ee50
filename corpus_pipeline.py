"""Corpus pipeline: quality, near duplicates, decontamination, mixture, shards.

Each stage takes ``(spark, docs, sf_dir)`` and returns the documents that go on
(all columns of ``docs``; the last one returns the shard of every row).  Quality,
near duplicates and decontamination decide by row: by document id and a 128-bit
hash of the text (by language and source too where those count), null matching null, so
texts that share an id or have none are kept or dropped each by itself; of a group
of near duplicates the smallest id stays, a text without an id only if none has one.
Of rows equal in id and text one stays.  ``run`` writes each stage's result
as Parquet below the shared checkpoint folder and reads it back, so a lost
executor never sends the work back further than one stage.

An empty table passes through all stages.  Extra columns are carried along, whatever
their names: those of the stages' own columns are chosen around them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoscribe.llm import common, jaccard, mixing, quality, sharding, templates

#: Robust estimates, distance joins and hashed draws have no SQL twin; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def _keyed(docs: DataFrame, *more: str) -> tuple[DataFrame, str]:
    """``docs`` with a key that tells texts of one id apart (null ids last in its order), and the key's name."""
    key = common.free_name(docs, "_row_key")
    return docs.withColumn(key, F.struct(
        F.col("doc_id").isNull().alias("unnamed"), "doc_id", *more, F.xxhash64("text").alias("h0"),
        F.xxhash64(F.lit("row"), F.col("text")).alias("h1"))), key


def _without(docs: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return common.null_safe(docs, keys.select(key).distinct(), [key], "left_anti")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that fail the base rules or are outliers of their language and source."""
    keyed, key = _keyed(docs, "lang", "source")
    return _without(keyed, quality.judge_quality(keyed, id_col=key).where(~F.col("kept")), key).drop(key)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of every group, and one of identical rows."""
    keyed, key = _keyed(docs)
    groups = jaccard.jaccard_components(keyed, id_col=key)
    kept = _without(keyed, groups.where(F.col("component_id") != F.col(key)), key)
    return kept.dropDuplicates([key]).drop(key)                  # equal rows combine in each task first


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item or a re-parameterised one."""
    keyed, key = _keyed(docs)
    return _without(keyed, templates.contaminated(keyed, common.benchmark(spark, sf_dir), id_col=key), key).drop(key)


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat each document as often as the mixture takes it (0 to 2 times)."""
    size, copies = common.free_name(docs, "_size_in_words"), common.free_name(docs, "_copies_in_mixture")
    taken = mixing.mix(docs).groupBy("doc_id", "source", F.col("size").alias(size)).agg(F.max("copies").alias(copies))
    sized = docs.withColumn(size, common.word_count(F.col("text")))
    mixed = common.null_safe(sized, taken.where(F.col(copies) > 0), ["doc_id", "source", size], "inner")
    return mixed.withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*docs.columns)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row of the mixture."""
    return sharding.shard_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", source_mixture),
    ("sharding", shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = common.materialize(stage(spark, docs, sf_dir), f"stage_{name.replace(' ', '_').lower()}")
    return STAGES[-1][1](spark, docs, sf_dir)
