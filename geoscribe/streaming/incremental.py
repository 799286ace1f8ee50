"""Running group counts and word counts over arriving post files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from geoscribe.operators import groups, words
from geoscribe.session import scratch_path
from geoscribe.sources.delimited import parse_fields


def read_post_stream(spark: SparkSession, folder: str, schema=None, max_files_per_trigger: int | None = None,
                     sep: str = "\t") -> DataFrame:
    """New tab-separated files in ``folder`` as a stream of typed posts."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return parse_fields(reader.load(folder), schema, sep)


def running_group_counts(posts: DataFrame, key: str) -> DataFrame:
    """Rows per key so far (the batch ``count_by_key``; partial aggregation per
    micro-batch, totals in the state store)."""
    return groups.count_by_key(posts, key)


def running_word_counts(posts: DataFrame, text: str, stop=(), by: list[str] = ()) -> DataFrame:
    """Token counts so far, stop words removed.  The stop words are a literal
    list here (an ``IN`` filter in each micro-batch, no join with a static
    table)."""
    toks = words.token_table(posts, text, keep=list(by))
    if stop:
        toks = words.remove_stopwords(toks, list(stop))
    return words.word_counts(toks, list(by))


def start_to_table(counts: DataFrame, name: str, checkpoint: str | None = None,
                   available_now: bool = True) -> StreamingQuery:
    """Maintain ``counts`` as an in-memory table ``name`` (complete output mode).

    ``available_now`` processes every file present and stops (a restartable
    batch run); otherwise the query keeps running.  The checkpoint defaults to
    a fresh folder under the shared checkpoint directory.
    """
    spark = counts.sparkSession
    writer = (counts.writeStream.outputMode("complete").format("memory").queryName(name)
              .option("checkpointLocation", checkpoint or scratch_path(spark, f"stream-{name}")))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
