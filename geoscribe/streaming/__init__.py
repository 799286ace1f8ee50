"""Incremental forms of the batch operators over a folder that keeps receiving
post files (Structured Streaming).  No new analysis: the same group counts and
word counts, maintained as files arrive, with state and progress kept in a
checkpoint under the shared ``spark.checkpoint.dir`` so a restarted query
resumes where it stopped."""

from geoscribe.streaming.incremental import (
    read_post_stream,
    running_group_counts,
    running_word_counts,
    start_to_table,
)

__all__ = ["read_post_stream", "running_group_counts", "running_word_counts", "start_to_table"]
