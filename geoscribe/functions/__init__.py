from geoscribe.functions.text import (
    lines,
    lower_words,
    query_word_list,
    rstrip,
    split_literal,
    word_count,
    words,
)
from geoscribe.functions.time import local_hour_from_epoch_ms

__all__ = [
    "lines",
    "lower_words",
    "query_word_list",
    "rstrip",
    "split_literal",
    "word_count",
    "words",
    "local_hour_from_epoch_ms",
]
