"""DataFrame operators; each takes and returns a DataFrame."""

from geoscribe.operators import bayes, groups, index, joins, profile, ranking, sample, words

__all__ = ["bayes", "groups", "index", "joins", "profile", "ranking", "sample", "words"]
