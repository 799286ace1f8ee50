"""Corpus preparation operators for language-model training data.

Nothing outside this subpackage imports it.  Every operator takes DataFrames
and column names, selects the columns it needs under its own names first (so
extra columns with any name never clash) and returns a DataFrame.  Rows with
null ids, null or empty texts and repeated rows are legal everywhere; each
module states what they yield.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so that a cluster
# needs no copy of it (numpy, pandas, pyarrow and zstandard must be installed there).
cloudpickle.register_pickle_by_value(sys.modules[__name__])
