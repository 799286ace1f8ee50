"""The 13-field geotagged post and its typed Spark schema.

Fixed values: field names and order of the tab-separated post line, index 0
to 12.  They must equal the input layout for positional parsing to be right.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values (input layout): position -> (name, Spark type).
POST_FIELDS: list[tuple[str, T.DataType]] = [
    ("utc_time", T.LongType()),          # epoch milliseconds
    ("country_name", T.StringType()),
    ("country_code", T.StringType()),
    ("place_type", T.StringType()),
    ("place_name", T.StringType()),
    ("language", T.StringType()),
    ("username", T.StringType()),
    ("user_screen_name", T.StringType()),
    ("timezone_offset", T.IntegerType()),  # seconds added to UTC
    ("number_of_friends", T.LongType()),
    ("tweet_text", T.StringType()),
    ("latitude", T.DoubleType()),
    ("longitude", T.DoubleType()),
]


def post_schema() -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in POST_FIELDS])


def field_spec(schema: T.StructType | list[tuple[str, T.DataType]]) -> list[tuple[str, T.DataType]]:
    if isinstance(schema, T.StructType):
        return [(f.name, f.dataType) for f in schema.fields]
    return list(schema)
