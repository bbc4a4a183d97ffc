"""Explicit schemas. Nothing is inferred."""

from pyspark.sql import types as T

# Raw text layers keep every field as a string, as the files carry them.
ITEM_FILE = T.StructType(
    [
        T.StructField("movie_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("price", T.StringType()),
    ]
)

RATING_FILE = T.StructType(
    [
        T.StructField("user", T.StringType()),
        T.StructField("movie", T.StringType()),
        T.StructField("rating", T.StringType()),
        T.StructField("time", T.StringType()),
    ]
)

CORRUPT_COL = "_corrupt_record"

# Keyed cell store, one row per cell (row key, family, qualifier, value).
CELL = T.StructType(
    [
        T.StructField("rowkey", T.StringType(), False),
        T.StructField("family", T.StringType(), False),
        T.StructField("qualifier", T.StringType(), False),
        T.StructField("value", T.StringType()),
    ]
)
