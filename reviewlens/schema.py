"""Table schemas: the review table and the result tables."""

from pyspark.sql import types as T

# Review table as read from CSV.  ``review_id`` is ours (the key for splits);
# the other five columns are the ones the review analyses name.
REVIEWS = T.StructType(
    [
        T.StructField("review_id", T.LongType(), True),
        T.StructField("reviewer", T.StringType(), True),
        T.StructField("rating", T.DoubleType(), True),
        T.StructField("review_summary", T.StringType(), True),
        T.StructField("review_detail", T.StringType(), True),
        T.StructField("helpful_str", T.StringType(), True),
    ]
)

GRID_METRICS = T.StructType(
    [
        T.StructField("feature_set", T.StringType(), False),
        T.StructField("model", T.StringType(), False),
        T.StructField("params", T.StringType(), False),
        T.StructField("metric", T.StringType(), False),
        T.StructField("avg", T.DoubleType(), True),
        T.StructField("std", T.DoubleType(), True),
    ]
)

MODEL_REPORT = T.StructType(
    [
        T.StructField("feature_set", T.StringType(), False),
        T.StructField("model", T.StringType(), False),
        T.StructField("params", T.StringType(), False),
        T.StructField("metric", T.StringType(), False),
        T.StructField("value", T.DoubleType(), True),
    ]
)
