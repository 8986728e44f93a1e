"""Fixed schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# A message as received and written to JSON Lines.
MESSAGE = T.StructType(
    [
        T.StructField("event", T.StringType()),
        T.StructField("message_id", T.StringType()),
        T.StructField("sequence_id", T.LongType()),
        T.StructField("partition_id", T.LongType()),
        T.StructField("created_at", T.DoubleType()),
        T.StructField("arrival_ts", T.DoubleType()),
        T.StructField("arrival_index", T.LongType()),
        T.StructField("value", T.LongType()),
        T.StructField("zipcode", T.StringType()),
    ]
)

# The synthetic sales table.
SALES = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("region", T.StringType()),
        T.StructField("user_segment", T.StringType()),
        T.StructField("value", T.LongType()),
    ]
)
