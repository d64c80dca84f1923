"""Schemas shared by sources, operators and sinks."""

from pyspark.sql import types as T

# The JSON field names of an engagement event.
EVENT_JSON = T.StructType(
    [
        T.StructField("eventName", T.StringType()),
        T.StructField("userId", T.StringType()),
        T.StructField("creatorId", T.StringType()),
        T.StructField("mediaId", T.StringType()),
        T.StructField("eventTs", T.LongType()),
    ]
)

# Column names of a decoded event, in the order of EVENT_JSON.
EVENT_COLUMNS = ["event_name", "user_id", "creator_id", "media_id", "event_ts"]

# One decayed counter.
COUNTER = "struct<decay_interval:bigint,last_update:bigint,value:double>"
