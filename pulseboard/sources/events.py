"""Feed and message logs derived from the generic ``events`` table (see FIXTURES.md).

Every event lands in exactly one of the two logs, so queries over both read the
whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("props", T.StringType()),
    ]
)

# Some people use only the messenger, some only the feed, the rest both.
_MESSENGER_ONLY = "user_id % 7 = 0"
_FEED_ONLY = "user_id % 5 = 0"
IS_FEED = f"NOT ({_MESSENGER_ONLY}) AND ({_FEED_ONLY} OR event_type IN ('view', 'click'))"


_HALF = "(user_id + 1) div 2 + IF((user_id + 1) % 10 = 0 AND dayofmonth(ts) >= 16, 1, 0)"
_PERSON = (
    "CAST((user_id + 1) % 2 AS INT) AS gender",
    "CAST(10 + ((user_id + 1) * 37) % 61 AS INT) AS age",
    f"IF(({_HALF}) % 2 = 0, 'iOS', 'Android') AS os",
)


def feed_rows(events: DataFrame) -> DataFrame:
    """Events seen as feed actions."""
    return events.selectExpr(
        "user_id + 1 AS user_id",
        "ts AS time",
        "IF(event_type IN ('click', 'purchase'), 'like', 'view') AS action",
        *_PERSON,
    )


def message_rows(events: DataFrame) -> DataFrame:
    """Events seen as messages; the receiver comes from the payload."""
    return events.selectExpr(
        "user_id + 1 AS user_id",
        "2 * CAST(get_json_object(props, '$.k') AS BIGINT) + event_id % 2 + 1 AS reciever_id",
        "ts AS time",
        *_PERSON,
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table as a file stream, with a zoned timestamp for watermarks."""
    # A file stream takes folders; the pattern lets the table be one file as well.
    stream = spark.readStream.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet*")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def feed_actions(events: DataFrame) -> DataFrame:
    return feed_rows(events.where(IS_FEED))


def message_actions(events: DataFrame) -> DataFrame:
    return message_rows(events.where(f"NOT ({IS_FEED})"))
