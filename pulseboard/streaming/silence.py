"""Silence as an event: products that have no rows for a while.

Rows become closed buckets per product, and each product's last bucket is state with an event-time timer.
When the watermark passes the timer, or a later bucket comes that is too far from the last one, the gap is told,
once, as a row. A product that stays away for ``forget`` loses its state, so that keys which are no longer used
do not pile up; if it comes back, it begins anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseboard.functions import bucket_minutes
from pulseboard.operators.bands import BUCKET
from pulseboard.streaming.state import SilenceState

MINUTE = 60_000


def silence_stream(
    feed: DataFrame,
    messages: DataFrame,
    silent_minutes: int = 120,
    lateness: str = "30 minutes",
    minutes: int = 15,
    forget_minutes: int = 7 * 24 * 60,
) -> DataFrame:
    """(product, last_bucket, silent_from): a row when a product, "feed" or "messages", has had a bucket with
    rows and then none for more than ``silent_minutes``; ``silent_from`` is when that time was over.

    Run it with the RocksDB state store (see :func:`pulseboard.streaming.run.start`).
    """
    width = bucket_minutes(minutes)
    rows = (
        feed.withWatermark("time", lateness)
        .select("time", F.lit("feed").alias("product"))
        .unionByName(messages.withWatermark("time", lateness).select("time", F.lit("messages").alias("product")))
    )
    buckets = rows.groupBy(F.window("time", f"{width} minutes"), "product").agg(F.count("*").alias("n"))
    marked = buckets.select("window", "product", F.unix_millis(F.col("window.start")).alias("at"))
    told = marked.groupBy("product").transformWithStateInPandas(
        SilenceState(silent_minutes * MINUTE, width * MINUTE, forget_minutes * MINUTE),
        outputStructType=T.StructType([T.StructField("product", T.StringType()), T.StructField("at", T.LongType())]),
        outputMode="Append",
        timeMode="EventTime",
    )
    return told.select(
        "product",
        F.timestamp_millis("at").alias("last_bucket"),
        F.timestamp_millis(F.col("at") + silent_minutes * MINUTE).alias("silent_from"),
    )
