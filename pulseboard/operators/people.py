"""What is known about people over all history, and how to keep it up to date daily."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulseboard.operators.products import both_products

ATTRIBUTES = ("gender", "age", "os")


def user_attributes(feed: DataFrame, messages: DataFrame) -> DataFrame:
    """Every attribute tuple each user ever acted with, when first and when last."""
    rows = both_products(feed, messages, ["user_id", *ATTRIBUTES, "time"])
    return rows.groupBy("user_id", *ATTRIBUTES).agg(
        F.min("time").alias("first_time"), F.max("time").alias("last_time")
    )


def merge_attributes(stored: DataFrame, recent: DataFrame) -> DataFrame:
    """Attributes table plus those of newer rows, without reading the old rows again."""
    return (
        stored.unionByName(recent)
        .groupBy("user_id", *ATTRIBUTES)
        .agg(F.min("first_time").alias("first_time"), F.max("last_time").alias("last_time"))
    )


def attribute_days(feed: DataFrame, messages: DataFrame) -> DataFrame:
    """Per user and day the tuple last acted with (ties go to the greatest tuple)."""
    rows = both_products(feed, messages, ["user_id", *ATTRIBUTES, "time"], day="date")
    return _newest(rows.withColumnRenamed("time", "last_time"))


def merge_attribute_days(stored: DataFrame, recent: DataFrame) -> DataFrame:
    """The table of days plus newer ones; of a day in both, the later tuple stays."""
    return _newest(stored.unionByName(recent))


def _newest(rows: DataFrame) -> DataFrame:
    newest = F.max(F.struct("last_time", *ATTRIBUTES)).alias("newest")
    return (
        rows.groupBy("user_id", "date")
        .agg(newest)
        .select("user_id", "date", *[F.col(f"newest.{c}").alias(c) for c in (*ATTRIBUTES, "last_time")])
    )


def latest_attributes(days: DataFrame) -> DataFrame:
    """From :func:`attribute_days`: the tuple of each user from ``since`` until before ``until`` (NULL:
    still). Days on which nothing changed are merged, so a user has a row per change."""
    in_order = Window.partitionBy("user_id").orderBy("date")
    person = F.struct(*ATTRIBUTES)
    changed = ~F.lag(person).over(in_order).eqNullSafe(person)
    changes = days.withColumn("_changed", changed).where("_changed").drop("_changed")
    return changes.select(
        "user_id", *ATTRIBUTES, F.col("date").alias("since"), F.lead("date").over(in_order).alias("until")
    )


def first_seen(feed: DataFrame, messages: DataFrame) -> DataFrame:
    """Per user the first day in the feed and in the messenger (NULL if never)."""
    rows = both_products(feed, messages, ["user_id"], day="date")
    return rows.groupBy("user_id").agg(
        F.min(F.when(F.col("is_feed"), F.col("date"))).alias("feed_first"),
        F.min(F.when(~F.col("is_feed"), F.col("date"))).alias("msg_first"),
    )


def merge_first_seen(stored: DataFrame, recent: DataFrame) -> DataFrame:
    """First-seen table plus newer rows, without reading the old rows again."""
    return (
        stored.unionByName(recent)
        .groupBy("user_id")
        .agg(F.min("feed_first").alias("feed_first"), F.min("msg_first").alias("msg_first"))
    )
