"""Daily activity per user and its slices: the feed, the messenger, both together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseboard.functions import Moment, age_group, day_of, history, last_days, rows_in
from pulseboard.operators import (
    attribute_days,
    latest_attributes,
    message_sides,
    slice_sums,
    user_attributes,
)
from pulseboard.operators.people import ATTRIBUTES

FEED_METRICS = ("likes", "views")
MESSAGE_METRICS = ("messages_received", "messages_sent", "users_sent", "users_received")
METRICS = (*FEED_METRICS, *MESSAGE_METRICS)
GRAIN = ("event_date", "user_id", *ATTRIBUTES)


def _feed_marks(feed: DataFrame, as_of: Moment, days: int) -> DataFrame:
    """Feed rows of the window with a 0/1 column per metric."""
    rows = rows_in(feed, last_days(as_of, days))
    return rows.withColumn("event_date", day_of(rows)).selectExpr(
        *GRAIN,
        "IF(action = 'like', 1L, 0L) AS likes",
        "IF(action = 'view', 1L, 0L) AS views",
    )


def _sums(metrics: Sequence[str]) -> list:
    return [F.sum(m).alias(m) for m in metrics]


def _filled(rows: DataFrame, metrics: Sequence[str], unknown: str = "zero") -> DataFrame:
    """Absent counts are zeros, and an absent ``os`` is empty. An absent gender or age is 0, or
    stays absent with ``unknown="label"``, so that the age group reads "unknown"."""
    if unknown not in ("zero", "label"):
        raise ValueError(f"unknown must be 'zero' or 'label', not {unknown!r}")
    numbers = {"gender": 0, "age": 0} if unknown == "zero" else {}
    return rows.fillna({**dict.fromkeys(metrics, 0), **numbers, "os": ""})


def feed_user_daily(feed: DataFrame, as_of: Moment, days: int = 1) -> DataFrame:
    """Likes and views per day, user and attributes; by default of yesterday."""
    return _feed_marks(feed, as_of, days).groupBy(*GRAIN).agg(*_sums(FEED_METRICS))


def _known(feed: DataFrame, messages: DataFrame, as_of: Moment, attributes: str | DataFrame) -> DataFrame:
    """Attribute tuples of users, with the days ``since`` and ``until`` (NULL: open) for which
    they count: from the day on which a user first acted with one, for "latest" until another, for
    "ever" always."""
    if isinstance(attributes, DataFrame):
        table = attributes
    else:
        if attributes not in ("all", "latest", "ever"):
            raise ValueError(f"attributes must be 'all', 'latest', 'ever' or a frame, not {attributes!r}")
        # A backfill knows what was known then: no rows from ``as_of`` on, but for "ever".
        logs = [log if attributes == "ever" else rows_in(log, history(as_of)) for log in (feed, messages)]
        table = attribute_days(*logs) if attributes == "latest" else user_attributes(*logs)
        if attributes == "ever":
            open_end = F.lit(None).cast("date")
            return table.select("user_id", *ATTRIBUTES, open_end.alias("since"), open_end.alias("until"))
    if "first_time" in table.columns:
        return table.select(
            "user_id", *ATTRIBUTES, F.to_date("first_time").alias("since"), F.lit(None).cast("date").alias("until")
        )
    return latest_attributes(table)


def message_user_daily(
    feed: DataFrame,
    messages: DataFrame,
    as_of: Moment,
    days: int = 1,
    attributes: str | DataFrame = "all",
    unknown: str = "zero",
) -> DataFrame:
    """Messages and peers per day and user, with the user's attributes as known on that day.

    Attributes come from all history of both logs up to each day. A user who had acted with several
    attribute tuples gets a row for each (``attributes="all"``) or only for the last one of then
    (``"latest"``); ``"ever"`` takes the tuples of all given rows, later ones too. A kept table can be given instead, which spares the scan of all history:
    one of :func:`user_attributes` stands for "all", one of :func:`attribute_days` for "latest".
    """
    span = last_days(as_of, days)
    sent = rows_in(messages, span)
    if days == 1:
        # One day needs no grouping by day, so the totals arrive partitioned by user
        # and the join below does not move them again.
        totals = message_sides(sent).withColumn("event_date", F.lit(span.first_day))
    else:
        totals = message_sides(sent.withColumn("event_date", day_of(sent)), by=["event_date"])
    known = _known(feed, messages, as_of, attributes).withColumnRenamed("user_id", "_user")
    in_time = (F.col("since").isNull() | (F.col("since") <= F.col("event_date"))) & (
        F.col("until").isNull() | (F.col("event_date") < F.col("until"))
    )
    joined = totals.join(known, (F.col("user_id") == F.col("_user")) & in_time, "left")
    return _filled(joined.select(*GRAIN, *MESSAGE_METRICS), MESSAGE_METRICS, unknown)


def _facts(
    feed: DataFrame, messages: DataFrame, as_of: Moment, days: int, attributes, unknown: str
) -> DataFrame:
    """Additive rows of both products; sums over them equal sums over the outer merge."""
    both = _feed_marks(feed, as_of, days).unionByName(
        message_user_daily(feed, messages, as_of, days, attributes, unknown), allowMissingColumns=True
    )
    return _filled(both, METRICS, unknown)


def user_activity_daily(
    feed: DataFrame,
    messages: DataFrame,
    as_of: Moment,
    days: int = 1,
    attributes: str | DataFrame = "all",
    unknown: str = "zero",
) -> DataFrame:
    """Both products' metrics per day, user and attributes, ``age`` as its group."""
    merged = _facts(feed, messages, as_of, days, attributes, unknown).groupBy(*GRAIN).agg(*_sums(METRICS))
    return merged.withColumn("age", age_group(F.col("age")))


def dimension_metrics(
    feed: DataFrame,
    messages: DataFrame,
    as_of: Moment,
    days: int = 1,
    dimensions: Sequence[str] = ATTRIBUTES,
    attributes: str | DataFrame = "all",
    unknown: str = "zero",
) -> DataFrame:
    """Daily sums of all metrics by value of each dimension, in the table's column order."""
    facts = _facts(feed, messages, as_of, days, attributes, unknown)
    facts = facts.withColumn("age", age_group(F.col("age")))
    stored = ("views", "likes", *MESSAGE_METRICS)
    return slice_sums(facts, ["event_date"], dimensions, stored).select(
        "event_date", "dimension", "dimension_value", *stored
    )
