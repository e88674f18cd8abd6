"""Quarter-hour metrics of both products and alerts on values outside their bands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from pulseboard.functions import (
    Moment,
    closed_buckets,
    half_even,
    number_text,
    quarter_hour,
    ratio,
    rows_in,
)
from pulseboard.operators import causal_bands, chart_bands
from pulseboard.operators.bands import BUCKET

METRICS = ("feed_users", "msg_users", "likes", "views", "messages")


def marks(feed: DataFrame, messages: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of both logs with a 0/1 column per count; ``columns`` are taken along."""
    acted = feed.selectExpr(
        *columns,
        "1L AS feed_rows",
        "IF(action = 'like', 1L, 0L) AS likes",
        "IF(action = 'view', 1L, 0L) AS views",
        "0L AS messages",
    )
    sent = messages.selectExpr(
        *columns, "0L AS feed_rows", "0L AS likes", "0L AS views", "1L AS messages"
    )
    return acted.unionByName(sent)


def user_sums() -> list[Column]:
    """First step: sums per bucket and user."""
    return [F.sum(c).alias(c) for c in ("feed_rows", "likes", "views", "messages")]


def bucket_counts(per_user: GroupedData) -> DataFrame:
    """Second step, over the first: exact users and totals, where both products have rows."""
    counts = per_user.agg(
        F.expr("count_if(user_id IS NOT NULL AND feed_rows > 0) AS feed_users"),
        F.expr("count_if(user_id IS NOT NULL AND messages > 0) AS msg_users"),
        F.sum("likes").alias("likes"),
        F.sum("views").alias("views"),
        F.expr("sum(IF(user_id IS NULL, 0L, messages)) AS messages"),
        F.sum("feed_rows").alias("_feed_rows"),
        F.sum("messages").alias("_message_rows"),
    )
    return counts.where("_feed_rows > 0 AND _message_rows > 0").drop("_feed_rows", "_message_rows")


def quarter_hour_series(
    feed: DataFrame,
    messages: DataFrame,
    by: Sequence[str] = (),
    with_ctr: bool = False,
    minutes: int = 15,
) -> DataFrame:
    """Metrics per bucket (and slice) over all given rows.

    Users are counted exactly by grouping per bucket and user first; both products
    go through the same two shuffles, the second of them tiny.
    """
    rows = marks(feed, messages, ["time", "user_id", *by])
    per_user = (
        rows.withColumn(BUCKET, quarter_hour(F.col("time"), minutes))
        .groupBy(BUCKET, *by, "user_id")
        .agg(*user_sums())
    )
    metrics = bucket_counts(per_user.groupBy(BUCKET, *by))
    if with_ctr:
        metrics = metrics.withColumn("ctr", ratio(F.col("likes"), F.col("views")))
    return metrics


def quarter_hour_metrics(
    feed: DataFrame,
    messages: DataFrame,
    as_of: Moment,
    by: Sequence[str] = (),
    with_ctr: bool = False,
    minutes: int = 15,
) -> DataFrame:
    """The series from yesterday's midnight to the last closed bucket before ``as_of``."""
    span = closed_buckets(as_of, minutes)
    return quarter_hour_series(
        rows_in(feed, span), rows_in(messages, span), by, with_ctr, minutes
    )


def long_series(
    metrics: DataFrame, names: Sequence[str] = METRICS, by: Sequence[str] = ()
) -> DataFrame:
    """One row per bucket and metric."""
    return metrics.unpivot([BUCKET, *by], list(names), "metric", "value")


def metric_bands(
    metrics: DataFrame,
    names: Sequence[str] = METRICS,
    a: float = 4,
    sample_size: int = 6,
    by: Sequence[str] = (),
) -> DataFrame:
    """Every metric's series with the band drawn around it."""
    return chart_bands(long_series(metrics, names, by), a, sample_size, by)


def decisions(bands: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Whether each value lies outside its band, and by how much it moved.

    A value that is no number, or that has no band, does not alert.
    """
    value = F.col("value")
    number = F.nanvl(value, F.lit(None)) if dict(bands.dtypes)["value"] == "double" else value
    outside = (number < F.col("low")) | (number > F.col("up"))
    deviation = (1 - F.try_divide(value, F.col("prev_value"))) * 100
    return bands.select(
        "metric",
        *by,
        BUCKET,
        "value",
        "prev_value",
        "low",
        "up",
        F.abs(half_even(deviation, 2)).alias("deviation_pct"),
        F.coalesce(outside, F.lit(False)).alias("is_alert"),
    )


def alert_replay(
    metrics: DataFrame,
    names: Sequence[str] = METRICS,
    a: float = 4,
    sample_size: int = 6,
    by: Sequence[str] = (),
) -> DataFrame:
    """For every bucket and metric, whether it alerted when it was the newest one."""
    return decisions(causal_bands(long_series(metrics, names, by), a, sample_size, by), by)


def alert_latest(
    metrics: DataFrame,
    names: Sequence[str] = METRICS,
    a: float = 4,
    sample_size: int = 6,
    by: Sequence[str] = (),
) -> DataFrame:
    """The alert decision on the newest bucket of every series."""
    replay = alert_replay(metrics, names, a, sample_size, by)
    rest = [c for c in replay.columns if c not in ("metric", *by)]
    newest = F.max_by(F.struct(*rest), BUCKET).alias("newest")
    return (
        replay.groupBy("metric", *by)
        .agg(newest)
        .select("metric", *by, *[F.col(f"newest.{c}").alias(c) for c in rest])
    )


# The wording of an alert.
ALERT_TEXT = '''Метрика {metric}:
текущее значение: {value}
отклонение от предыдущего значения: {deviation}%
'''
DASHBOARD_TEXT = "дашборд: {url}\n"


def alert_messages(alerts: DataFrame, dashboard_url: str | None = None) -> DataFrame:
    """A message for each alerting row, with a link if one is given."""
    value = F.col("value")
    if dict(alerts.dtypes)["value"] == "double":
        shown = number_text(half_even(value, 2))
    else:
        shown = value.cast("string")
    deviation = F.coalesce(number_text(F.col("deviation_pct")), F.lit("None"))
    text = F.lit(ALERT_TEXT)
    for name, part in (("metric", F.col("metric")), ("value", shown), ("deviation", deviation)):
        text = F.replace(text, F.lit(f"{{{name}}}"), part)
    if dashboard_url:
        text = F.concat(text, F.lit(DASHBOARD_TEXT.format(url=dashboard_url)))
    return alerts.where("is_alert").select("metric", BUCKET, text.alias("message"))
