"""Quarter-hour metrics over unbounded logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseboard.functions import bucket_minutes, ratio
from pulseboard.operators.bands import BUCKET
from pulseboard.plans.alerts import METRICS, bucket_counts, marks, user_sums


def quarter_hour_stream(
    feed: DataFrame,
    messages: DataFrame,
    lateness: str | None = "30 minutes",
    with_ctr: bool = False,
    minutes: int = 15,
) -> DataFrame:
    """Metrics of each bucket, emitted once, when the watermark has closed it.

    Streams have no exact distinct count, so users are counted by two chained
    windowed aggregations: per bucket and user, then per bucket. Both logs go
    through them together; a bucket without rows of both products is dropped, which
    is the join of the two series. Whether the slower or the faster log closes a bucket is
    chosen where the stream is started, see :func:`pulseboard.streaming.run.start`. ``lateness=None``
    is for logs that have watermarks already.
    """
    if lateness is not None:
        feed, messages = (log.withWatermark("time", lateness) for log in (feed, messages))
    rows = marks(feed, messages, ["time", "user_id"])
    width = f"{bucket_minutes(minutes)} minutes"
    per_user = rows.groupBy(F.window("time", width), "user_id").agg(*user_sums())
    per_bucket = bucket_counts(per_user.groupBy(F.window(F.window_time("window"), width)))
    metrics = per_bucket.select(F.col("window.start").alias(BUCKET), *METRICS)
    if with_ctr:
        metrics = metrics.withColumn("ctr", ratio(F.col("likes"), F.col("views")))
    return metrics


def quarter_hour_join_stream(
    feed: DataFrame,
    messages: DataFrame,
    lateness: str = "30 minutes",
    how: str = "inner",
    minutes: int = 15,
) -> DataFrame:
    """The metrics of two logs that are streams of their own, joined by bucket.

    Each log has its own watermark and its own two aggregations; the join then holds a product's closed
    buckets until the other product's watermark has passed them, one row per bucket. ``how="inner"``
    drops buckets without rows of both products; ``"full"`` has them with NULLs for the product that lacks.
    """
    if how not in ("inner", "full"):
        raise ValueError(f"how must be 'inner' or 'full', not {how!r}")
    width = f"{bucket_minutes(minutes)} minutes"

    def buckets(log: DataFrame, per_user: list, per_bucket: list) -> DataFrame:
        users = log.withWatermark("time", lateness).groupBy(F.window("time", width), "user_id").agg(*per_user)
        return users.groupBy(F.window(F.window_time("window"), width)).agg(*per_bucket)

    acted = buckets(
        feed,
        [F.count_if(F.col("action") == a).alias(f"{a}s") for a in ("like", "view")],
        [F.count("user_id").alias("feed_users"), F.sum("likes").alias("likes"), F.sum("views").alias("views")],
    )
    wrote = buckets(
        messages,
        [F.count("*").alias("messages")],
        [
            F.count("user_id").alias("msg_users"),
            F.expr("sum(IF(user_id IS NULL, 0L, messages))").alias("messages"),
        ],
    )
    joined = acted.join(wrote, "window", how)
    return joined.select(F.col("window.start").alias(BUCKET), *METRICS)
