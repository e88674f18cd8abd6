"""Every query by name, over the events table of a data folder."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseboard.functions import history, last_days, rows_in, yesterday
from pulseboard.operators import (
    attribute_days,
    first_seen,
    merge_attribute_days,
    merge_attributes,
    merge_first_seen,
    user_attributes,
)
from pulseboard.operators.bitmaps import audience_bitmaps, read_bitmaps, write_bitmaps
from pulseboard.operators.sketches import audience_sketches
from pulseboard.plans import activity, alerts, audience, reports
from pulseboard.sources import events as source
from pulseboard.sources.kept import changed_first_seen, merged_first_seen, write_kept
from pulseboard.sources.logs import (
    FEED_SCHEMA,
    MESSAGE_SCHEMA,
    query,
    read_log,
    stream_log,
    write_log,
)
from pulseboard.sources.published import publish_dimension_metrics, read_dimension_metrics
from pulseboard.sources.scratch import new_folder, written
from pulseboard.sources.tables import (
    DIMENSION_SCHEMA,
    create_dimension_table,
    write_dimension_metrics,
)
from pulseboard.streaming import (
    BucketStore,
    alert_stream,
    few_partitions,
    quarter_hour_join_stream,
    quarter_hour_stream,
    silence_stream,
    start,
    start_corrected,
)

AS_OF = "2024-01-31"
# Everybody in the events table is first seen in its first week.
NEW_USERS_AS_OF = "2024-01-08"
MONTH = 30
# A day before attributes change; a moment inside a bucket; one with an alert on the newest bucket.
BACKFILL_AS_OF = "2024-01-16"
MIDDAY = "2024-01-30 12:07:00"
ALERT_AS_OF = "2024-01-30 12:34:00"
STREAM_STEPS = 3
# Quarter hours of a week.
WEEK = 7 * 96
SILENT_MINUTES = 45
KEPT_BUCKETS = 8

Logs = tuple[DataFrame, DataFrame]


def _logs(spark: SparkSession, sf_dir: str) -> Logs:
    events = source.events(spark, sf_dir)
    return source.feed_actions(events), source.message_actions(events)


def _feed_daily_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return query(
        spark,
        """SELECT to_date(time) AS date, count(DISTINCT user_id) AS DAU,
             count_if(action = 'view') AS views, count_if(action = 'like') AS likes,
             CASE WHEN count_if(action = 'view') > 0
                    THEN count_if(action = 'like') / count_if(action = 'view')
                  WHEN count_if(action = 'like') > 0 THEN double('inf')
                  ELSE double('nan') END AS CTR
           FROM {feed}
           WHERE time >= CAST(date_sub(:as_of, 7) AS TIMESTAMP_NTZ)
             AND time < CAST(:as_of AS TIMESTAMP_NTZ)
           GROUP BY to_date(time)""",
        args={"as_of": AS_OF},
        feed=source.feed_actions(source.events(spark, sf_dir)),
    )


def _split(spark: SparkSession, sf_dir: str, day: str) -> tuple[Logs, Logs]:
    """Both logs before and from a day on."""
    logs = _logs(spark, sf_dir)
    before = tuple(rows_in(log, history(day)) for log in logs)
    since = tuple(log.where(F.col("time") >= F.lit(day).cast("timestamp_ntz")) for log in logs)
    return before, since


def _seen(spark: SparkSession, sf_dir: str, day: str) -> tuple[Logs, DataFrame]:
    """The newer rows, and the table of first-seen days kept until ``day`` and brought up to date."""
    before, since = _split(spark, sf_dir, day)
    stored = written(first_seen(*before), "first_seen")
    return since, merge_first_seen(stored, first_seen(*since))


def _new_users_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    since, seen = _seen(spark, sf_dir, "2024-01-03")
    return audience.new_users_daily(*since, NEW_USERS_AS_OF, seen=seen)


def _new_users_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two times some days join a kept table in buckets, which is neither shuffled nor written again; what they
    change is a table of its own."""
    day, later = "2024-01-03", "2024-01-05"
    before, since = _split(spark, sf_dir, day)
    parts = ([rows_in(log, history(later)) for log in since], _split(spark, sf_dir, later)[1])
    folder = new_folder(spark, "kept")
    names = [f"kept_{folder.rsplit('-', 1)[1]}_{i}" for i in range(3)]
    try:
        write_kept(first_seen(*before), names[0], KEPT_BUCKETS, f"{folder}/0")
        for i, part in enumerate(parts):
            changed = changed_first_seen(spark.table(names[0]), first_seen(*part))
            if i:
                changed = merged_first_seen(spark.table(names[i]), changed)
            write_kept(changed, names[i + 1], KEPT_BUCKETS, f"{folder}/{i + 1}")
        seen = written(merged_first_seen(*[spark.table(n) for n in (names[0], names[-1])]), "first_seen")
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")  # the files stay, as their place was given
    return audience.new_users_daily(*since, NEW_USERS_AS_OF, seen=seen)


def _report_incremental(plan: Callable) -> Callable[[SparkSession, str], DataFrame]:
    """A report from the logs of its week and the kept table of first-seen days."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        _, seen = _seen(spark, sf_dir, "2024-01-07")
        return plan(*_logs(spark, sf_dir), NEW_USERS_AS_OF, seen=seen)

    return run


def _incremental(plan: Callable, table: Callable, merge: Callable) -> Callable[[SparkSession, str], DataFrame]:
    """A daily job from the newest day's rows and a kept table of what is known about people."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        before, since = _split(spark, sf_dir, "2024-01-30")
        known = merge(written(table(*before), "attributes"), table(*since))
        return plan(*since, AS_OF, attributes=known)

    return run


def _dimension_metrics_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written twice, as by a repeated run; the rows are those of one run."""
    path = new_folder(spark, "dimension_metrics")
    table = path.rsplit("/", 1)[1].replace("-", "_")
    metrics = activity.dimension_metrics(*_logs(spark, sf_dir), AS_OF)
    columns = metrics.columns
    create_dimension_table(spark, table, path)
    try:
        for _ in range(2):
            write_dimension_metrics(metrics, table, days=[yesterday(AS_OF).first_day])
    finally:
        spark.sql(f"DROP TABLE {table}")  # the files stay, as their place was given
    return spark.read.schema(DIMENSION_SCHEMA).parquet(path).select(columns)


def _dimension_metrics_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month published at once, over a first half that had other rows and a repeated run."""
    root = new_folder(spark, "published")
    logs = _logs(spark, sf_dir)
    days = [date.fromisoformat(AS_OF) - timedelta(days=n) for n in range(1, MONTH + 1)]
    older = activity.dimension_metrics(*logs, BACKFILL_AS_OF, MONTH // 2, dimensions=["os"])
    publish_dimension_metrics(older, root)
    metrics = activity.dimension_metrics(*logs, AS_OF, MONTH)
    for _ in range(2):
        publish_dimension_metrics(metrics, root, days)
    return read_dimension_metrics(spark, root).select(metrics.columns)


def _from_bitmaps(plan: Callable, *args, by: tuple[str, ...] = ()) -> Callable[[SparkSession, str], DataFrame]:
    """A query over kept bitmaps of active users, written and read again."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = new_folder(spark, "bitmaps")
        write_bitmaps(audience_bitmaps(*_logs(spark, sf_dir), by=by), path)
        return plan(read_bitmaps(spark, path, [T.StructField(c, T.StringType()) for c in by]), *args)

    return run


def _audience_estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact counts, and whether the estimates are within their bounds of them."""
    logs = _logs(spark, sf_dir)
    told = audience.audience_estimates(written(audience_sketches(*logs), "sketches"), AS_OF, MONTH)
    exact = audience.audience_exact(*logs, AS_OF, MONTH)
    joined = told.alias("t").join(exact.alias("e"), "date")
    kinds = ("feed", "message", "both")
    within = [
        (F.abs(F.col(f"t.{k}_users") - F.col(f"e.{k}_users")) <= F.col(f"{k}_error")).alias(f"{k}_within")
        for k in kinds
    ]
    return joined.select("date", *[f"e.{k}_users" for k in kinds], *within)


def _day_files(spark: SparkSession, sf_dir: str, steps: int) -> tuple[str, str, int]:
    """Both logs laid out by day and written in ``steps`` parts, in the order of their days, from
    the first day of either to the last; and the days of a part."""
    folder = new_folder(spark, "logs")
    logs = dict(zip(("feed", "messages"), _logs(spark, sf_dir), strict=True))
    ends = [F.min("time").alias("first"), F.max("time").alias("last")]
    feed, messages = (log.agg(*ends) for log in logs.values())
    first, last = feed.union(messages).agg(F.to_date(F.min("first")), F.to_date(F.max("last"))).first()
    size = -(-((last - first).days + 1) // steps) if first else 1
    for step in range(steps):
        begin = (first or date.fromisoformat(AS_OF)) + timedelta(days=step * size)
        span = last_days(begin + timedelta(days=size), size)
        for name, log in logs.items():
            write_log(rows_in(log, span), f"{folder}/{name}")
    return f"{folder}/feed", f"{folder}/messages", size


def _stored(plan: Callable, *args) -> Callable[[SparkSession, str], DataFrame]:
    """A query over logs that were written and read again, laid out by day."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        feed, messages, _ = _day_files(spark, sf_dir, 1)
        return plan(read_log(spark, feed, FEED_SCHEMA), read_log(spark, messages, MESSAGE_SCHEMA), *args)

    return run


def _run_stream(spark: SparkSession, stream: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    folder = folder or new_folder(spark, name)
    partitions = few_partitions(spark)
    start(stream, f"{folder}/rows", f"{folder}/checkpoint", partitions=partitions).awaitTermination()
    rows = spark.read.schema(stream.schema).parquet(f"{folder}/rows")
    times = [c for c, kind in rows.dtypes if kind == "timestamp"]
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times})


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics from day files, some days at a time, so that state is carried from step to step."""
    feed, messages, days = _day_files(spark, sf_dir, STREAM_STEPS)
    return quarter_hour_stream(
        stream_log(spark, feed, FEED_SCHEMA, days), stream_log(spark, messages, MESSAGE_SCHEMA, days)
    )


def _join_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams, one per log, joined by bucket."""
    feed, messages, days = _day_files(spark, sf_dir, STREAM_STEPS)
    joined = quarter_hour_join_stream(
        stream_log(spark, feed, FEED_SCHEMA, days), stream_log(spark, messages, MESSAGE_SCHEMA, days)
    )
    return _run_stream(spark, joined, "joined")


def _silence_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed, messages, days = _day_files(spark, sf_dir, STREAM_STEPS)
    logs = stream_log(spark, feed, FEED_SCHEMA, days), stream_log(spark, messages, MESSAGE_SCHEMA, days)
    return _run_stream(spark, silence_stream(*logs, SILENT_MINUTES), "silence")


def _replayed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last two days that the stream has read are written again before it goes on."""
    folder = new_folder(spark, "replayed")
    logs = dict(zip(("feed", "messages"), _logs(spark, sf_dir), strict=True))
    paths = {name: f"{folder}/{name}" for name in logs}
    last = max(log.agg(F.to_date(F.max("time"))).first()[0] or date.fromisoformat(AS_OF) for log in logs.values())
    for days in (history(last - timedelta(days=10)), last_days(last + timedelta(days=1), 13)):
        for name, log in logs.items():
            write_log(rows_in(log, days), paths[name], ranked=True)
        streams = (
            stream_log(spark, paths[name], schema, replayed_within="30 minutes")
            for name, schema in (("feed", FEED_SCHEMA), ("messages", MESSAGE_SCHEMA))
        )
        rows = _run_stream(spark, quarter_hour_stream(*streams, lateness=None), "replayed", folder)
    return rows


def _arrivals(spark: SparkSession, sf_dir: str, steps: int) -> tuple[str, str]:
    """Both logs in the order in which rows arrive, up to two days after their time."""
    folder = new_folder(spark, "arrivals")
    for name, log in zip(("feed", "messages"), _logs(spark, sf_dir), strict=True):
        delay = F.expr("CAST(pmod(xxhash64(user_id, time), 3) AS INT)")
        log = written(log.withColumn("arrival", F.date_add(F.to_date("time"), delay)), "arrivals")
        first, last = log.agg(F.min("arrival"), F.max("arrival")).first()
        size = -(-((last - first).days + 1) // steps) if first else 1
        for step in range(steps):
            begin = F.date_add(F.lit(first).cast("date"), step * size)
            part = log.where((F.col("arrival") >= begin) & (F.col("arrival") < F.date_add(begin, size)))
            part.drop("arrival").coalesce(1).write.mode("append").parquet(f"{folder}/{name}")
    return f"{folder}/feed", f"{folder}/messages"


def _corrected_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows count, although they come up to two days after their time."""
    feed, messages = _arrivals(spark, sf_dir, STREAM_STEPS)
    folder = new_folder(spark, "corrected")
    store = BucketStore(f"{folder}/store", lateness="3 days")
    logs = stream_log(spark, feed, FEED_SCHEMA, 1), stream_log(spark, messages, MESSAGE_SCHEMA, 1)
    start_corrected(*logs, store, f"{folder}/checkpoint").awaitTermination()
    rows = store.metrics(spark, with_ctr=True)
    return rows.withColumn("quart_hour", F.col("quart_hour").cast("timestamp_ntz"))


def _feed(plan: Callable, *args, **options) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: plan(
        source.feed_actions(source.events(spark, sf_dir)), *args, **options
    )


def _messages(plan: Callable, *args, **options) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: plan(
        source.message_actions(source.events(spark, sf_dir)), *args, **options
    )


def _both(plan: Callable, *args, **options) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: plan(*_logs(spark, sf_dir), *args, **options)


def _live(plan: Callable, as_of: str = AS_OF) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: plan(
        alerts.quarter_hour_metrics(*_logs(spark, sf_dir), as_of)
    )


def _replay(
    by: tuple[str, ...] = (), plan: Callable = alerts.alert_replay, **options
) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        metrics = alerts.quarter_hour_series(*_logs(spark, sf_dir), by=by)
        return plan(metrics, by=by, **options)

    return run


def catalog() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "feed_daily": _feed(reports.feed_daily, AS_OF),
        "feed_daily_sql": _feed_daily_sql,
        "feed_daily_month": _feed(reports.feed_daily, AS_OF, MONTH),
        "audience_daily": _both(audience.audience_daily, AS_OF),
        "audience_from_bitmaps": _from_bitmaps(audience.active_users, AS_OF),
        "audience_from_bitmaps_by_os": _from_bitmaps(
            audience.active_users, AS_OF, (1, 7, 30), ("os",), by=("os",)
        ),
        "audience_daily_from_bitmaps": _from_bitmaps(audience.audience_daily_kept, AS_OF, MONTH),
        "audience_estimates": _audience_estimates,
        "audience_month": _both(audience.audience_daily, AS_OF, MONTH),
        "feed_report": _feed(reports.feed_report, AS_OF),
        "feed_report_null_ctr": _feed(reports.feed_report, AS_OF, zero="null"),
        "feed_report_month": _feed(reports.feed_report, AS_OF, MONTH),
        "message_report_month": _messages(reports.message_report, AS_OF, MONTH),
        "message_report": _messages(reports.message_report, AS_OF),
        "new_users_daily": _both(audience.new_users_daily, NEW_USERS_AS_OF),
        "new_users_month": _both(audience.new_users_daily, AS_OF, MONTH),
        "new_users_incremental": _new_users_incremental,
        "new_users_bucketed": _new_users_bucketed,
        "feed_user_daily": _feed(activity.feed_user_daily, AS_OF),
        "message_user_daily": _both(activity.message_user_daily, AS_OF),
        "message_user_ever": _both(
            activity.message_user_daily, BACKFILL_AS_OF, attributes="ever"
        ),
        "message_user_latest": _both(activity.message_user_daily, AS_OF, attributes="latest"),
        "message_user_incremental": _incremental(
            activity.message_user_daily, user_attributes, merge_attributes
        ),
        "message_user_latest_incremental": _incremental(
            activity.message_user_daily, attribute_days, merge_attribute_days
        ),
        "message_user_latest_month": _both(
            activity.message_user_daily, AS_OF, MONTH, attributes="latest"
        ),
        "message_user_backfill": _both(activity.message_user_daily, BACKFILL_AS_OF),
        "message_user_backfill_latest": _both(
            activity.message_user_daily, BACKFILL_AS_OF, attributes="latest"
        ),
        "user_activity_incremental": _incremental(
            activity.user_activity_daily, user_attributes, merge_attributes
        ),
        "dimension_metrics_incremental": _incremental(
            activity.dimension_metrics, user_attributes, merge_attributes
        ),
        "dimension_metrics_backfill": _both(activity.dimension_metrics, BACKFILL_AS_OF),
        "dimension_metrics_unknown": _both(activity.dimension_metrics, AS_OF, unknown="label"),
        "report_series_incremental": _report_incremental(reports.report_series),
        "app_report_text_incremental": _report_incremental(reports.app_report_text),
        "feed_daily_newest": lambda spark, sf_dir: reports.newest_first(
            _feed(reports.feed_daily, AS_OF)(spark, sf_dir)
        ),
        "audience_stored": _stored(audience.audience_daily, AS_OF),
        "quarter_hour_metrics_midday": _live(lambda metrics: metrics, MIDDAY),
        "alert_latest_midday": _live(alerts.alert_latest, MIDDAY),
        "alert_messages_latest": _live(
            lambda metrics: alerts.alert_messages(alerts.alert_latest(metrics)), ALERT_AS_OF
        ),
        "user_activity_daily": _both(activity.user_activity_daily, AS_OF),
        "slice_gender": _both(activity.dimension_metrics, AS_OF, dimensions=["gender"]),
        "slice_age": _both(activity.dimension_metrics, AS_OF, dimensions=["age"]),
        "slice_os": _both(activity.dimension_metrics, AS_OF, dimensions=["os"]),
        "dimension_metrics": _both(activity.dimension_metrics, AS_OF),
        "dimension_metrics_month": _both(activity.dimension_metrics, AS_OF, MONTH),
        "dimension_metrics_sink": _dimension_metrics_sink,
        "dimension_metrics_published": _dimension_metrics_published,
        "quarter_hour_metrics": _live(lambda metrics: metrics),
        "quarter_hour_history": _both(alerts.quarter_hour_series, with_ctr=True),
        "metric_bands": _live(alerts.metric_bands),
        "alert_latest": _live(alerts.alert_latest),
        "alert_replay": _replay(),
        "alert_replay_by_os": _replay(by=("os",)),
        "alert_replay_week": _replay(sample_size=WEEK),
        "metric_bands_week": _replay(plan=alerts.metric_bands, sample_size=WEEK),
        "alert_messages": lambda spark, sf_dir: alerts.alert_messages(_replay()(spark, sf_dir)),
        "report_series": _both(reports.report_series, NEW_USERS_AS_OF),
        "app_report_latest": _both(reports.app_report_latest, NEW_USERS_AS_OF),
        "feed_report_text": _feed(reports.feed_report_text, AS_OF),
        "app_report_text": _both(reports.app_report_text, NEW_USERS_AS_OF),
        "quarter_hour_stream": lambda spark, sf_dir: _run_stream(
            spark, _stream(spark, sf_dir), "quarter_hours"
        ),
        "quarter_hour_join_stream": _join_stream,
        "quarter_hour_corrected_stream": _corrected_stream,
        "quarter_hour_replayed_stream": _replayed_stream,
        "silence_stream": _silence_stream,
        "alert_stream": lambda spark, sf_dir: _run_stream(
            spark, alert_stream(_stream(spark, sf_dir)), "alerts"
        ),
    }
