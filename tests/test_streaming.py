from pyspark.sql import functions as F

from pulseboard import catalog
from pulseboard.functions import last_days, rows_in
from pulseboard.plans import alerts
from pulseboard.session import settings
from pulseboard.sources import FEED_SCHEMA, MESSAGE_SCHEMA, stream_log, write_log
from pulseboard.sources import events as source
from pulseboard.streaming import alert_stream, few_partitions, quarter_hour_stream, start
from tests.logs import feed_log, message_log

SF_DIR = "/root/testdata/sf0.01"


def streams(spark, root):
    return (
        stream_log(spark, f"{root}/feed", FEED_SCHEMA),
        stream_log(spark, f"{root}/messages", MESSAGE_SCHEMA),
    )


def run(stream, root, name):
    start(stream, f"{root}/{name}", f"{root}/{name}-checkpoint").awaitTermination()
    rows = stream.sparkSession.read.schema(stream.schema).parquet(f"{root}/{name}")
    return rows.withColumn("quart_hour", F.col("quart_hour").cast("timestamp_ntz"))


def add(root, feed, messages):
    """New files of both logs, next to the present ones."""
    for log, name in ((feed, "feed"), (messages, "messages")):
        dated = log.withColumn("log_day", F.to_date("time"))
        dated.coalesce(1).write.mode("append").partitionBy("log_day").parquet(f"{root}/{name}")


def sentinels(spark):
    """A row of each log a day later, which closes all buckets before it."""
    return (
        feed_log(spark, [(1, "2024-02-01 00:00", "view")]),
        message_log(spark, [(1, 2, "2024-02-01 00:00")]),
    )


def test_batch_parity_over_several_runs(spark, tmp_path):
    """Half a month per run: state carries over, and the result equals one batch over all."""
    root = str(tmp_path)
    events = source.events(spark, SF_DIR)
    logs = source.feed_actions(events), source.message_actions(events)
    middle = F.col("time") < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    for part in (
        [log.where(middle) for log in logs],
        [log.where(~middle) for log in logs],
        sentinels(spark),
    ):
        add(root, *part)
        found = run(alert_stream(quarter_hour_stream(*streams(spark, root))), root, "alerts")
    expected = alerts.alert_replay(alerts.quarter_hour_series(*logs))
    assert expected.count() > 1000
    assert found.exceptAll(expected).count() == expected.exceptAll(found).count() == 0


def test_alerts_from_stored_metrics(spark, tmp_path):
    """A second, small stream may take the metrics from the files of the first."""
    root = str(tmp_path)
    events = source.stream_events(spark, SF_DIR)
    metrics = quarter_hour_stream(source.feed_actions(events), source.message_actions(events))
    closed = run(metrics, root, "metrics")
    stored = spark.readStream.schema(metrics.schema).parquet(f"{root}/metrics")
    found = run(alert_stream(stored), root, "alerts")
    expected = alerts.alert_replay(closed)
    assert expected.count() > 1000
    assert found.exceptAll(expected).count() == expected.exceptAll(found).count() == 0


def test_alerts_on_rates(spark, tmp_path):
    """With the rate among the metrics all values are floats, some of them infinite."""
    names = (*alerts.METRICS, "ctr")
    logs = [source.feed_actions, source.message_actions]
    events = source.stream_events(spark, SF_DIR)
    stream = quarter_hour_stream(*[log(events) for log in logs], with_ctr=True)
    found = run(alert_stream(stream, names), str(tmp_path), "alerts")
    events = source.events(spark, SF_DIR)
    series = alerts.quarter_hour_series(*[log(events) for log in logs], with_ctr=True)
    expected = alerts.alert_replay(series, names)

    def compared(frame):
        near = [F.round(c, 9).alias(c) for c in ("value", "low", "up", "deviation_pct")]
        closed = frame.where("quart_hour < timestamp_ntz '2024-01-30 23:00:00'")
        return closed.select("metric", "quart_hour", "is_alert", *near)

    found, expected = compared(found), compared(expected)
    assert expected.where("metric = 'ctr' AND value = double('inf')").count() > 0
    assert expected.where("metric = 'ctr' AND is_alert").count() > 0
    assert found.exceptAll(expected).count() == expected.exceptAll(found).count() == 0


def rows_by_bucket(frame):
    return {r.quart_hour.strftime("%d %H:%M"): tuple(r)[1:] for r in frame.collect()}


def test_late_rows_count_within_the_lateness_only(spark, tmp_path):
    root = str(tmp_path)

    def day(time, user):
        return (
            feed_log(spark, [(user, f"2024-01-30 {time}", "view")]),
            message_log(spark, [(user, 5, f"2024-01-30 {time}")]),
        )

    def step(*parts):
        for part in parts:
            add(root, *part)
        return rows_by_bucket(run(quarter_hour_stream(*streams(spark, root)), root, "metrics"))

    # buckets stay open until the watermark, half an hour behind, passes their end
    assert step(day("10:00", 1), day("10:20", 1)) == {}
    assert step(day("10:01", 2)) == {}  # late, within the lateness
    # feed_users, msg_users, likes, views, messages
    assert step(day("10:50", 1)) == {"30 10:00": (2, 2, 0, 2, 2)}
    assert step(day("10:02", 3)) == {"30 10:00": (2, 2, 0, 2, 2)}  # beyond it
    closed = step(sentinels(spark))
    assert closed == {
        "30 10:00": (2, 2, 0, 2, 2),
        "30 10:15": (1, 1, 0, 1, 1),
        "30 10:45": (1, 1, 0, 1, 1),
    }


def test_a_bucket_needs_both_products(spark, tmp_path):
    root = str(tmp_path)
    add(
        root,
        feed_log(spark, [(1, "2024-01-30 10:00", "like"), (1, "2024-01-30 11:00", "like")]),
        message_log(spark, [(1, 2, "2024-01-30 11:05"), (1, 2, "2024-01-30 12:00")]),
    )
    add(root, *sentinels(spark))
    metrics = quarter_hour_stream(*streams(spark, root), with_ctr=True)
    assert rows_by_bucket(run(metrics, root, "metrics")) == {
        "30 11:00": (1, 1, 1, 0, 1, float("inf"))
    }


def test_session_settings_are_left_as_they_were(spark, tmp_path):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    root = str(tmp_path)
    add(root, *sentinels(spark))
    run(quarter_hour_stream(*streams(spark, root)), root, "metrics")
    assert spark.conf.get(key) == before


def test_periodic_trigger(spark, tmp_path):
    root = str(tmp_path)
    add(root, *sentinels(spark))
    metrics = quarter_hour_stream(*streams(spark, root))
    query = start(metrics, f"{root}/out", f"{root}/checkpoint", every="1 second")
    try:
        query.processAllAvailable()
        assert query.isActive and query.lastProgress["batchId"] >= 0
    finally:
        query.stop()


def silent_messenger(spark, root, days):
    """A message on the first day, feed rows every quarter hour of all days, a file per day and log."""
    write_log(message_log(spark, [(1, 2, "2024-01-01 00:05")]), f"{root}/messages")
    for day in range(1, days + 1):
        times = [f"2024-01-{day:02} {h:02}:{m:02}" for h in range(24) for m in (0, 15, 30, 45)]
        write_log(feed_log(spark, [(u, t, "view") for t in times for u in (1, 2)]), f"{root}/feed")


def progress(spark, root, close_by):
    feed = stream_log(spark, f"{root}/feed", FEED_SCHEMA, 1)
    messages = stream_log(spark, f"{root}/messages", MESSAGE_SCHEMA, 1)
    query = start(
        quarter_hour_stream(feed, messages), f"{root}/{close_by}", f"{root}/{close_by}-state", close_by=close_by
    )
    query.awaitTermination()
    state = [sum(op["numRowsTotal"] for op in p["stateOperators"]) for p in query.recentProgress]
    return state, spark.read.parquet(f"{root}/{close_by}").count()


def test_a_silent_log(spark, tmp_path):
    """By the faster log the stream goes on with bounded state; by the slower one it waits."""
    root = str(tmp_path)
    silent_messenger(spark, root, 4)
    state, emitted = progress(spark, root, "faster")
    assert emitted == 1  # the one bucket with rows of both
    assert max(state) < 2.5 * 192
    state, emitted = progress(spark, root, "slower")
    assert emitted == 0
    assert state[-1] > 3.5 * 192


def test_state_of_a_backfill_is_that_of_a_few_days(spark, tmp_path):
    root = str(tmp_path)
    events = source.events(spark, SF_DIR)
    for day in range(1, 31):
        span = last_days(f"2024-01-{day + 1:02}" if day < 31 else "2024-02-01", 1)
        write_log(rows_in(source.feed_actions(events), span), f"{root}/feed")
        write_log(rows_in(source.message_actions(events), span), f"{root}/messages")
    state, emitted = progress(spark, root, "slower")
    assert emitted > 1000
    assert max(state) < 0.15 * events.count()


def test_stream_queries_read_days_beyond_january(spark, tmp_path):
    """The whole log is taken in, whatever its days."""
    from pulseboard import catalog

    events = spark.read.parquet(f"{SF_DIR}/events.parquet").where("day(ts) >= 20")
    moved = events.withColumn("ts", F.col("ts") + F.expr("INTERVAL 25 DAYS"))
    moved.write.parquet(f"{tmp_path}/events.parquet")
    found = catalog.catalog()["quarter_hour_stream"](spark, str(tmp_path))
    whole = catalog.catalog()["quarter_hour_history"](spark, str(tmp_path)).drop("ctr")
    newest = whole.agg(F.max("quart_hour")).first()[0]
    assert str(newest) > "2024-02-20"
    closed = whole.where(F.col("quart_hour") < F.lit(newest) - F.expr("INTERVAL 2 HOURS"))
    assert closed.count() > 100
    assert closed.exceptAll(found).count() == 0
    assert found.exceptAll(whole).count() == 0


def test_stores_follow_the_cores_not_the_shuffle_partitions(spark, tmp_path):
    root, cores = str(tmp_path), spark.sparkContext.defaultParallelism
    add(root, *sentinels(spark))
    with settings(spark, {"spark.sql.shuffle.partitions": "40"}):
        catalog._run_stream(spark, quarter_hour_stream(*streams(spark, root)), "metrics", root)
        assert few_partitions(spark) == min(40, 2 * cores)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "40"
    stores = [p.name for p in (tmp_path / "checkpoint/state/0").iterdir() if p.name.isdigit()]
    assert len(stores) == min(40, 2 * cores)
    with settings(spark, {"spark.sql.shuffle.partitions": "3"}):
        assert few_partitions(spark) == 3
