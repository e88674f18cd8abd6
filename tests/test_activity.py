import pytest
from datetime import date

from pyspark.sql import functions as F

from pulseboard.operators import (
    attribute_days,
    merge_attribute_days,
    merge_attributes,
    message_sides,
    user_attributes,
)
from pulseboard.plans import activity
from tests.logs import feed_log, message_log, records

AS_OF = "2024-01-31"
DAY = date(2024, 1, 30)


def test_message_sides(spark):
    log = message_log(
        spark,
        [
            (0, 1, "2024-01-30 00:00"),
            (0, 1, "2024-01-30 01:00"),
            (0, 2, "2024-01-30 02:00"),
            (1, 0, "2024-01-30 23:59:59.999999"),
            (3, None, "2024-01-30 05:00"),
        ],
    )
    # user_id, rows_sent, messages_received, messages_sent, users_sent, users_received
    assert records(message_sides(log)) == [
        (0, 3, 1, 3, 2, 1),
        (1, 1, 2, 1, 1, 1),
        (2, 0, 1, 0, 0, 1),
        (3, 1, 0, 0, 0, 0),
    ]


def test_one_pair_holding_most_rows(spark):
    rows = spark.range(30_000).select(
        F.when(F.col("id") < 20_000, 7).otherwise(F.col("id")).alias("user_id"),
        F.when(F.col("id") < 20_000, 8).otherwise(F.lit(9)).alias("reciever_id"),
    )
    found = {r.user_id: r for r in message_sides(rows).where("user_id < 10").collect()}
    assert (found[7].messages_sent, found[7].users_sent) == (20_000, 1)
    assert (found[8].messages_received, found[8].users_received) == (20_000, 1)
    assert (found[9].messages_received, found[9].users_received) == (10_000, 10_000)


def logs(spark):
    feed = feed_log(
        spark,
        [
            (0, "2024-01-30 00:00", "view", 0, 20, "iOS"),
            (0, "2024-01-30 10:00", "like", 0, 20, "iOS"),
            (0, "2024-01-30 10:00", "like", 0, 20, "Android"),
            (5, "2024-01-29 23:59:59.999999", "like", 1, 61, "iOS"),
            (6, "2024-01-31 00:00", "like", 1, 61, "iOS"),
        ],
    )
    messages = message_log(
        spark,
        [
            (1, 0, "2024-01-30 12:00", 1, 21, "iOS"),
            (1, 9, "2024-01-30 12:00", 1, 21, "iOS"),
            (5, 1, "2024-01-01 12:00", 1, 61, "iOS"),
        ],
    )
    return feed, messages


def test_feed_user_daily(spark):
    feed, _ = logs(spark)
    assert records(activity.feed_user_daily(feed, AS_OF)) == [
        (DAY, 0, 0, 20, "Android", 1, 0),
        (DAY, 0, 0, 20, "iOS", 1, 1),
    ]


def test_message_user_daily_repeats_users_with_two_tuples(spark):
    feed, messages = logs(spark)
    # ..., messages_received, messages_sent, users_sent, users_received
    assert records(activity.message_user_daily(feed, messages, AS_OF)) == [
        (DAY, 0, 0, 20, "Android", 1, 0, 0, 1),
        (DAY, 0, 0, 20, "iOS", 1, 0, 0, 1),
        (DAY, 1, 1, 21, "iOS", 0, 2, 2, 0),
        (DAY, 9, 0, 0, "", 1, 0, 0, 1),
    ]


def test_message_user_daily_latest_attributes(spark):
    feed, messages = logs(spark)
    latest = activity.message_user_daily(feed, messages, AS_OF, attributes="latest")
    assert [r[:5] for r in records(latest)] == [
        (DAY, 0, 0, 20, "iOS"),
        (DAY, 1, 1, 21, "iOS"),
        (DAY, 9, 0, 0, ""),
    ]


def test_stored_attributes_spare_the_history(spark):
    feed, messages = logs(spark)
    early = F.col("time") < F.lit("2024-01-30 09:00:00").cast("timestamp_ntz")
    stored = user_attributes(feed.where(early), messages.where(early))
    known = merge_attributes(stored, user_attributes(feed.where(~early), messages.where(~early)))
    given = activity.message_user_daily(feed, messages, AS_OF, attributes=known)
    assert records(given) == records(activity.message_user_daily(feed, messages, AS_OF))


def test_user_activity_merges_both_products(spark):
    feed, messages = logs(spark)
    # ..., likes, views, messages_received, messages_sent, users_sent, users_received
    assert records(activity.user_activity_daily(feed, messages, AS_OF)) == [
        (DAY, 0, 0, "0-20", "Android", 1, 0, 1, 0, 0, 1),
        (DAY, 0, 0, "0-20", "iOS", 1, 1, 1, 0, 0, 1),
        (DAY, 1, 1, "21-30", "iOS", 0, 0, 0, 2, 2, 0),
        (DAY, 9, 0, "0-20", "", 0, 0, 1, 0, 0, 1),
    ]


def test_sums_agree_across_dimensions_and_with_activity(spark):
    feed, messages = logs(spark)
    metrics = activity.dimension_metrics(feed, messages, AS_OF)
    total = [F.sum(m).alias(m) for m in activity.METRICS]
    by_dimension = {tuple(r)[1:] for r in metrics.groupBy("dimension").agg(*total).collect()}
    merged = activity.user_activity_daily(feed, messages, AS_OF).agg(*total).first()
    assert by_dimension == {tuple(merged)}


def test_a_month_at_once_equals_its_days(spark):
    feed, messages = logs(spark)
    month = activity.dimension_metrics(feed, messages, AS_OF, days=30)
    days = None
    for n in range(2, 32):
        day = activity.dimension_metrics(feed, messages, f"2024-01-{n:02}")
        days = day if days is None else days.union(day)
    assert records(month) == records(days)


def test_no_rows(spark):
    feed, messages = feed_log(spark, []), message_log(spark, [])
    assert activity.dimension_metrics(feed, messages, AS_OF).count() == 0


def changing(spark):
    """Somebody whose system changes on the 20th, again in February, and who writes daily."""
    feed = feed_log(
        spark,
        [
            (1, "2024-01-10 10:00", "view", 1, 30, "iOS"),
            (1, "2024-01-20 10:00", "view", 1, 30, "Android"),
            (1, "2024-02-20 10:00", "view", 1, 30, "iOS"),
            (1, "2024-02-21 10:00", "view", 1, 30, "Other"),
        ],
    )
    days = [f"2024-01-{d:02} 12:00" for d in (14, 15, 19, 20, 21)]
    return feed, message_log(spark, [(7, 1, t, 0, 40, "iOS") for t in days])


def systems(frame):
    rows = frame.where("user_id = 1").select("event_date", "os").collect()
    return sorted((r.event_date.day, r.os) for r in rows)


def test_a_backfill_does_not_read_the_future(spark):
    logs = changing(spark)
    for kind in ("all", "latest"):
        assert systems(activity.message_user_daily(*logs, "2024-01-16", attributes=kind)) == [(15, "iOS")]
    before = [log.where("time < timestamp_ntz '2024-01-22 00:00:00'") for log in logs]
    for kind in ("all", "latest"):
        for plan in (activity.message_user_daily, activity.dimension_metrics):
            assert records(plan(*logs, "2024-01-22", 30, attributes=kind)) == records(
                plan(*before, "2024-01-22", 30, attributes=kind)
            )


def test_each_day_of_a_month_has_the_attributes_of_then(spark):
    logs = changing(spark)
    month = {
        kind: activity.message_user_daily(*logs, "2024-01-31", 30, attributes=kind) for kind in ("all", "latest")
    }
    assert systems(month["latest"]) == [(14, "iOS"), (15, "iOS"), (19, "iOS"), (20, "Android"), (21, "Android")]
    assert systems(month["all"]) == [
        (14, "iOS"),
        (15, "iOS"),
        (19, "iOS"),
        (20, "Android"),
        (20, "iOS"),
        (21, "Android"),
        (21, "iOS"),
    ]
    for kind, frame in month.items():
        for day in (14, 15, 19, 20, 21):
            one = activity.message_user_daily(*logs, f"2024-01-{day + 1}", attributes=kind)
            assert records(one) == records(frame.where(f"event_date = DATE '2024-01-{day}'"))


def test_kept_tables_know_past_days(spark):
    feed, messages = changing(spark)
    early = "time < timestamp_ntz '2024-01-18 00:00:00'"
    for table, merge, kind in (
        (user_attributes, merge_attributes, "all"),
        (attribute_days, merge_attribute_days, "latest"),
    ):
        parts = [table(feed.where(w), messages.where(w)) for w in (early, f"NOT ({early})")]
        kept = merge(*parts)
        found = activity.message_user_daily(feed, messages, "2024-01-31", 30, attributes=kept)
        assert records(found) == records(activity.message_user_daily(feed, messages, "2024-01-31", 30, attributes=kind))


def test_unknown_people_may_be_labelled(spark):
    feed, messages = logs(spark)
    found = activity.dimension_metrics(feed, messages, AS_OF, unknown="label")
    ages = {r.dimension_value for r in found.where("dimension = 'age'").collect()}
    assert "unknown" in ages
    with pytest.raises(ValueError):
        activity.dimension_metrics(feed, messages, AS_OF, unknown="guess")
