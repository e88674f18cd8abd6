from datetime import date

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulseboard.operators import first_seen, merge_first_seen
from pulseboard.plans import audience, reports
from tests.logs import feed_log, message_log, records

AS_OF = "2024-01-31"


def test_likes_without_views(spark):
    feed = feed_log(spark, [(1, "2024-01-30 10:00", "like"), (2, "2024-01-30 10:00", "like")])
    assert records(reports.feed_daily(feed, AS_OF)) == [(date(2024, 1, 30), 2, 0, 2, float("inf"))]
    assert reports.feed_report(feed, AS_OF, zero="null").first()["avg_ctr"] is None


def test_feed_report_means_and_totals_differ(spark):
    feed = feed_log(
        spark,
        [(1, "2024-01-30 10:00", a) for a in ("view", "like")]
        + [(2, "2024-01-30 10:00", "view")] * 3,
    )
    # avg_likes 0.5 and avg_views 2.0 are rounded half to even
    assert records(reports.feed_report(feed, AS_OF)) == [
        (date(2024, 1, 30), 0.0, 1, 2.0, 4, 50.0, 25.0)
    ]


def test_message_report(spark):
    messages = message_log(
        spark,
        [(1, r, "2024-01-30 10:00") for r in (2, 2, 3, 4)] + [(2, 1, "2024-01-30 10:00")],
    )
    # date, senders, recievers, msg_sent, avg_msg_sent (2.5), avg_resivers_per_user (2)
    assert records(reports.message_report(messages, AS_OF)) == [
        (date(2024, 1, 30), 2, 4, 5, 2.0, 2.0)
    ]


def test_audience_counts_a_message_on_any_day(spark):
    feed = feed_log(
        spark,
        [
            (0, "2024-01-24 00:00", "view"),
            (0, "2024-01-30 23:59:59.999999", "view"),
            (1, "2024-01-24 10:00", "view"),
            (1, "2024-01-26 10:00", "view"),
            (2, "2024-01-23 23:59:59.999999", "view"),
        ],
    )
    messages = message_log(
        spark,
        [
            (0, 1, "2024-01-24 10:00"),
            (3, 1, "2024-01-25 10:00"),
            (3, 1, "2024-01-30 10:00"),
            (1, 0, "2024-01-31 00:00"),
        ],
    )
    # 01-25 has messages only, 01-26 has a feed user who never wrote
    assert records(audience.audience_daily(feed, messages, AS_OF)) == [
        (date(2024, 1, 24), 2, 1, 1),
        (date(2024, 1, 30), 1, 1, 1),
    ]


ACTIONS = st.lists(st.tuples(st.integers(0, 6), st.integers(0, 79)), max_size=40)


@settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(feed=ACTIONS, messages=ACTIONS)
def test_audience_over_many_words_of_days(spark, feed, messages):
    def time(day):
        return f"{date.fromordinal(date(2024, 1, 1).toordinal() + day)} 12:00"

    found = audience.audience_daily(
        feed_log(spark, [(u, time(d), "view") for u, d in feed]),
        message_log(spark, [(u, 1, time(d)) for u, d in messages]),
        time(80),
        days=80,
    )
    senders = {u for u, _ in messages}
    expected = []
    for day in range(80):
        here = {u for u, d in feed if d == day}
        wrote = {u for u, d in messages if d == day}
        if here & senders and wrote:
            expected.append((len(here), len(wrote), len(here & senders)))
    assert [r[1:] for r in records(found, "date")] == expected


def new_user_logs(spark):
    feed = feed_log(
        spark,
        [
            (1, "2024-01-02 10:00", "view"),
            (2, "2024-01-03 10:00", "view"),
            (3, "2023-12-01 10:00", "view"),
            (3, "2024-01-02 10:00", "view"),
            (4, "2024-01-08 00:00", "view"),
        ],
    )
    messages = message_log(
        spark,
        [
            (1, 2, "2024-01-05 10:00"),
            (3, 2, "2024-01-05 10:00"),
            (4, 2, "2024-01-06 10:00"),
        ],
    )
    return feed, messages


def test_new_users(spark):
    found = audience.new_users_daily(*new_user_logs(spark), "2024-01-08")
    # new in both only if the first feed day is in the window too; message-only days keep their date
    assert records(found) == [
        (date(2024, 1, 2), 1, 0, 0),
        (date(2024, 1, 3), 1, 0, 0),
        (date(2024, 1, 5), 0, 2, 1),
        (date(2024, 1, 6), 0, 1, 0),
    ]


def test_new_users_from_a_kept_table(spark):
    feed, messages = new_user_logs(spark)
    early = F.col("time") < F.lit("2024-01-05 00:00:00").cast("timestamp_ntz")
    stored = first_seen(feed.where(early), messages.where(early))
    seen = merge_first_seen(stored, first_seen(feed.where(~early), messages.where(~early)))
    kept = audience.new_users_daily(feed, messages, "2024-01-08", seen=seen)
    assert records(kept) == records(audience.new_users_daily(feed, messages, "2024-01-08"))


def test_app_report_takes_the_newest_day_of_each_part(spark):
    feed, messages = new_user_logs(spark)
    row = reports.app_report_latest(feed, messages, "2024-01-08").first()
    assert row.audience_date is None  # no day has both products
    assert row.new_users_date == date(2024, 1, 6)
    assert row.feed_date == date(2024, 1, 3)
    assert row.messages_date == date(2024, 1, 6)
    text = reports.app_report_text(feed, messages, "2024-01-08").first().text
    assert "ОТЧЕТ ЗА None" in text and "просмотры: 1\n" in text


def test_no_rows(spark):
    feed, messages = feed_log(spark, []), message_log(spark, [])
    for report in reports.app_reports(feed, messages, AS_OF).values():
        assert report.count() == 0
    assert reports.feed_report_text(feed, AS_OF).count() == 0
