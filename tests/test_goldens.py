"""Values of FIXTURES.md, computed independently before this package existed.

They use that file's narrower mapping of events to logs.
"""

from datetime import date

import pytest
from pyspark.sql import functions as F

from pulseboard.plans import activity, alerts, audience, reports
from pulseboard.sources import events as source

AS_OF = "2024-01-31"


@pytest.fixture(scope="module", params=["0.001", "0.01"])
def scale(request):
    return request.param


@pytest.fixture(scope="module")
def logs(spark, scale):
    events = source.events(spark, f"/root/testdata/sf{scale}")
    feed = events.where("event_type IN ('view', 'click') AND user_id % 7 <> 0")
    messages = events.where("event_type IN ('purchase', 'signup') AND user_id % 5 <> 0")
    return source.feed_rows(feed), source.message_rows(messages)


def pick(scale, small, large):
    return small if scale == "0.001" else large


def newest(report):
    return reports.newest_first(report).first().asDict()


def test_feed_daily(logs, scale):
    report = reports.feed_daily(logs[0], AS_OF)
    top = newest(report)
    assert report.count() == 7
    assert (top["date"], top["DAU"], top["views"], top["likes"]) == (
        date(2024, 1, 30),
        *pick(scale, (7, 6, 5), (75, 63, 50)),
    )


def test_activity_rows(logs, scale):
    assert activity.feed_user_daily(logs[0], AS_OF).count() == pick(scale, 7, 75)
    messages = activity.message_user_daily(*logs, AS_OF)
    assert messages.count() == pick(scale, 22, 134)
    assert messages.select("user_id").distinct().count() == pick(scale, 21, 120)
    assert messages.where("os = ''").count() == pick(scale, 11, 18)


def test_activity_sums(logs, scale):
    merged = activity.user_activity_daily(*logs, AS_OF)
    assert merged.count() == pick(scale, 24, 158)
    sums = merged.agg(*[F.sum(m) for m in activity.METRICS]).first()
    assert tuple(sums) == pick(scale, (5, 6, 13, 14, 14, 13), (50, 63, 112, 122, 122, 112))


def test_audience(logs, scale):
    top = newest(audience.audience_daily(*logs, AS_OF))
    counts = top["feed_users"], top["message_users"], top["feed_message_users"]
    assert counts == pick(scale, (7, 9, 7), (75, 69, 57))


def test_message_report(logs, scale):
    top = newest(reports.message_report(logs[1], AS_OF))
    assert (top["senders"], top["recievers"], top["msg_sent"]) == pick(
        scale, (9, 13, 13), (69, 80, 101)
    )


def test_feed_report(logs, scale):
    top = newest(reports.feed_report(logs[0], AS_OF))
    shown = tuple(top[c] for c in ("avg_likes", "sum_likes", "avg_views", "sum_views", "sum_ctr"))
    assert shown == pick(scale, (1, 5, 1, 6, 83.33), (1, 50, 1, 63, 79.37))
    assert top["avg_ctr"] == float("inf")
    top = newest(reports.feed_report(logs[0], AS_OF, zero="null"))
    assert top["avg_ctr"] == pick(scale, 37.5, 48.43)


def test_alert_replay(logs, scale):
    series = alerts.quarter_hour_series(*logs)
    assert series.count() == pick(scale, 24, 1348)
    assert alerts.quarter_hour_metrics(*logs, AS_OF).count() == pick(scale, 2, 39)
    replay = alerts.alert_replay(series).where("is_alert")
    found = dict(replay.groupBy("metric").count().collect())
    assert [found[m] for m in alerts.METRICS] == pick(scale, [1, 1, 3, 1, 1], [75, 85, 93, 98, 82])


@pytest.mark.parametrize("scale", ["0.01"], indirect=True, scope="module")
def test_new_users(logs, scale):
    report = audience.new_users_daily(*logs, "2024-01-08").orderBy("date")
    assert [tuple(r)[1:] for r in report.collect()] == [
        (75, 69, 57),
        (38, 28, 25),
        (8, 16, 16),
        (4, 4, 2),
        (3, 0, 0),
        (0, 1, 1),
        (0, 1, 1),
    ]


@pytest.mark.parametrize("scale", ["0.01"], indirect=True, scope="module")
def test_dimension_metrics(logs, scale):
    columns = "dimension dimension_value likes views messages_received messages_sent".split()
    columns += ["users_sent", "users_received"]
    found = activity.dimension_metrics(*logs, AS_OF).select(columns).collect()
    assert {tuple(r) for r in found} == {
        ("age", "0-20", 3, 7, 38, 16, 16, 38),
        ("age", "21-30", 9, 8, 11, 22, 22, 11),
        ("age", "31-40", 12, 9, 15, 18, 18, 15),
        ("age", "41-50", 12, 9, 14, 12, 12, 14),
        ("age", "51-60", 8, 9, 13, 24, 24, 13),
        ("age", "> 60", 6, 21, 21, 30, 30, 21),
        ("gender", "0", 22, 34, 76, 72, 72, 76),
        ("gender", "1", 28, 29, 36, 50, 50, 36),
        ("os", "", 0, 0, 24, 0, 0, 24),
        ("os", "Android", 23, 30, 40, 62, 62, 40),
        ("os", "iOS", 27, 33, 48, 60, 60, 48),
    }
