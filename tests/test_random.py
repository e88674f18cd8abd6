"""Random small logs against plain Python."""

from collections import Counter, defaultdict
from datetime import date, datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pulseboard.plans import activity, alerts, reports
from pulseboard.sources import FEED_SCHEMA, MESSAGE_SCHEMA

AS_OF = "2024-01-05"
DAY = date(2024, 1, 4)

users = st.integers(0, 5)
times = st.builds(
    lambda day, minute: datetime(2024, 1, 1) + timedelta(days=day, minutes=minute),
    st.integers(0, 5),
    st.integers(0, 24 * 60 - 1),
)
person = st.sampled_from([(0, 20, "iOS"), (1, 35, "Android"), (1, 35, "iOS"), (0, 70, "")])
feeds = st.lists(
    st.tuples(users, times, st.sampled_from(["view", "like", "hide"]), person).map(
        lambda r: (*r[:3], *r[3])
    ),
    max_size=30,
)
mails = st.lists(
    st.tuples(users, st.none() | st.integers(0, 8), times, person).map(lambda r: (*r[:3], *r[3])),
    max_size=30,
)
checks = settings(
    max_examples=15,
    deadline=None,
    derandomize=True,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)


def frames(spark, feed, mail):
    return spark.createDataFrame(feed, FEED_SCHEMA), spark.createDataFrame(mail, MESSAGE_SCHEMA)


def people(feed, mail, last=None):
    """The attributes of users in rows up to a day, or in all rows."""
    tuples = defaultdict(set)
    for time, row in [*((r[1], r) for r in feed), *((r[2], r) for r in mail)]:
        if last is None or time.date() <= last:
            tuples[row[0]].add(row[3:])
    return tuples


def message_rows(feed, mail, last=DAY):
    """(user, gender, age, os) -> received, sent, users sent to, users received from."""
    sent, received = defaultdict(list), defaultdict(list)
    for user, peer, time, *_ in mail:
        if time.date() == DAY:
            sent[user].append(peer)
            if peer is not None:
                received[peer].append(user)
    rows = {}
    for user in {*sent, *received}:
        to = [p for p in sent.get(user, []) if p is not None]
        by = received.get(user, [])
        counts = (len(by), len(to), len(set(to)), len(set(by)))
        for who in people(feed, mail, last).get(user) or {(0, 0, "")}:
            rows[user, *who] = counts
    return rows


def group(age):
    for upper, name in ((20, "0-20"), (40, "31-40")):
        if age <= upper:
            return name
    return "> 60"


@checks
@given(feed=feeds, mail=mails)
def test_activity_and_slices(spark, feed, mail):
    logs = frames(spark, feed, mail)
    expected = message_rows(feed, mail)
    found = {
        tuple(r)[1:5]: tuple(r)[5:] for r in activity.message_user_daily(*logs, AS_OF).collect()
    }
    assert found == expected
    ever = activity.message_user_daily(*logs, AS_OF, attributes="ever").collect()
    assert {tuple(r)[1:5]: tuple(r)[5:] for r in ever} == message_rows(feed, mail, last=None)

    likes, views = Counter(), Counter()
    for user, time, action, *who in feed:
        if time.date() == DAY:
            likes[user, *who] += action == "like"
            views[user, *who] += action == "view"
    slices = defaultdict(lambda: [0] * 6)
    for key in {*likes, *expected}:
        _, gender, age, os = key
        counts = (views[key], likes[key], *expected.get(key, (0, 0, 0, 0)))
        for place in (("gender", str(gender)), ("age", group(age)), ("os", os)):
            slices[place] = [a + b for a, b in zip(slices[place], counts, strict=True)]
    rows = activity.dimension_metrics(*logs, AS_OF).collect()
    assert {(r.dimension, r.dimension_value): list(r)[3:] for r in rows} == slices


@checks
@given(mail=mails)
def test_message_report(spark, mail):
    _, messages = frames(spark, [], mail)
    days = defaultdict(list)
    for user, peer, time, *_ in mail:
        if date(2023, 12, 29) <= time.date() < date(2024, 1, 5):
            days[time.date()].append((user, peer))
    expected = {}
    for day, pairs in days.items():
        senders = {u for u, _ in pairs}
        reached = [(u, p) for u, p in pairs if p is not None]
        expected[day] = (
            len(senders),
            len({p for _, p in reached}),
            len(pairs),
            round(len(reached) / len(senders)),
            round(len(set(reached)) / len(senders)),
        )
    found = {r.date: tuple(r)[1:] for r in reports.message_report(messages, AS_OF).collect()}
    assert found == expected


@checks
@given(feed=feeds, mail=mails)
def test_quarter_hours(spark, feed, mail):
    def bucket(time):
        return time.replace(minute=time.minute // 15 * 15)

    expected = {}
    for at in {bucket(r[1]) for r in feed} & {bucket(r[2]) for r in mail}:
        acted = [r for r in feed if bucket(r[1]) == at]
        wrote = [r for r in mail if bucket(r[2]) == at]
        actions = Counter(r[2] for r in acted)
        expected[at] = (
            len({r[0] for r in acted}),
            len({r[0] for r in wrote}),
            actions["like"],
            actions["view"],
            len(wrote),
        )
    rows = alerts.quarter_hour_series(*frames(spark, feed, mail)).collect()
    assert {r.quart_hour: tuple(r)[1:] for r in rows} == expected
