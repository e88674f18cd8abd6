"""Kept bitmaps and sketches of active users, and metrics published many days at once."""

from collections import defaultdict
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseboard.operators.bitmaps import audience_bitmaps, read_bitmaps, write_bitmaps
from pulseboard.operators.sketches import audience_sketches
from pulseboard.plans import activity, audience
from pulseboard.sources import kept, published
from pulseboard.sources.published import publish_dimension_metrics, read_dimension_metrics, vacuum
from pulseboard.sources import events as source
from tests.logs import feed_log, message_log, records

SF_DIR = "/root/testdata/sf0.01"
AS_OF = "2024-01-31"
IDS = [0, 1, -1, 32768, 32769, -32768, 10**12, -(10**12), 2**62]


def odd_logs(spark):
    feed = [(u, f"2024-01-{25 + i % 6} 10:00", "view", 1, 30, "iOS") for i, u in enumerate(IDS * 4)]
    feed += [(None, "2024-01-30 10:00", "view", 1, 30, "iOS")]
    mail = [(u, 5, f"2024-01-{26 + i % 5} 10:00", 1, 30, "Android") for i, u in enumerate(IDS[::2] * 3)]
    return feed_log(spark, feed), message_log(spark, mail)


def kept_bitmaps(spark, logs, path, by=()):
    write_bitmaps(audience_bitmaps(*logs, by=by), path)
    return read_bitmaps(spark, path, [T.StructField(c, T.StringType()) for c in by])


def test_spans_of_any_ids(spark, tmp_path):
    logs = odd_logs(spark)
    acted = defaultdict(set)
    for kind, log in zip(("feed", "message"), logs, strict=True):
        for r in log.collect():
            if r.user_id is not None:
                acted[kind, r.time.date()].add(r.user_id)
    found = {r.days: tuple(r)[1:] for r in audience.active_users(kept_bitmaps(spark, logs, str(tmp_path)), AS_OF, (1, 3, 30)).collect()}
    for days in (1, 3, 30):
        span = [date(2024, 1, 31) - timedelta(days=n) for n in range(1, days + 1)]
        feed, mail = (set().union(*[acted[k, d] for d in span]) for k in ("feed", "message"))
        assert found[days] == (len(feed), len(mail), len(feed & mail), len(feed | mail))


def test_daily_audience_equals_the_logs(spark, tmp_path):
    events = source.events(spark, SF_DIR)
    for logs in (odd_logs(spark), (source.feed_actions(events), source.message_actions(events))):
        path = str(tmp_path / str(len(logs[0].head(3))) / str(id(logs)))
        for days in (1, 7, 30):
            told = audience.audience_daily_kept(kept_bitmaps(spark, logs, path), AS_OF, days)
            assert records(told) == records(audience.audience_daily(*logs, AS_OF, days))


def test_a_day_is_replaced_and_no_log_is_read(spark, tmp_path, capsys):
    path = str(tmp_path / "bitmaps")
    feed, mail = odd_logs(spark)
    kept_bitmaps(spark, (feed, mail), path)
    more = feed_log(spark, [(u, "2024-01-30 11:00", "view") for u in range(100)])
    bitmaps = kept_bitmaps(spark, (more, message_log(spark, [])), path)
    told = audience.active_users(bitmaps, AS_OF, (1, 2))
    assert [r.feed_users for r in told.orderBy("days").collect()] == [100, 100 + len({r.user_id for r in feed.where("day(time) = 29").collect()} - set(range(100)))]
    told.explain()
    plan = capsys.readouterr().out
    assert plan.count("FileScan") == 1 and "PartitionFilters: [" in plan and "PushedFilters: []" in plan


def test_hot_users_and_days_come_as_one_row_per_task(spark):
    """A hundred thousand rows of one day leave each task as one bitmap."""
    rows = spark.range(0, 100_000, numPartitions=4).select(
        (F.col("id") % 1000).alias("user_id"), F.lit("2024-01-30 10:00").cast("timestamp_ntz").alias("time"),
        F.lit("view").alias("action"), F.lit(1).alias("gender"), F.lit(30).alias("age"), F.lit("iOS").alias("os"),
    )
    found = audience_bitmaps(rows, message_log(spark, []))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "partial_bitmap_construct_agg" in plan
    assert sorted(r.n for r in found.select(F.bitmap_count("users").alias("n")).collect()) == [1, 999]  # 0 is a bucket's last


@pytest.mark.parametrize("lg_size", [5, 8, 12])
def test_estimates_stay_within_their_bounds(spark, lg_size):
    n = 6000
    feed = spark.range(n).selectExpr(
        "id * 7919 - 3000 AS user_id", "timestamp_ntz '2024-01-29' + make_dt_interval(id % 2, id % 24) AS time",
        "'view' AS action", "1 AS gender", "30 AS age", "'iOS' AS os",
    )
    mail = feed.where("user_id % 3 = 0").selectExpr("user_id", "1L AS reciever_id", "time", "gender", "age", "os")
    sketches = audience_sketches(feed, mail, lg_size)
    told = audience.audience_estimates(sketches, AS_OF, 7, lg_size).collect()
    exact = {r.date: r for r in audience.audience_exact(feed, mail, AS_OF, 7).collect()}
    assert len(told) == len(exact) == 2
    for r in told:
        for kind in ("feed", "message", "both"):
            assert abs(r[f"{kind}_users"] - exact[r.date][f"{kind}_users"]) <= r[f"{kind}_error"]
        assert (r.feed_error == 0) == (r.feed_users <= 2**lg_size)


def month(spark, users=3, days=(27, 28, 29, 30)):
    feed = feed_log(spark, [(u, f"2024-01-{d:02d} 10:00", "view") for u in range(users) for d in days])
    return activity.dimension_metrics(feed, message_log(spark, []), AS_OF, 30)


def views(frame):
    return [(str(d), v) for d, v in records(frame.where("dimension = 'os'").select("event_date", "views"))]


def test_days_are_replaced_at_once_and_others_stay(spark, tmp_path):
    root = str(tmp_path)
    assert read_dimension_metrics(spark, root).collect() == []
    assert publish_dimension_metrics(month(spark), root) == 1
    assert publish_dimension_metrics(month(spark, 5, (29, 30)), root) == 2
    assert views(read_dimension_metrics(spark, root)) == [("2024-01-27", 3), ("2024-01-28", 3), ("2024-01-29", 5), ("2024-01-30", 5)]
    assert views(read_dimension_metrics(spark, root, [date(2024, 1, 30), date(2023, 1, 1)])) == [("2024-01-30", 5)]
    # Given days without rows are cleared; rows of days that are not given are refused.
    publish_dimension_metrics(month(spark, 1, (30,)), root, [date(2024, 1, d) for d in (28, 29, 30)])
    assert views(read_dimension_metrics(spark, root)) == [("2024-01-27", 3), ("2024-01-30", 1)]
    with pytest.raises(ValueError):
        publish_dimension_metrics(month(spark), root, [date(2024, 1, 30)])
    assert views(read_dimension_metrics(spark, root)) == [("2024-01-27", 3), ("2024-01-30", 1)]


def test_a_failure_leaves_the_old_rows_and_readers_their_version(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    publish_dimension_metrics(month(spark), root)
    reader = read_dimension_metrics(spark, root)
    before = views(reader)
    claim = published._Store.claim

    def lost(self, name, text):
        raise OSError("lost")

    monkeypatch.setattr(published._Store, "claim", lost)
    with pytest.raises(OSError):
        publish_dimension_metrics(month(spark, 9), root)
    assert views(read_dimension_metrics(spark, root)) == before
    monkeypatch.setattr(published._Store, "claim", claim)
    publish_dimension_metrics(month(spark, 9), root)
    assert views(reader) == before  # one who began before still reads what was there
    assert views(read_dimension_metrics(spark, root)) == [(d, 9) for d, _ in before]
    assert len(vacuum(spark, root)) == 2
    assert views(read_dimension_metrics(spark, root)) == [(d, 9) for d, _ in before]
    assert vacuum(spark, root) == []


def test_two_writers_at_once(spark, tmp_path, monkeypatch):
    """Another writer takes the manifest's name first; the second builds on its manifest."""
    root = str(tmp_path)
    publish_dimension_metrics(month(spark, 3, (27, 28)), root)
    claim = published._Store.claim
    calls = []

    def raced(self, name, text):
        calls.append(name)
        if len(calls) == 1:
            publish_dimension_metrics(month(spark, 4, (28,)), root)
        return claim(self, name, text)

    monkeypatch.setattr(published._Store, "claim", raced)
    publish_dimension_metrics(month(spark, 7, (27, 30)), root)
    assert len(calls) == 3
    assert views(read_dimension_metrics(spark, root)) == [("2024-01-27", 7), ("2024-01-28", 4), ("2024-01-30", 7)]


def test_one_job_writes_all_days(spark, tmp_path):
    """One write of a month, whatever its days."""
    group = "publish-month"
    spark.sparkContext.setJobGroup(group, "publish")
    try:
        publish_dimension_metrics(month(spark, 3, range(1, 31)), str(tmp_path))
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(views(read_dimension_metrics(spark, str(tmp_path)))) == 30
    assert jobs <= 8  # the stages of one adaptive query, not thirty


def first_days(spark, rows):
    return spark.createDataFrame(rows, "user_id long, feed_first date, msg_first date")


def test_a_day_joins_the_kept_table_where_it_is(spark, tmp_path, request):
    names = [f"kept_{abs(hash(str(tmp_path)))}_{i}" for i in range(3)]
    request.addfinalizer(lambda: [spark.sql(f"DROP TABLE IF EXISTS {n}") for n in names])
    d = [date(2024, 1, n) for n in range(1, 9)]
    old = [(u, d[u % 4], None) for u in range(500)] + [(None, d[0], d[0])]
    new = [(u, d[5], d[6]) for u in range(490, 520)] + [(3, None, d[1]), (None, d[7], None)]
    kept.write_kept(first_days(spark, old), names[0], 4, str(tmp_path / "0"))
    merged = kept.keep_first_seen(spark, names[0], first_days(spark, new), names[1], str(tmp_path / "1"))
    expected = {u: (f, m) for u, f, m in old if u is not None}
    for u, f, m in new:
        if u is not None:
            had = expected.get(u, (None, None))
            expected[u] = tuple(min((x for x in pair if x), default=None) for pair in zip(had, (f, m), strict=True))
    assert {r.user_id: (r.feed_first, r.msg_first) for r in merged.collect()} == expected
    assert len(merged.inputFiles()) == 4  # one file per bucket
    # What changes is few rows; with these in buckets of their own nothing is shuffled.
    base = spark.table(names[0])
    changed = kept.changed_first_seen(base, first_days(spark, new))
    plan = changed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert sorted(r.user_id for r in changed.collect()) == [3, *range(490, 520)]
    kept.write_kept(changed, names[2], 4, str(tmp_path / "2"))
    both = kept.merged_first_seen(base, spark.table(names[2]))
    assert "Exchange" not in both._jdf.queryExecution().executedPlan().toString()
    assert {r.user_id: (r.feed_first, r.msg_first) for r in both.collect()} == expected
    assert kept.changed_first_seen(spark.table(names[1]), first_days(spark, new)).collect() == []
    # Once more: nothing is shuffled but the new rows.
    plan = kept.merged_first_seen(spark.table(names[1]), first_days(spark, new))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan
    scan = plan[: plan.index("FileScan")]
    assert scan.rindex("SortMergeJoin") > scan.rfind("Exchange")
