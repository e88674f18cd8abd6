from datetime import date
from types import SimpleNamespace

import pytest

from pulseboard.functions import last_days, rows_in
from pulseboard.plans import activity
from pulseboard.sources import (
    DIMENSION_SCHEMA,
    FEED_SCHEMA,
    create_dimension_table,
    query,
    read_log,
    write_dimension_metrics,
    write_log,
)
from pulseboard.sources.scratch import new_folder, shared_folder
from tests.logs import feed_log, message_log, records


def metrics_of(spark, users):
    feed = feed_log(spark, [(u, f"2024-01-{d} 10:00", "view") for u in users for d in (29, 30)])
    messages = message_log(spark, [])
    return feed, messages


@pytest.fixture
def table(spark, tmp_path):
    name = f"metrics_{abs(hash(str(tmp_path)))}"
    create_dimension_table(spark, name, str(tmp_path / "table"))
    yield name
    spark.sql(f"DROP TABLE {name}")


def test_writing_twice_leaves_the_same_rows(spark, table):
    logs = metrics_of(spark, range(5))
    create_dimension_table(spark, table)  # exists already
    for as_of in ("2024-01-30", "2024-01-31", "2024-01-31"):
        write_dimension_metrics(activity.dimension_metrics(*logs, as_of), table)
    month = activity.dimension_metrics(*logs, "2024-01-31", days=30)
    assert records(spark.table(table).select(month.columns)) == records(month)


def test_a_later_run_replaces_its_day_only(spark, table):
    write_dimension_metrics(
        activity.dimension_metrics(*metrics_of(spark, range(5)), "2024-01-31", days=2), table
    )
    write_dimension_metrics(
        activity.dimension_metrics(*metrics_of(spark, range(7)), "2024-01-31"), table
    )
    views = spark.table(table).where("dimension = 'os'").select("event_date", "views")
    assert [v for _, v in records(views)] == [5, 7]


def test_append_keeps_what_is_there(spark, table):
    day = activity.dimension_metrics(*metrics_of(spark, range(5)), "2024-01-31")
    for _ in range(2):
        write_dimension_metrics(day, table, mode="append")
    assert spark.table(table).count() == 2 * day.count()
    with pytest.raises(ValueError):
        write_dimension_metrics(day, table, mode="merge")


def test_table_schema(spark, table):
    found = {f.name: f.dataType for f in spark.table(table).schema}
    assert found == {f.name: f.dataType for f in DIMENSION_SCHEMA}


def test_a_log_laid_out_by_day_is_pruned(spark, tmp_path):
    feed, _ = metrics_of(spark, range(5))
    path = str(tmp_path / "feed")
    write_log(feed, path)
    write_log(feed, path)
    log = read_log(spark, path, FEED_SCHEMA)
    assert records(log.drop("log_day")) == records(feed)
    rows = rows_in(log, last_days("2024-01-31", 1))
    assert rows.count() == 5
    assert len(rows.inputFiles()) <= 2  # of either day
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(log_day" in plan


def test_query_over_named_frames(spark):
    feed, _ = metrics_of(spark, range(5))
    found = query(spark, "SELECT count(*) AS n FROM {log} WHERE user_id < :u", {"u": 3}, log=feed)
    assert found.first().n == 6


def test_shared_folder_is_the_sessions(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert new_folder(spark, "x") != new_folder(spark, "x")


def session_without_the_setting(checkpoint=None, warehouse="hdfs:///warehouse/", master="yarn"):
    settings = {"spark.sql.warehouse.dir": warehouse}
    context = SimpleNamespace(getCheckpointDir=lambda: checkpoint, master=master)
    get = lambda key, *default: settings[key] if key in settings else default[0]
    return SimpleNamespace(conf=SimpleNamespace(get=get), sparkContext=context)


def test_no_folder_of_one_machine():
    assert shared_folder(session_without_the_setting("hdfs:///c/")) == "hdfs:///c"
    assert shared_folder(session_without_the_setting()) == "hdfs:///warehouse/_scratch"
    for master in ("local", "local[*]", "local[8]"):
        assert shared_folder(session_without_the_setting(None, "/data/w", master)) == "/data/w/_scratch"
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        for warehouse in ("/data/w", "file:/data/w", "file:///data/w"):
            with pytest.raises(RuntimeError):
                shared_folder(session_without_the_setting(None, warehouse, master))


def test_an_empty_rewrite_clears_its_days_and_only_these(spark, table):
    days = [date(2024, 1, 29), date(2024, 1, 30)]
    write_dimension_metrics(
        activity.dimension_metrics(*metrics_of(spark, range(5)), "2024-01-31", days=2), table, days=days
    )
    before = spark.table(table).where("event_date = DATE '2024-01-29'").count()
    nobody = activity.dimension_metrics(*metrics_of(spark, []), "2024-01-31")
    write_dimension_metrics(nobody, table, days=days[1:])
    assert [r[0] for r in spark.table(table).select("event_date").distinct().collect()] == days[:1]
    assert spark.table(table).count() == before > 0
    write_dimension_metrics(nobody, table)  # without days, those present in the rows: none
    assert spark.table(table).count() == before


@pytest.mark.parametrize("day", ["29", "DATE '2020-02-02'"])
def test_a_column_that_happens_to_be_called_day(spark, day):
    feed, messages = metrics_of(spark, range(5))
    other = feed.selectExpr("*", f"{day} AS day")
    assert records(activity.feed_user_daily(other, "2024-01-31")) == records(
        activity.feed_user_daily(feed, "2024-01-31")
    )
