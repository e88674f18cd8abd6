from datetime import timedelta

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pulseboard.operators import bands, causal_bands, chart_bands, sliding
from pulseboard.plans import alerts
from pulseboard.sources import events as source
from pulseboard.streaming.state import trailing_bands
from tests.logs import at, feed_log, message_log

START = at("2024-01-30 00:00")


def series(spark, values, metric="likes"):
    rows = [(START + timedelta(minutes=15 * i), metric, int(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "quart_hour timestamp_ntz, metric string, value bigint")


def pandas_bands(values, a=4, n=6):
    """The bands as rolling windows over a whole series."""
    x = pd.Series(values, dtype="float64")
    q25, q75 = (x.shift(1).rolling(n).quantile(q) for q in (0.25, 0.75))
    up, low = q75 + a * (q75 - q25), q25 - a * (q75 - q25)
    smooth = [b.rolling(n, center=True, min_periods=1).mean() for b in (low, up)]
    return pd.DataFrame({"q25": q25, "q75": q75, "low": smooth[0], "up": smooth[1]})


def collected(frame, *columns):
    rows = frame.orderBy("quart_hour").select(*columns).collect()
    return np.array([[np.nan if v is None else v for v in r] for r in rows], dtype="float64")


VALUES = np.random.default_rng(7).integers(0, 20, 60)


@pytest.mark.parametrize("n", [5, 6])
def test_chart_bands_equal_centred_rolling_windows(spark, n):
    bands = chart_bands(series(spark, VALUES), a=4, sample_size=n)
    expected = pandas_bands(VALUES, n=n)
    found = collected(bands, "q25", "q75", "low", "up")
    np.testing.assert_allclose(found, expected.to_numpy(), rtol=1e-12)
    assert np.flatnonzero(~np.isnan(found[:, 3]))[0] == n - (n - 1) // 2


@pytest.mark.parametrize("n", [5, 6])
def test_causal_bands_equal_the_last_row_of_every_prefix(spark, n):
    bands = causal_bands(series(spark, VALUES), a=4, sample_size=n)
    expected = [
        pandas_bands(VALUES[: i + 1], n=n)[["low", "up"]].iloc[-1] for i in range(len(VALUES))
    ]
    np.testing.assert_allclose(collected(bands, "low", "up"), np.array(expected), rtol=1e-12)


def test_trailing_bands_equal_causal_bands(spark):
    found = trailing_bands(VALUES.astype("float64"), 4, 6)
    expected = collected(causal_bands(series(spark, VALUES)), "low", "up")
    np.testing.assert_allclose(found[["low", "up"]].to_numpy(), expected, rtol=1e-12)


def replayed(spark, values, **options):
    wide = series(spark, values).withColumnRenamed("value", "likes").drop("metric")
    return alerts.alert_replay(wide, names=["likes"], **options).orderBy("quart_hour").collect()


def test_a_constant_series_alerts_on_any_change(spark):
    last = replayed(spark, [5] * 8 + [6])[-1]
    assert (last.low, last.up, last.is_alert, last.deviation_pct) == (5.0, 5.0, True, 20.0)
    assert not any(r.is_alert for r in replayed(spark, [5] * 9))


def test_no_band_no_alert(spark):
    assert [r.is_alert for r in replayed(spark, [1, 1, 1, 1, 1, 100])] == [False] * 6
    seventh = replayed(spark, [1, 1, 1, 1, 1, 1, 100])[-1]
    assert seventh.up == 1.0 and seventh.is_alert


def test_previous_value_zero_or_absent(spark):
    rows = replayed(spark, [0, 5])
    assert [r.prev_value for r in rows] == [None, 0]
    assert [r.deviation_pct for r in rows] == [None, None]


def test_rates_that_are_no_numbers(spark):
    """An infinite rate is outside any band; around it, rows lack one; nan never alerts."""
    rates = [0.5, 0.25, 0.75, 0.5, 0.5, 0.25, np.inf, 0.5, 0.25, 0.5, 0.75, 0.5, 0.25, 0.5, np.nan]
    rows = [(START + timedelta(minutes=15 * i), float(v)) for i, v in enumerate(rates)]
    wide = spark.createDataFrame(rows, "quart_hour timestamp_ntz, ctr double")
    replay = alerts.alert_replay(wide, names=["ctr"]).orderBy("quart_hour").collect()
    assert [i for i, r in enumerate(replay) if r.is_alert] == [6]
    assert [i for i, r in enumerate(replay) if r.low is None] == [*range(6), *range(10, 13)]
    found = trailing_bands(np.array(rates), 4, 6)
    expected = [[np.nan if v is None else v for v in (r.low, r.up)] for r in replay]
    np.testing.assert_allclose(found[["low", "up"]].to_numpy(), np.array(expected), rtol=1e-12)


def test_slices_are_independent(spark):
    metrics = series(spark, VALUES).withColumnRenamed("value", "likes").drop("metric")
    both = metrics.selectExpr("*", "'a' AS os").union(
        metrics.selectExpr("quart_hour", "likes * 3", "'b'")
    )
    sliced = alerts.alert_replay(both, names=["likes"], by=["os"])
    alone = alerts.alert_replay(metrics, names=["likes"])
    one = sliced.where("os = 'a'").drop("os")
    assert one.exceptAll(alone).count() == alone.exceptAll(one).count() == 0


def quarter_logs(spark):
    feed = feed_log(
        spark,
        [
            (1, "2024-01-30 10:00", "view"),
            (1, "2024-01-30 10:14:59.999999", "like"),
            (2, "2024-01-30 10:05", "like"),
            (1, "2024-01-30 10:15", "view"),
            (1, "2024-01-31 09:59", "view"),
            (1, "2024-01-31 10:00", "view"),
        ],
    )
    messages = message_log(
        spark,
        [
            (1, 2, "2024-01-30 10:10"),
            (1, 3, "2024-01-30 10:11"),
            (9, 1, "2024-01-30 10:30"),
            (9, 1, "2024-01-31 09:45"),
            (9, 1, "2024-01-31 10:01"),
        ],
    )
    return feed, messages


def test_quarter_hours_need_both_products_and_be_closed(spark):
    metrics = alerts.quarter_hour_metrics(
        *quarter_logs(spark), "2024-01-31 10:07:00", with_ctr=True
    ).orderBy("quart_hour")
    # quart_hour, feed_users, msg_users, likes, views, messages, ctr
    assert [tuple(r) for r in metrics.collect()] == [
        (at("2024-01-30 10:00"), 2, 1, 2, 1, 2, 2.0),
        (at("2024-01-31 09:45"), 1, 1, 0, 1, 1, 0.0),
    ]


def test_alert_latest_takes_the_newest_row(spark):
    metrics = alerts.quarter_hour_metrics(*quarter_logs(spark), "2024-01-31 10:07:00")
    rows = {r.metric: r for r in alerts.alert_latest(metrics).collect()}
    assert set(rows) == set(alerts.METRICS)
    assert {r.quart_hour for r in rows.values()} == {at("2024-01-31 09:45")}
    assert rows["messages"].prev_value == 2 and rows["messages"].deviation_pct == 50.0
    assert alerts.alert_latest(metrics.limit(0)).count() == 0


def test_alert_messages(spark):
    wide = series(spark, [5] * 8 + [6]).withColumnRenamed("value", "likes").drop("metric")
    replay = alerts.alert_replay(wide, names=["likes"])
    texts = [r.message for r in alerts.alert_messages(replay, "https://example.org/d").collect()]
    assert texts == [
        "Метрика likes:\nтекущее значение: 6\nотклонение от предыдущего значения: 20.0%\n"
        "дашборд: https://example.org/d\n"
    ]


@pytest.mark.parametrize("size", [1, 2, 7, 100])
def test_sliding_quartiles_and_means_equal_frames(size):
    rng = np.random.default_rng(size)
    values = rng.integers(-5, 50, 400).astype(float)
    values[rng.random(400) < 0.02] = np.nan
    found = sliding.quartiles(values, size)
    around = sliding.means(values, size // 2, 3)
    for i in range(400):
        frame = values[max(0, i - size) : i]
        if len(frame) == size and not np.isnan(frame).any():
            assert found[i].tolist() == np.quantile(frame, [0.25, 0.75]).tolist()
        else:
            assert np.isnan(found[i]).all()
        near = values[max(0, i - size // 2) : i + 4]
        near = near[~np.isnan(near)]
        assert around[i] == pytest.approx(near.mean()) if len(near) else np.isnan(around[i])


def test_three_weeks_of_rows_in_more_tasks_than_series(spark, monkeypatch):
    """Frames of 2,016 rows over a year of quarter hours, with gaps, in chunks."""
    monkeypatch.setattr(sliding, "CHUNK_ROWS", 500)
    monkeypatch.setattr(sliding, "CHUNK_FRAMES", 1)
    series = spark.range(9000).where("id % 17 <> 3").selectExpr(
        "'m' || (id % 2) AS metric",
        "timestamp_ntz '2024-01-01' + make_dt_interval(0, 0, 15 * (id div 2)) AS quart_hour",
        "pmod(xxhash64(id), 1000) AS value",
    )
    found = chart_bands(series, sample_size=2016)
    assert "Window" not in found.select("up").groupBy().count()._jdf.queryExecution().toString().split("FlatMapGroupsInArrow")[0]
    got = {(r.metric, r.quart_hour): tuple(r)[2:] for r in found.collect()}
    duck = duckdb.connect()
    duck.register("series", pa.Table.from_pandas(series.toPandas()))
    expected = duck.sql("""
        SELECT *, avg(q75 + 4 * (q75 - q25)) OVER around AS up, avg(q25 - 4 * (q75 - q25)) OVER around AS low
        FROM (SELECT metric, quart_hour, value,
                CASE WHEN count(*) OVER w = 2016 THEN quantile_cont(CAST(value AS DOUBLE), 0.25) OVER w END AS q25,
                CASE WHEN count(*) OVER w = 2016 THEN quantile_cont(CAST(value AS DOUBLE), 0.75) OVER w END AS q75
              FROM series WINDOW w AS (PARTITION BY metric ORDER BY quart_hour ROWS BETWEEN 2016 PRECEDING AND 1 PRECEDING))
        WINDOW around AS (PARTITION BY metric ORDER BY quart_hour ROWS BETWEEN 1008 PRECEDING AND 1007 FOLLOWING)
    """).fetchall()
    assert len(expected) == len(got) > 8000
    for metric, at, value, q25, q75, up, low in expected:
        iqr = None if q25 is None else q75 - q25
        assert got[metric, at] == (value, q25, q75, iqr, pytest.approx(up), pytest.approx(low))
    chunks = sliding._chunks(series.withColumn("day", F.to_date("quart_hour")), ["metric"], 3024, 1007)
    assert chunks.select("metric", "chunk").distinct().count() > 2


def test_long_samples_equal_short_ones_where_both_run(spark, monkeypatch):
    events = source.events(spark, "/root/testdata/sf0.01")
    series = alerts.long_series(alerts.quarter_hour_series(source.feed_actions(events), source.message_actions(events), with_ctr=True), (*alerts.METRICS, "ctr"))
    expected = {tuple(r)[:2]: tuple(r)[2:] for r in causal_bands(series, sample_size=20).collect()}
    monkeypatch.setattr(bands, "SLIDING_FROM", 1)
    found = {tuple(r)[:2]: tuple(r)[2:] for r in causal_bands(series, sample_size=20).collect()}
    assert found.keys() == expected.keys()

    def plain(row):
        return [pytest.approx(v, nan_ok=True) if isinstance(v, float) else v for v in row]

    for key, row in expected.items():
        assert list(found[key]) == plain(row)
