import math
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulseboard.functions import (
    age_group,
    closed_buckets,
    half_even,
    last_days,
    number_text,
    quarter_hour,
    ratio,
    rows_in,
    yesterday,
)
from tests.logs import at, feed_log


@pytest.mark.parametrize(
    "age, label",
    [
        (None, "unknown"),
        (0, "0-20"),
        (20, "0-20"),
        (21, "21-30"),
        (30, "21-30"),
        (31, "31-40"),
        (40, "31-40"),
        (41, "41-50"),
        (50, "41-50"),
        (51, "51-60"),
        (60, "51-60"),
        (61, "> 60"),
        (130, "> 60"),
    ],
)
def test_age_group(spark, age, label):
    assert spark.range(1).select(age_group(F.lit(age).cast("int"))).first()[0] == label


def test_ratio(spark):
    rows = spark.createDataFrame([(1, 2), (1, 0), (0, 0), (0, 3)], "n bigint, d bigint")
    found = [
        tuple(r)
        for r in rows.select(
            ratio(F.col("n"), F.col("d")), ratio(F.col("n"), F.col("d"), "null")
        ).collect()
    ]
    assert found[0] == (0.5, 0.5)
    assert found[1] == (math.inf, None)
    assert math.isnan(found[2][0]) and found[2][1] is None
    assert found[3] == (0.0, 0.0)
    with pytest.raises(ValueError):
        ratio(F.col("n"), F.col("d"), "zero")


def test_half_even(spark):
    rows = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-2.5,)], "x double")
    assert [r[0] for r in rows.select(half_even(F.col("x"))).collect()] == [0, 2, 2, -2]


def test_half_even_of_scaled_floats(spark):
    values = [19.275, 19.285, 2.675, 1.005, 0.125, 0.375, -0.125, 1e300, math.inf]
    rows = spark.createDataFrame([(v,) for v in values], "x double")
    found = [r[0] for r in rows.select(half_even(F.col("x"), 2)).collect()]
    assert found == [float(np.round(v, 2)) for v in values]


def test_number_text(spark):
    values = [1.0, 83.3, 83.33, 0.0, -2.5, 12345678.25, math.inf, -math.inf, math.nan, None]
    rows = spark.createDataFrame([(v,) for v in values], "x double")
    found = [r[0] for r in rows.select(number_text(F.col("x"))).collect()]
    assert found == [None if v is None else str(v) for v in values]


def test_quarter_hour(spark):
    rows = feed_log(spark, [(1, f"2024-01-30 10:{m}", "view") for m in ("00:00", "14:59", "15:00")])
    found = [r[0] for r in rows.select(quarter_hour(F.col("time"))).collect()]
    assert found == [at("2024-01-30 10:00"), at("2024-01-30 10:00"), at("2024-01-30 10:15")]


def test_spans():
    assert yesterday("2024-03-01").start == datetime(2024, 2, 29)
    week = last_days("2024-01-31 11:00:00", 7)
    assert (week.start, week.end) == (datetime(2024, 1, 24), datetime(2024, 1, 31))
    live = closed_buckets("2024-01-31 11:07:00")
    assert (live.start, live.end) == (datetime(2024, 1, 30), datetime(2024, 1, 31, 11))
    assert closed_buckets("2024-01-31 11:15:00").end == datetime(2024, 1, 31, 11, 15)
    with pytest.raises(ValueError):
        last_days("2024-01-31", 0)


EDGES = ["01-23 23:59:59.999999", "01-24 00:00", "01-30 23:59:59.999999", "01-31 00:00"]


@pytest.mark.parametrize("zoned", [False, True])
def test_rows_in_day_edges(spark, zoned):
    log = feed_log(spark, [(i, f"2024-{t}", "view") for i, t in enumerate(EDGES)])
    if zoned:
        log = log.withColumn("time", F.col("time").cast("timestamp"))
    kept = rows_in(log, last_days("2024-01-31", 7)).select("user_id").collect()
    assert sorted(r[0] for r in kept) == [1, 2]


@pytest.mark.parametrize("minutes", [25, 7, 0, 24 * 60 + 1])
def test_buckets_must_divide_a_day(minutes):
    with pytest.raises(ValueError, match="divide a day"):
        closed_buckets("2024-01-30 12:00", minutes)
    with pytest.raises(ValueError, match="divide a day"):
        quarter_hour(None, minutes)
