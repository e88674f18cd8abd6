"""Interquartile bands over long metric series (``metric``, ``quart_hour``, ``value``).

A raw band comes from the ``sample_size`` rows before a row; it is NULL until that
many exist and are finite numbers (a rate need not be). Bounds are then averaged
over neighbouring rows. NULL, never NaN, stands for a missing bound, because NaN
compares greater than any number.

Up to SLIDING_FROM rows, each series is one window partition. It holds one row per bucket, so its size
follows from the calendar (35,040 quarter hours a year), not from the volume of the
logs; more slices (``by``) add partitions, not rows to a partition. Longer frames go to
:mod:`pulseboard.operators.sliding`, whose cost does not depend on the frame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from pulseboard.operators.sliding import sliding_bands

BUCKET = "quart_hour"
# The least sample size for which sliding over sorted values is cheaper than frames of a window.
SLIDING_FROM = 48


def _number(series: DataFrame) -> Column:
    """The value, or NULL where a float is nan or infinite."""
    value = F.col("value")
    if dict(series.dtypes)["value"] != "double":
        return value
    return F.when(F.abs(value) < float("inf"), value)


def _order(by: Sequence[str]) -> WindowSpec:
    return Window.partitionBy("metric", *by).orderBy(BUCKET)


def _bands(
    series: DataFrame, a: float, sample_size: int, by: Sequence[str], smooth_ahead: int
) -> DataFrame:
    if sample_size >= SLIDING_FROM:
        return sliding_bands(series, BUCKET, float(a), sample_size, by, smooth_ahead)
    order = _order(by)
    previous = order.rowsBetween(-sample_size, -1)
    around = order.rowsBetween(-(sample_size // 2), smooth_ahead)
    number = _number(series)
    quartiles = F.percentile(number, F.array(F.lit(0.25), F.lit(0.75))).over(previous)
    enough = F.count(number).over(previous) == sample_size
    raw = (
        series.withColumn("_quartiles", F.when(enough, quartiles))
        .withColumn("q25", F.col("_quartiles")[0])
        .withColumn("q75", F.col("_quartiles")[1])
        .withColumn("iqr", F.col("q75") - F.col("q25"))
    )
    margin = F.lit(float(a)) * F.col("iqr")
    return (
        raw.withColumn("up", F.avg(F.col("q75") + margin).over(around))
        .withColumn("low", F.avg(F.col("q25") - margin).over(around))
        .drop("_quartiles")
    )


def chart_bands(
    series: DataFrame, a: float = 4, sample_size: int = 6, by: Sequence[str] = ()
) -> DataFrame:
    """Bands smoothed over a centred frame, as drawn around a finished series."""
    return _bands(series, a, sample_size, by, smooth_ahead=(sample_size - 1) // 2)


def causal_bands(
    series: DataFrame, a: float = 4, sample_size: int = 6, by: Sequence[str] = ()
) -> DataFrame:
    """Bands as known at each row, without the rows after it, plus ``prev_value``.

    This is the centred smoothing as it stands while the row is the last one.
    """
    bands = _bands(series, a, sample_size, by, smooth_ahead=0)
    return bands.withColumn("prev_value", F.lag("value").over(_order(by)))
