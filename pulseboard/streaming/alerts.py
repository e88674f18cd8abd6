"""Alerts on the quarter-hour stream: the bands of each metric kept as state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from pulseboard.operators.bands import BUCKET
from pulseboard.plans.alerts import METRICS, decisions, long_series
from pulseboard.streaming.state import BandState


def alert_stream(
    metrics: DataFrame, names: Sequence[str] = METRICS, a: float = 4, sample_size: int = 6
) -> DataFrame:
    """The alert decision on every closed bucket, from the stream of metrics.

    Row windows do not exist on streams, so each metric's last values are state.
    Run it with the RocksDB state store (see :func:`pulseboard.streaming.run.start`).
    """
    series = long_series(metrics, names).select("metric", BUCKET, "value")
    value = series.schema["value"].dataType
    bands_schema = T.StructType(
        [
            T.StructField("metric", T.StringType()),
            T.StructField(BUCKET, T.TimestampType()),
            T.StructField("value", value),
            T.StructField("prev_value", value),
            T.StructField("low", T.DoubleType()),
            T.StructField("up", T.DoubleType()),
        ]
    )
    whole = isinstance(value, T.LongType)
    bands = series.groupBy("metric").transformWithStateInPandas(
        BandState(a, sample_size, whole),
        outputStructType=bands_schema,
        outputMode="Append",
        timeMode="None",
    )
    return decisions(bands)
