"""The bands of a metric, and when a product was last seen, as streaming state.

Nothing here uses the rest of the package at run time, so the code travels to the
workers with the query and the package need not be installed there.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from pulseboard.operators.bands import BUCKET

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def trailing_bands(values: np.ndarray, a: float, sample_size: int) -> pd.DataFrame:
    """Smoothed bounds of each value from the ones before it (NaN: no band yet)."""
    numbers = np.where(np.isfinite(values), values, np.nan)
    quartiles = np.full((len(numbers), 2), np.nan)
    if len(numbers) > sample_size:
        previous = np.lib.stride_tricks.sliding_window_view(numbers, sample_size)[:-1]
        quartiles[sample_size:] = np.quantile(previous, [0.25, 0.75], axis=1).T
    margin = a * (quartiles[:, 1] - quartiles[:, 0])
    raw = pd.DataFrame({"low": quartiles[:, 0] - margin, "up": quartiles[:, 1] + margin})
    return raw.rolling(sample_size // 2 + 1, min_periods=1).mean()


class BandState(StatefulProcessor):
    """Keeps the few last values of a metric: all that the bands of later ones need."""

    def __init__(self, a: float, sample_size: int, whole_values: bool):
        self._a = a
        self._sample_size = sample_size
        self._keep = sample_size + sample_size // 2
        self._value_type = "Int64" if whole_values else "Float64"

    def init(self, handle: StatefulProcessorHandle) -> None:
        schema = T.StructType([T.StructField("values", T.ArrayType(T.DoubleType()))])
        self._recent = handle.getValueState("recent", schema)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        # Buckets of one metric that closed in this micro-batch; their order inside it is free.
        new = pd.concat(list(rows)).sort_values(BUCKET)
        known = list(self._recent.get()[0]) if self._recent.exists() else []
        values = np.array([*known, *new["value"]], dtype="float64")
        self._recent.update((values[-self._keep :].tolist(),))

        fresh = slice(len(known), None)
        bands = trailing_bands(values, self._a, self._sample_size)[fresh]
        previous = pd.Series(values).shift(1)[fresh].astype(self._value_type)
        yield pd.DataFrame(
            {
                "metric": key[0],
                BUCKET: new[BUCKET].to_numpy(),
                "value": new["value"].to_numpy(),
                "prev_value": previous.array,
                "low": bands["low"].to_numpy(),
                "up": bands["up"].to_numpy(),
            }
        )

    def close(self) -> None:
        pass


class SilenceState(StatefulProcessor):
    """Keeps when a key was last seen, and tells each gap of more than ``silent`` milliseconds once."""

    def __init__(self, silent: int, width: int, forget: int):
        self._silent, self._width, self._forget = silent, width, max(forget, silent)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        schema = T.StructType([T.StructField("at", T.LongType()), T.StructField("told", T.BooleanType())])
        self._last = handle.getValueState("last", schema)

    def _told(self, key, gaps: list[int]) -> pd.DataFrame:
        return pd.DataFrame({"product": [key[0]] * len(gaps), "at": np.array(gaps, "int64")})

    def _wake(self, at: int, after: int) -> None:
        """A timer for when all buckets until ``after`` the last one are closed, in place of earlier ones."""
        for timer in list(self._handle.listTimers()):
            self._handle.deleteTimer(timer)
        self._handle.registerTimer(at + after + self._width)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        # Closed buckets come in the watermark's order from batch to batch, in any order within one.
        new = sorted({int(at) for frame in rows for at in frame["at"]})
        last, told = self._last.get() if self._last.exists() else (None, False)
        gaps = []
        for at in new:
            if last is not None and at <= last:
                continue
            if last is not None and at - last > self._silent and not told:
                gaps.append(last)
            last, told = at, False
        if last is not None:
            self._last.update((last, told))
            self._wake(last, self._forget if told else self._silent)
        if gaps:
            yield self._told(key, gaps)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        gaps = []
        if self._last.exists():
            last, told = self._last.get()
            if told:
                self._last.clear()
            else:
                gaps.append(last)
                self._last.update((last, True))
                self._wake(last, self._forget)
        if gaps:
            yield self._told(key, gaps)

    def close(self) -> None:
        pass
