"""Quartiles of the rows before each row, at the same cost for any number of rows.

A window function computes every frame anew, so that its cost grows with the frame. Here a series is cut
into chunks of whole days, which get the rows that they need from before and after by a join, and each chunk is
one group of a grouped operator: a sorted list loses one value and gains one per row. A series of years
is as many tasks as it has chunks, not one.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows of a chunk, at least; and how many times the rows that it gets from other chunks.
CHUNK_ROWS = 20_000
CHUNK_FRAMES = 4


def quartiles(values: np.ndarray, size: int) -> np.ndarray:
    """The 25th and 75th percentiles of the ``size`` values before each one, interpolated; NaN unless
    there are as many and all are numbers."""
    out = np.full((len(values), 2), np.nan)
    held: list[float] = []
    places = [(q * (size - 1), i) for i, q in enumerate((0.25, 0.75))]
    numbers = values.tolist()
    for i, value in enumerate(numbers):
        if i > size:
            gone = numbers[i - size - 1]
            if gone == gone:
                del held[bisect_left(held, gone)]
        if len(held) == size:
            for place, at in places:
                low = int(place)
                below, above = held[low], held[min(low + 1, size - 1)]
                out[i, at] = below + (place - low) * (above - below)
        if value == value:
            insort(held, value)
    return out


def means(values: np.ndarray, before: int, after: int) -> np.ndarray:
    """The mean of the numbers from ``before`` values before each one to ``after`` after it."""
    there = np.isfinite(values)
    total = np.concatenate([[0.0], np.cumsum(np.where(there, values, 0.0))])
    count = np.concatenate([[0], np.cumsum(there)])
    at = np.arange(len(values))
    first, last = np.maximum(at - before, 0), np.minimum(at + after + 1, len(values))
    n = count[last] - count[first]
    return np.where(n > 0, (total[last] - total[first]) / np.maximum(n, 1), np.nan)


def _chunks(series: DataFrame, keys: Sequence[str], before: int, after: int) -> DataFrame:
    """(keys..., day, chunk, own): the chunks that need a day's rows, and whether the day is the chunk's own."""
    rows = max(CHUNK_ROWS, CHUNK_FRAMES * (before + after))
    in_order = Window.partitionBy(*keys).orderBy("day")
    days = series.groupBy(*keys, "day").agg(F.count("*").alias("n"))
    days = days.withColumn("end", F.sum("n").over(in_order)).withColumn("begin", F.col("end") - F.col("n"))
    days = days.withColumn("chunk", F.floor(F.col("begin") / rows).cast("long"))
    spans = days.groupBy(*[F.col(k).alias(f"_{k}") for k in keys], F.col("chunk").alias("_chunk")).agg(
        (F.min("begin") - before).alias("_from"), (F.max("end") + after).alias("_to")
    )
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    near = (F.col("end") > F.col("_from")) & (F.col("begin") < F.col("_to"))
    return days.join(spans, [*same, near]).select(
        *keys, "day", F.col("_chunk").alias("chunk"), (F.col("chunk") == F.col("_chunk")).alias("own")
    )


def sliding_bands(
    series: DataFrame, bucket: str, a: float, size: int, by: Sequence[str], smooth_ahead: int
) -> DataFrame:
    """``q25``, ``q75`` and the smoothed ``up`` and ``low`` of each row of a long series."""
    keys = ["metric", *by]
    behind, ahead = size // 2, smooth_ahead
    dated = series.withColumn("day", F.to_date(bucket))
    placed = _chunks(dated, keys, size + behind, ahead)
    placed = placed.select(*[F.col(c).alias(f"_{c}") for c in (*keys, "day")], "chunk", "own")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*keys, "day")]
    rows = dated.join(placed, same).select(*series.columns, "chunk", "own")
    new = [T.StructField(c, T.DoubleType()) for c in ("q25", "q75", "iqr", "up", "low")]
    schema = T.StructType([*series.schema.fields, *new])
    given, names = series.columns, schema.names

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by(bucket)
        values = group.column("value").cast(pa.float64(), safe=False).to_numpy()
        values = np.where(np.isfinite(values), values, np.nan)
        found = quartiles(values, size)
        spread = found[:, 1] - found[:, 0]
        up = means(found[:, 1] + a * spread, behind, ahead)
        low = means(found[:, 0] - a * spread, behind, ahead)
        own = group.column("own").combine_chunks()
        columns = [group.column(c) for c in given]
        columns += [pa.array(x, from_pandas=True) for x in (found[:, 0], found[:, 1], spread, up, low)]
        return pa.Table.from_arrays(columns, names=names).filter(own)

    return rows.groupBy(*keys, "chunk").applyInArrow(run, schema)
