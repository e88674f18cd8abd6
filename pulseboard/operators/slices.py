"""Sums of metrics along single dimensions, all in one long table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def slice_sums(
    facts: DataFrame, keys: Sequence[str], dimensions: Sequence[str], metrics: Sequence[str]
) -> DataFrame:
    """Per ``keys`` and value of each dimension, the sums of ``metrics``.

    Facts are first summed per combination of dimension values, so only those few
    combinations, not the facts, are repeated once per dimension.
    """
    sums = [F.sum(m).cast("bigint").alias(m) for m in metrics]
    combined = facts.groupBy(*keys, *dimensions).agg(*sums)
    if len(dimensions) == 1:
        only = dimensions[0]
        value = F.col(only).cast("string").alias("dimension_value")
        return combined.select(*keys, F.lit(only).alias("dimension"), value, *metrics)
    sliced = [
        F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("dimension_value"))
        for d in dimensions
    ]
    return (
        combined.select(*keys, *metrics, F.inline(F.array(*sliced)))
        .groupBy(*keys, "dimension", "dimension_value")
        .agg(*sums)
    )
