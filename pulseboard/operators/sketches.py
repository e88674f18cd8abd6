"""Who was active, as sketches: approximate, of fixed size, for any ids.

Exact counts are the default everywhere; this is the choice for spans, slices and ids for which no
exact table is worth keeping. Per quarter hour and product a theta sketch keeps the ``2 ** lg_size`` least
hashes of the users. Sketches of quarter hours merge to those of days and months, and two of them intersect,
without the logs. Up to that many users a sketch is exact. Beyond, a count strays from the truth by
more than ``error_bound`` (three standard deviations) in about one case of 370.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseboard.functions import quarter_hour
from pulseboard.operators.bands import BUCKET
from pulseboard.operators.products import both_products

LG_SIZE = 12
DEVIATIONS = 3


def audience_sketches(
    feed: DataFrame, messages: DataFrame, lg_size: int = LG_SIZE, minutes: int = 15, by: Sequence[str] = ()
) -> DataFrame:
    """(quart_hour, is_feed, by..., users): a sketch of the users of each bucket and product (and slice)."""
    rows = both_products(feed, messages, ["user_id", "time", *by]).where("user_id IS NOT NULL")
    return (
        rows.withColumn(BUCKET, quarter_hour(F.col("time"), minutes))
        .groupBy(BUCKET, "is_feed", *by)
        .agg(F.theta_sketch_agg("user_id", lg_size).alias("users"))
    )


def merged(users: Column, lg_size: int = LG_SIZE) -> Column:
    """The sketch of the users of all rows of a group."""
    return F.theta_union_agg(users, lg_size)


def estimate(users: Column) -> Column:
    return F.theta_sketch_estimate(users)


def error_bound(union: Column, lg_size: int = LG_SIZE) -> Column:
    """How far an estimate may stray: that of a sketch by its own count, that of an intersection by the
    count of the sketches' union."""
    spread = DEVIATIONS / (2**lg_size - 2) ** 0.5
    return F.when(union <= 2**lg_size, F.lit(0.0)).otherwise(F.ceil(union * spread).cast("double"))
