"""

python tools/skewed_events.py FROM TO COPIES: each copy shifts the ids of users and events; then a third of
all events go to one user. FROM and TO are folders with an events.parquet.
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def skewed(events: DataFrame, copies: int, share: int = 3) -> DataFrame:
    """``copies`` of the events, of which every ``share``-th (by a hash) is one user's."""
    users, last = events.agg(F.max("user_id") + 1, F.max("event_id") + 1).first()
    one = F.pmod(F.xxhash64("event_id"), F.lit(share)) == 0
    return (
        events.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
        .withColumn("event_id", F.col("event_id") + F.col("copy") * last)
        .withColumn("user_id", F.when(one, 1).otherwise(F.col("user_id") + F.col("copy") * users))
        .drop("copy")
    )


def main(source: str, target: str, copies: str) -> None:
    spark = SparkSession.builder.config("spark.ui.enabled", "false").getOrCreate()
    events = spark.read.parquet(f"{source}/events.parquet")
    skewed(events, int(copies)).write.parquet(f"{target}/events.parquet")


if __name__ == "__main__":
    main(*sys.argv[1:])
