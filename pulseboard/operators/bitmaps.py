"""Who was active on a day, as bitmaps that can be merged and intersected.

Users' numbers are dealt to buckets of 32,768, and a bucket's users of a day and product are bits of one
binary value. Days, weeks and months then come from the kept rows alone: the union of days is a bitwise or, users of
both products a bitwise and, and counts stay exact. Map tasks hand on one bitmap per day, product and
bucket at most, however many rows a user has, and no task has more than a bucket of a group.

Numbers may be negative; people without one do not count. Numbers should be dense: a bucket takes 4 KB however few
of its users were active. Ids that are spread over all 64 bits want a table of numbers first, or
the sketches of :mod:`pulseboard.operators.sketches`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseboard.operators.products import both_products

KEYS = ("date", "is_feed")


def audience_bitmaps(feed: DataFrame, messages: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(date, is_feed, by..., bucket, users): the active users of each day and product (and slice)."""
    rows = both_products(feed, messages, ["user_id", *by], day="date").where("user_id IS NOT NULL")
    return (
        rows.withColumn("bucket", F.bitmap_bucket_number("user_id"))
        .groupBy(*KEYS, *by, "bucket")
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("user_id")).alias("users"))
    )


def bitmap_schema(by: Sequence[T.StructField] = ()) -> T.StructType:
    """The schema of kept bitmaps, for reading without opening a file."""
    return T.StructType(
        [
            T.StructField("is_feed", T.BooleanType()),
            *by,
            T.StructField("bucket", T.LongType()),
            T.StructField("users", T.BinaryType()),
            T.StructField("date", T.DateType()),
        ]
    )


def write_bitmaps(bitmaps: DataFrame, path: str) -> None:
    """Keeps the bitmaps of some days; days that are there already are replaced, the others stay."""
    (
        bitmaps.hint("rebalance", F.col("date"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date")
        .parquet(path)
    )


def read_bitmaps(spark: SparkSession, path: str, by: Sequence[T.StructField] = ()) -> DataFrame:
    return spark.read.schema(bitmap_schema(by)).parquet(path)


def union_of(users: Column, where: Column | None = None) -> Column:
    """The users of all rows of a group, or of those rows where a condition holds."""
    return F.bitmap_or_agg(users if where is None else F.when(where, users))


def size_of(bitmap: Column) -> Column:
    return F.bitmap_count(bitmap)
