"""Tables of what is known per user, laid out so that a new day joins them where they are.

A kept table is cut into buckets by user and sorted within these. A day's rows, few beside those of all
history, are shuffled to the same buckets; the kept side is read bucket by bucket, by as many tasks, and is never
shuffled. The merged rows come out bucket by bucket too, so that the next version is written without a shuffle, one
file per bucket.

Days need not rewrite the table: ``changed_first_seen`` gives the few rows that a day changes, which are kept as a second
table in the same buckets. Reading both together shuffles neither. Now and then ``keep_first_seen`` makes one of
the two.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEY = "user_id"


def write_kept(rows: DataFrame, table: str, buckets: int, location: str) -> None:
    """Writes a version of a kept table. Choose ``buckets`` once, so that a bucket fits a task's memory in years to
    come; all versions and joins share the number."""
    rows.write.format("parquet").bucketBy(buckets, KEY).sortBy(KEY).option("path", location).saveAsTable(table)


def merged_first_seen(kept: DataFrame, recent: DataFrame) -> DataFrame:
    """First-seen days of a kept table and of newer rows, by a join that leaves the kept side where it is.

    Rows without a user are left out, as they are by all that reads first-seen days.
    """
    new = recent.where(F.col(KEY).isNotNull()).select(KEY, *[F.col(c).alias(f"_{c}") for c in ("feed_first", "msg_first")])
    # The kept side is by far the larger: it must not be sent to the tasks of the other.
    joined = kept.where(F.col(KEY).isNotNull()).hint("merge").join(new, KEY, "full")
    return joined.select(KEY, *[F.least(c, f"_{c}").alias(c) for c in ("feed_first", "msg_first")])


def changed_first_seen(kept: DataFrame, recent: DataFrame) -> DataFrame:
    """Of newer rows those that change a kept table: new users, and first days that are earlier than known."""
    known = kept.where(F.col(KEY).isNotNull()).hint("merge")
    known = known.select(KEY, *[F.col(c).alias(f"_{c}") for c in ("feed_first", "msg_first")])
    new = recent.where(F.col(KEY).isNotNull()).join(known, KEY, "left")
    earlier = [F.col(c).isNotNull() & (F.col(f"_{c}").isNull() | (F.col(c) < F.col(f"_{c}"))) for c in ("feed_first", "msg_first")]
    return new.where(earlier[0] | earlier[1]).select(KEY, "feed_first", "msg_first")


def keep_first_seen(spark: SparkSession, table: str, recent: DataFrame, to: str, location: str) -> DataFrame:
    """Writes the next version ``to`` of the kept table ``table`` with newer rows; the older one stays as it
    is for its readers. A repeated day changes nothing, as first days are the least of both."""
    buckets = _buckets(spark, table)
    write_kept(merged_first_seen(spark.table(table), recent), to, buckets, location)
    return spark.table(to)


def _buckets(spark: SparkSession, table: str) -> int:
    told = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    return int(told["Num Buckets"])
