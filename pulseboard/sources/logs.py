"""The two event logs: schemas, batch and stream readers, daily layout, SQL access."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseboard.functions.clock import DAY_PARTITION

_PERSON = [
    T.StructField("gender", T.IntegerType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("os", T.StringType()),
]

FEED_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("time", T.TimestampNTZType()),
        T.StructField("action", T.StringType()),
        *_PERSON,
    ]
)

MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("reciever_id", T.LongType()),
        T.StructField("time", T.TimestampNTZType()),
        *_PERSON,
    ]
)


# Which of several equal rows a row is; with its columns it tells any two rows of a log apart.
ROW_RANK = "row_rank"


def _stored(schema: T.StructType, ranked: bool = False) -> T.StructType:
    rank = [T.StructField(ROW_RANK, T.LongType())] if ranked else []
    return T.StructType([*schema.fields, *rank, T.StructField(DAY_PARTITION, T.DateType())])


def read_log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A log written by :func:`write_log`. The schema is given, so no file is opened to infer it."""
    return spark.read.schema(_stored(schema)).parquet(path)


def stream_log(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    max_files_per_trigger: int | None = None,
    replayed_within: str | None = None,
) -> DataFrame:
    """The same log as a stream; ``time`` becomes the zoned type watermarks need.

    Files come in the order in which they were written. With ``max_files_per_trigger`` a backlog is
    taken in by steps, so state holds the buckets of a few files, not of the whole log: write
    days in their order and let a step be a few days. A day that :func:`write_log` writes
    again consists of new files, so a running stream gets its rows a second time. With ``replayed_within``
    it takes each row once: of a log that was written with ``ranked``, rows that come again while the
    watermark is no more than that behind them are dropped, and later ones are late. The rows of that time are state, and
    ``time`` has a watermark already.
    """
    reader = spark.readStream.schema(_stored(schema, ranked=replayed_within is not None))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    log = reader.parquet(path).withColumn("time", F.col("time").cast("timestamp"))
    if replayed_within is None:
        return log
    row = [f.name for f in schema.fields]
    return log.withWatermark("time", replayed_within).dropDuplicatesWithinWatermark([*row, ROW_RANK])


def _ranked(log: DataFrame) -> DataFrame:
    """The rows with their ranks among equal ones. Equal rows are counted, first in each task, and dealt out
    again, so many equal rows never meet."""
    counted = log.groupBy(*log.columns).agg(F.count("*").alias("_n"))
    rank = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))).alias(ROW_RANK)
    return counted.select(*log.columns, rank)


def write_log(log: DataFrame, path: str, ranked: bool = False) -> None:
    """Lay a log out by day; a rewritten day replaces that day only. ``ranked`` adds what a stream needs to
    take rewritten days in once (see :func:`stream_log`).

    The rebalance lets adaptive execution cut a heavy day into several even
    files instead of sending it to one task.
    """
    if ranked:
        log = _ranked(log)
    (
        log.withColumn(DAY_PARTITION, F.to_date("time"))
        .hint("rebalance", F.col(DAY_PARTITION))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY_PARTITION)
        .parquet(path)
    )


def query(spark: SparkSession, sql: str, args: dict | None = None, **logs: DataFrame) -> DataFrame:
    """Run SQL over the given frames, named by keyword: ``query(spark, "... FROM {feed}", feed=df)``."""
    return spark.sql(sql, args=args, **logs)
