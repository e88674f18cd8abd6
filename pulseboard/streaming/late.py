"""Quarter-hour metrics that late rows still correct.

A stream in append mode emits a bucket once, and what comes after the watermark is lost. Here each
batch is summed by bucket and user and kept; then the buckets that it touched, and no others, are computed again
from all that is kept of them, and stored as newer versions. Readers take the newest version of each bucket.

A folder holds three tables, each laid out by day first, so that a batch lists and reads only the days
that it touches, and ``commits``:

* ``sums``: per bucket and user what each batch brought;
* ``late``: the same of rows that came later than the allowed lateness behind all earlier batches. They
  do not count, and are not lost;
* ``metrics``: each batch's version of the buckets that it touched;
* ``commits``: a file per batch, written last. Versions of a batch count once it is there, so
  readers see all of a batch or nothing.

A batch that is run again, after a failure or by a restarted query, replaces its own files, or nothing if it
was committed: what a batch reads are the sums of itself and of batches before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pulseboard.functions import quarter_hour, ratio
from pulseboard.operators.bands import BUCKET
from pulseboard.plans.alerts import METRICS, bucket_counts, marks, user_sums

COUNTS = ("feed_rows", "likes", "views", "messages")
_PLACE = [T.StructField("day", T.DateType()), T.StructField("batch", T.LongType())]
_SUMS = T.StructType(
    [
        T.StructField(BUCKET, T.TimestampType()),
        T.StructField("user_id", T.LongType()),
        *[T.StructField(c, T.LongType()) for c in COUNTS],
        *_PLACE,
    ]
)
_VERSIONS = T.StructType(
    [
        T.StructField(BUCKET, T.TimestampType()),
        *[T.StructField(m, T.LongType()) for m in METRICS],
        *_PLACE,
    ]
)
_COMMITS = T.StructType(
    [
        T.StructField("query", T.StringType()),
        T.StructField("batch", T.LongType()),
        T.StructField("newest", T.TimestampType()),
    ]
)


def _files(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, folder: str) -> bool:
    path, store = _files(spark, folder)
    return store.exists(path)


def _read(spark: SparkSession, folder: str, schema: T.StructType, days: Sequence | None = None) -> DataFrame:
    """A table of the folder, or of some of its days; empty if there is nothing yet."""
    whole = [folder] if days is None else [f"{folder}/day={day}" for day in days]
    there = [path for path in whole if _exists(spark, path)]
    if not there:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", folder).parquet(*there)


class BucketStore:
    """The folder's tables, and the function that adds a batch to them."""

    def __init__(self, path: str, lateness: str = "2 days", minutes: int = 15, query: str = "quarter_hours"):
        self.path, self.lateness, self.minutes, self.query = path, lateness, minutes, query

    def last_commit(self, spark: SparkSession, before: int | None = None) -> tuple[int, object]:
        """The newest committed batch (before another) and the newest event time until then; -1 and None
        without one. Only names are listed; one file of one row is read."""
        path, store = _files(spark, f"{self.path}/commits")
        found = [s.getPath().getName() for s in store.listStatus(path)] if store.exists(path) else []
        batches = [int(name.removeprefix("batch=")) for name in found if name.startswith("batch=")]
        batches = [b for b in batches if before is None or b < before]
        if not batches:
            return -1, None
        last = max(batches)
        row = spark.read.schema(_COMMITS).parquet(f"{self.path}/commits/batch={last}").first()
        if row is None or row.query != self.query:
            raise ValueError(f"{self.path} is kept by another query: {row and row.query}")
        return last, row.newest

    def add(self, batch: DataFrame, number: int) -> None:
        """Takes a batch of :func:`pulseboard.plans.alerts.marks` in, for ``foreachBatch``."""
        spark = batch.sparkSession
        last, newest = self.last_commit(spark)
        if number <= last:
            return  # it was committed, and the query restarted before it noted that
        open_since = F.lit(newest).cast("timestamp") - F.expr(f"INTERVAL {self.lateness}")
        is_late = F.coalesce(F.col("time") < open_since, F.lit(False)) if newest else F.lit(False)
        sums = (
            batch.where("time IS NOT NULL")
            .withColumn("is_late", is_late)
            .withColumn(BUCKET, quarter_hour(F.col("time"), self.minutes))
            .groupBy(BUCKET, "user_id", "is_late")
            .agg(*user_sums(), F.max("time").alias("newest"))
            .withColumn("day", F.to_date(BUCKET))
            .withColumn("batch", F.lit(number).cast("long"))
        )
        # Computed once: the split into two tables, the touched days and the newest time all come from here.
        staged = f"{self.path}/staged"
        sums.write.mode("overwrite").parquet(staged)
        sums = spark.read.schema(sums.schema).parquet(staged)
        for late, name in ((False, "sums"), (True, "late")):
            self._replace(sums.where(F.col("is_late") == late).select(_SUMS.fieldNames()), name)
        touched = sums.where("NOT is_late")
        days = [r.day for r in touched.select("day").distinct().orderBy("day").collect()]
        kept = _read(spark, f"{self.path}/sums", _SUMS, days).where(F.col("batch") <= number)
        per_user = (
            kept.join(touched.select(BUCKET).distinct(), BUCKET, "left_semi")
            .groupBy(BUCKET, "user_id")
            .agg(*[F.sum(c).alias(c) for c in COUNTS])
        )
        versions = bucket_counts(per_user.groupBy(BUCKET)).select(
            BUCKET, *METRICS, F.to_date(BUCKET).alias("day"), F.lit(number).cast("long").alias("batch")
        )
        self._replace(versions, "metrics")
        seen = touched.agg(F.max("newest")).first()[0]
        self._commit(spark, number, max((t for t in (newest, seen) if t is not None), default=None))

    def _commit(self, spark: SparkSession, number: int, newest) -> None:
        done = spark.createDataFrame([(self.query, number, newest)], _COMMITS)
        done.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/commits/batch={number}")

    def _replace(self, rows: DataFrame, name: str) -> None:
        """Puts a batch's rows in place of what an earlier run of the same batch left."""
        (
            rows.hint("rebalance", F.col("day"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("day", "batch")
            .parquet(f"{self.path}/{name}")
        )

    def metrics(self, spark: SparkSession, with_ctr: bool = False) -> DataFrame:
        """The newest committed version of each bucket."""
        last, _ = self.last_commit(spark)
        versions = _read(spark, f"{self.path}/metrics", _VERSIONS).where(F.col("batch") <= last)
        newest = F.max_by(F.struct(*METRICS), "batch").alias("newest")
        rows = versions.groupBy(BUCKET).agg(newest).select(BUCKET, *[f"newest.{m}" for m in METRICS])
        return rows.withColumn("ctr", ratio(F.col("likes"), F.col("views"))) if with_ctr else rows

    def late(self, spark: SparkSession) -> DataFrame:
        """What came too late: per bucket, user and batch what would have been added."""
        last, _ = self.last_commit(spark)
        return _read(spark, f"{self.path}/late", _SUMS).where(F.col("batch") <= last).drop("day")


def start_corrected(
    feed: DataFrame,
    messages: DataFrame,
    store: BucketStore,
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Keeps a store up to date with both logs. No state is held between batches; ``every`` is the
    trigger's interval, without it the stream takes in what is there and ends."""
    rows = marks(feed, messages, ["time", "user_id"])
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return rows.writeStream.foreachBatch(store.add).option("checkpointLocation", checkpoint).trigger(**trigger).start()
