"""Starting the streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from pulseboard.session import settings

# State lives in RocksDB and is checkpointed as a log of changes, not as whole snapshots.
_STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

STORES_A_CORE = 2


def few_partitions(spark: SparkSession) -> int:
    """Partitions that keep all cores busy, and no more than the session asks for."""
    asked = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(asked, STORES_A_CORE * spark.sparkContext.defaultParallelism)


def start(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = None,
    close_by: str = "slower",
    partitions: int | None = None,
) -> StreamingQuery:
    """Append a stream to Parquet files, exactly once.

    ``close_by`` says which log's watermark closes buckets. By the "slower" no row within the
    lateness is ever lost, but while one log is silent nothing is emitted, and the state of all
    open buckets grows. By the "faster" the stream goes on without the silent log and its state stays
    bounded by the lateness; rows with which the slower log then comes later than that are dropped.
    Alerting wants "faster", bookkeeping "slower". A log read from files is
    best taken in order and in steps (see :func:`pulseboard.sources.stream_log`), so that each
    step closes buckets and a long backfill needs no more state than a day.

    ``every`` is the trigger's interval, such as ``"15 minutes"``; without it the
    stream takes in what is there and ends. ``checkpoint`` must be on storage that
    all executors reach. State is kept in RocksDB, so it need not fit in memory. The number
    of shuffle partitions is fixed by the first run of a checkpoint: choose it for the load
    to come. ``partitions`` is that number, without it the session's counts. Each partition of each
    operator is a store that every step opens, writes and commits, however few rows it has, so a few for
    each core are enough: see :func:`few_partitions`.
    """
    policies = {"slower": "min", "faster": "max"}
    if close_by not in policies:
        raise ValueError(f"close_by must be 'slower' or 'faster', not {close_by!r}")
    conf = {**_STATE_CONF, "spark.sql.streaming.multipleWatermarkPolicy": policies[close_by]}
    if partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(partitions)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    with settings(stream.sparkSession, conf):
        return (
            stream.writeStream.format("parquet")
            .outputMode("append")
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger)
            .start()
        )
