"""Dimension metrics published many days at a time, all or nothing.

A folder holds versions, written in one job each, and manifests. A manifest says for each day which version
holds it; the newest one is the table. Publishing stages the new days as a version of their own, where no
reader looks, and then creates the next manifest under a name that only one writer can take. So a reader
sees a month as it was or as it is, a writer that dies leaves the table as it was, and two writers at once
both succeed: the one that comes second builds on the first one's manifest. A day without
rows is in no version. The files of days that were replaced stay until ``vacuum``, for readers who still use them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseboard.sources.tables import DIMENSION_SCHEMA

_DAY = "day"  # the folders' column; the files have event_date themselves


class _Store:
    """The few file operations that publishing needs, by Spark's own file systems."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark.sparkContext._jvm
        self._root = self.path(root)
        self._files = self._root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def names(self, folder: str) -> list[str]:
        place = self.path(folder)
        return [s.getPath().getName() for s in self._files.listStatus(place)] if self._files.exists(place) else []

    def text(self, name: str) -> str:
        stream = self._files.open(self.path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def claim(self, name: str, text: str) -> bool:
        """Creates a file with its whole text at once; False if the name is taken."""
        place, draft = self.path(name), self.path(f"{name}.{uuid.uuid4().hex}.draft")
        self._files.mkdirs(place.getParent())
        stream = self._files.create(draft, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if not self._files.exists(place) and self._files.rename(draft, place):
            return True
        self._files.delete(draft, False)
        return False

    def delete(self, name: str) -> None:
        self._files.delete(self.path(name), True)


def _manifest(store: _Store, root: str) -> tuple[int, dict[str, str]]:
    """The newest manifest's number and its days; 0 and no days before the first."""
    numbers = [int(n.removesuffix(".json")) for n in store.names(f"{root}/manifests") if n.endswith(".json")]
    if not numbers:
        return 0, {}
    return max(numbers), json.loads(store.text(f"{root}/manifests/{max(numbers):012d}.json"))


def publish_dimension_metrics(metrics: DataFrame, root: str, days: Sequence[date] | None = None) -> int:
    """Replaces the given days (without these, the days that ``metrics`` has) in one step.

    Given days without rows are cleared. Rows of other days are refused. One job writes all days; a
    heavy day is cut into several files. Returns the manifest's number.
    """
    spark = metrics.sparkSession
    store = _Store(spark, root)
    version = uuid.uuid4().hex
    rows = metrics.select(DIMENSION_SCHEMA.fieldNames())
    (
        rows.withColumn(_DAY, F.col("event_date"))
        .hint("rebalance", F.col(_DAY))
        .sortWithinPartitions(_DAY, "dimension", "dimension_value")
        .write.partitionBy(_DAY)
        .parquet(f"{root}/versions/{version}")
    )
    written = {n.removeprefix(f"{_DAY}=") for n in store.names(f"{root}/versions/{version}") if n.startswith(f"{_DAY}=")}
    replaced = written if days is None else {str(d) for d in days}
    if written - replaced:
        raise ValueError(f"rows of days that are not to be replaced: {sorted(written - replaced)}")
    while True:
        number, there = _manifest(store, root)
        kept = {day: place for day, place in there.items() if day not in replaced}
        text = json.dumps(kept | dict.fromkeys(written, version), sort_keys=True)
        if store.claim(f"{root}/manifests/{number + 1:012d}.json", text):
            return number + 1


def read_dimension_metrics(spark: SparkSession, root: str, days: Sequence[date] | None = None) -> DataFrame:
    """The published rows, or those of some days: only these days' folders are looked at."""
    _, there = _manifest(_Store(spark, root), root)
    wanted = there if days is None else {str(d) for d in days} & set(there)
    folders = [f"{root}/versions/{there[day]}/{_DAY}={day}" for day in sorted(wanted)]
    if not folders:
        return spark.createDataFrame([], DIMENSION_SCHEMA)
    return spark.read.schema(DIMENSION_SCHEMA).parquet(*folders)


def vacuum(spark: SparkSession, root: str) -> list[str]:
    """Deletes versions and manifests before the newest that it does not use; to be run when no reader of
    an older manifest and no writer is at work. Returns the versions' names."""
    store = _Store(spark, root)
    number, there = _manifest(store, root)
    gone = sorted(set(store.names(f"{root}/versions")) - set(there.values()))
    for version in gone:
        store.delete(f"{root}/versions/{version}")
    for name in store.names(f"{root}/manifests"):
        if name.endswith(".json") and int(name.removesuffix(".json")) < number:
            store.delete(f"{root}/manifests/{name}")
    return gone
