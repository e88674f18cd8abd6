"""Tables that an operator writes on its way."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseboard.sources.scratch import written

# Tables to look up rows in are broadcast up to so many rows, of a few numbers each.
BROADCAST_ROWS = 500_000


def checked(rows: DataFrame, name: str, size: Column | None = None) -> DataFrame:
    """The rows, written to the shared folder; to be broadcast if they are few, else shuffled. ``size`` says
    for how many rows each one counts, where rows are not a few numbers each."""
    rows = written(rows, name)
    total = rows.count() if size is None else rows.agg(F.sum(size.cast("long"))).first()[0] or 0
    return F.broadcast(rows) if total <= BROADCAST_ROWS else rows


def dropped(spark: SparkSession, path: str) -> None:
    """Deletes a table of the shared folder that nothing will read again."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
