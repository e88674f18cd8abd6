"""The dimension metrics table: one row per day, dimension and value."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from pulseboard.sources.scratch import written

DIMENSION_SCHEMA = T.StructType(
    [
        T.StructField("event_date", T.DateType()),
        T.StructField("dimension", T.StringType()),
        T.StructField("dimension_value", T.StringType()),
        T.StructField("views", T.LongType()),
        T.StructField("likes", T.LongType()),
        T.StructField("messages_received", T.LongType()),
        T.StructField("messages_sent", T.LongType()),
        T.StructField("users_sent", T.LongType()),
        T.StructField("users_received", T.LongType()),
    ]
)


def create_dimension_table(spark: SparkSession, table: str, location: str | None = None) -> None:
    """Create the table, partitioned by day, unless it exists."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in DIMENSION_SCHEMA)
    place = "LOCATION '{}'".format(location.replace("'", "\\'")) if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
        f"PARTITIONED BY (event_date) {place}"
    )


def write_dimension_metrics(
    metrics: DataFrame, table: str, mode: str = "replace", days: Sequence[date] | None = None
) -> None:
    """Store metrics by column name.

    ``replace`` swaps the given days, or without these the days present in ``metrics``, and leaves
    the others, so a retried or repeated run ends with the same rows. A given day without rows is
    cleared. Each day is one statement of its own, with no setting of the session involved, so
    writers of different days do not disturb each other. ``append`` only adds.
    """
    if mode not in ("replace", "append"):
        raise ValueError(f"mode must be 'replace' or 'append', not {mode!r}")
    spark = metrics.sparkSession
    if mode == "append":
        metrics.select(*spark.table(table).columns).write.insertInto(table)
        return
    if days is None or len(days) != 1:
        metrics = written(metrics, "dimension_metrics")  # computed once for all days
    if days is None:
        days = [row[0] for row in metrics.select("event_date").distinct().collect()]
    columns = [c for c in spark.table(table).columns if c != "event_date"]
    for day in sorted(days):
        spark.sql(
            f"INSERT OVERWRITE {table} PARTITION (event_date = DATE '{day}') "
            f"SELECT {', '.join(columns)} FROM {{rows}} WHERE event_date = DATE '{day}' "
            "ORDER BY dimension, dimension_value",
            rows=metrics,
        )
