"""Folders for tables and checkpoints that a run writes on the side."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach.

    ``spark.checkpoint.dir`` names it. Without that it lies in the session's warehouse if executors reach
    this as well: in a session of one machine, or where the warehouse is in a store. A folder of
    the driver's machine is refused on a cluster.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        one_machine = re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master)
        if not one_machine and warehouse.split(":")[0] in ("file", warehouse):
            raise RuntimeError(f"{CHECKPOINT_DIR} must name a folder that all executors reach")
        folder = f"{warehouse}/_scratch"
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(table: DataFrame, name: str) -> DataFrame:
    """The table after a round trip through the shared folder, which ends its lineage."""
    spark = table.sparkSession
    path = new_folder(spark, name)
    table.write.parquet(path)
    return spark.read.schema(table.schema).parquet(path)
