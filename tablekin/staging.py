"""Tables written between two steps of a job.

A few operators need a result twice with exactly the same layout.  They write it
as a parquet table into the cluster's shared folder, so a lost executor only
repeats reads and never changes the outcome.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_folder: tempfile.TemporaryDirectory | None = None


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir`` (or set on the context).

    Only a local session without one gets a temporary folder; on a cluster a
    machine-local folder would not be seen by the executors, so that is an error.
    """
    global _local_folder
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    if _local_folder is None:
        _local_folder = tempfile.TemporaryDirectory(prefix="tablekin-")
    return _local_folder.name


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has used yet."""
    return f"{shared_folder(spark).rstrip('/')}/tablekin/{label}-{uuid.uuid4().hex}"


def stage_table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return a reader of the written table."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
