"""Files and tables in the folder that a cluster's machines share (``spark.checkpoint.dir``)."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names.

    Where it is unset, a local session gets a folder of its own; on a cluster each machine would
    then write to its own disk, so that raises an error.
    """
    folder = spark.conf.get(SETTING, None)
    if not folder:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError(f"{SETTING} has to name a folder that all machines share")
        folder = f"file://{tempfile.mkdtemp(prefix='shared-')}"
        spark.conf.set(SETTING, folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used yet."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: cuts lineage, and survives lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
