"""Spark session helpers.

The engine itself never creates a session: every function takes DataFrames
or a ``SparkSession``. These helpers are for tests, the benchmark and the
command line, and they only fill in settings the cluster left unset.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings the engine relies on; applied only where the cluster has none.
ENGINE_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key's partition even where the next aggregate could have used the join's partitioning:
    # the extra shuffle then happens only in the skewed case.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Joins whose partitions all stay below this (as shuffled) build hash tables instead of sorting both sides; larger
    # ones are sorted. The two settings have to be equal for it.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "32m",
    "spark.sql.session.timeZone": "UTC",
    # Recording the Python line of every column expression takes most of the time in which a query is built.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tariff_engine",
                  driver_memory: str = "8g") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", driver_memory)
    )
    for key, value in ENGINE_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
