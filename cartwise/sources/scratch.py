"""Tables a job writes on its way, in the shared checkpoint folder, all in one folder of the application."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from cartwise.session import checkpoint_dir
from cartwise.sources.keyed import delete_folder


def _home(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/cartwise-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path nobody has yet."""
    return f"{_home(spark)}/{name}-{uuid.uuid4().hex}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """The rows written once and read back: a lineage cut, and a table whose size the planner knows.

    What the writing shuffled is deleted as soon as it is done; else it would stay until the driver collects garbage.
    """
    spark = df.sparkSession
    path, before = scratch_path(spark, name), spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete all of this application's; results made of them must be written by then."""
    delete_folder(spark, _home(spark))
