"""The folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or a folder in the warehouse where that is unset, as in tests."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def own_dir(spark: SparkSession, name: str) -> str:
    """A new folder's place in the shared one."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def settled(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder and read back: computed once, and its lineage ends there."""
    path = own_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
