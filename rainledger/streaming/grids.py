"""Weekly index grids as a stream of files: each file is read once, whatever runs are lost in between."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rainledger.functions.columns import finite
from rainledger.streaming.upserts import upsert


def grid_stream(spark: SparkSession, path: str, named: str = r"(\d{8})", files_a_batch: int = 64) -> DataFrame:
    """(week, lat, lon, value, changed) of the grids that land below a path; the week is in the path, by the first group of `named`. Rows without a place or week go, NaN values are null.

    The checkpoint of the query that reads it keeps which files are done, so the
    driver lists the folder and holds no list of its own.
    """
    lines = spark.readStream.schema("value string").option("maxFilesPerTrigger", files_a_batch).option("recursiveFileLookup", "true").text(path)
    parts = F.split(F.trim("value"), r"\s+")
    number = lambda i: finite(F.get(parts, F.lit(i)).try_cast("double"))
    week = F.try_to_date(F.regexp_extract(F.col("_metadata.file_path"), named, 1), "yyyyMMdd")
    out = lines.select(week.alias("week"), number(0).alias("lat"), number(1).alias("lon"), number(2).alias("value"), F.col("_metadata.file_modification_time").alias("changed"))
    return out.dropna(subset=["week", "lat", "lon"])


def ingest_grids(spark: SparkSession, path: str, table: str, checkpoint: str, named: str = r"(\d{8})", files_a_batch: int = 64) -> StreamingQuery:
    """Merges the grids that aren't read yet into a table by week and ends; of a cell that stands in several files of a batch, the latest file's value counts, and later batches replace earlier ones."""
    stream = grid_stream(spark, path, named, files_a_batch)
    latest = lambda df: df.groupBy("week", "lat", "lon").agg(F.max_by("value", F.struct("changed", "value")).alias("value"))
    return upsert(stream, table, ["week", "lat", "lon"], checkpoint, by="week", prepare=latest)
