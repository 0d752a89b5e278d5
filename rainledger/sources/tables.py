"""Sources and sinks."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rainledger.functions.columns import finite


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rasters(spark: SparkSession, path: str, cells: int, missing_below: float = -998.0) -> DataFrame:
    """(file, day, cell, value) of little-endian float32 rasters of so many cells a day; missing cells are null, a file of another size raises."""

    def decode(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                raw = np.frombuffer(batch.column("content")[i].as_py(), "<f4")
                if len(raw) % cells:
                    raise ValueError(f"{batch.column('path')[i]}: {len(raw)} values aren't whole days of {cells}")
                for day, grid in enumerate(raw.reshape(-1, cells)):
                    values = grid.astype(np.float64)
                    arrays = [pa.array([batch.column("path")[i].as_py()] * cells), pa.array(np.full(cells, day, np.int32)), pa.array(np.arange(cells, dtype=np.int32)), pa.array(values, mask=values <= missing_below)]
                    yield pa.RecordBatch.from_arrays(arrays, ["file", "day", "cell", "value"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(decode, "file string, day int, cell int, value double")


def readings(spark: SparkSession, path: str, *more: str, prefix: str = "Groundwater Level") -> DataFrame:
    """(station, lat, lon, t, value) of CSV files whose value column is found by the start of its name; rows that don't parse go.

    Each path has files of one header; different paths may name the value differently.
    """
    if more:
        return reduce(DataFrame.unionByName, [readings(spark, p, prefix=prefix) for p in (path, *more)])
    raw = spark.read.option("header", True).csv(path)
    value = next((c for c in raw.columns if c.startswith(prefix)), None)
    if value is None:
        raise ValueError(f"{path}: no column starts with {prefix}")
    number = lambda c: finite(F.expr(f"try_cast(`{c}` AS double)"))
    out = raw.select(F.col("Station").alias("station"), number("Latitude").alias("lat"), number("Longitude").alias("lon"), F.expr("try_to_timestamp(`Data Acquisition Time`, 'dd-MM-yyyy HH:mm')").alias("t"), number(value).alias("value"))
    return out.dropna(subset=["lat", "lon", "t", "value"])


def index_grids(spark: SparkSession, path: str) -> DataFrame:
    """(week, lat, lon, value) of white-space grids whose date is in the file name; rows without a place go, NaN values are null."""
    parts = F.split(F.trim("value"), r"\s+")
    number = lambda i: finite(F.get(parts, F.lit(i)).try_cast("double"))
    week = F.to_date(F.regexp_extract(F.col("_metadata.file_name"), r"(\d{8})", 1), "yyyyMMdd")
    return spark.read.text(path).select(week.alias("week"), number(0).alias("lat"), number(1).alias("lon"), number(2).alias("value")).dropna(subset=["lat", "lon"])


def headed_lines(lines: DataFrame, group: str, order: str, text: str, heading: str) -> DataFrame:
    """Adds heading: the last line at or before each that matches, within its group."""
    from pyspark.sql import Window as W

    w = W.partitionBy(group).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    return lines.withColumn("heading", F.last(F.when(F.col(text).rlike(heading), F.col(text)), ignorenulls=True).over(w))


def write_json(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    """Strict JSON: NaN and infinities are null, null fields stay."""
    clean = df.select(*[finite(F.col(c)).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes])
    (clean.write.partitionBy(*by) if by else clean.write).mode("overwrite").option("ignoreNullFields", "false").json(path)


def replace_by_key(stored: DataFrame, fresh: DataFrame, keys: list[str]) -> DataFrame:
    """Stored rows whose key the fresh ones lack, and the fresh ones."""
    return stored.join(fresh.select(*keys).distinct(), keys, "left_anti").unionByName(fresh)
