"""Readings as a stream: weekly windows with late data, merged into a stored table batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rainledger.sources.manifest import exists
from rainledger.sources.tables import replace_by_key


def windowed(stream: DataFrame, unit: str, when: str, value: str, window: str = "7 days", late: str = "7 days") -> DataFrame:
    """(start, unit, n, total, low, high) by unit and window; readings later than the watermark allows are left out."""
    grouped = stream.withWatermark(when, late).groupBy(F.window(when, window).alias("w"), F.col(unit).alias("unit"))
    return grouped.agg(F.count(value).alias("n"), F.sum(value).alias("total"), F.min(value).alias("low"), F.max(value).alias("high")).select(F.col("w.start").alias("start"), "unit", "n", "total", "low", "high")


def upsert(stream: DataFrame, path: str, keys: list[str], checkpoint: str, by: str | None = None, prepare: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Keeps the last row of each key; prepare: what makes one row of a batch's rows of a key, if there may be more.

    With `by`, a column that follows from the keys, the table lies in path by
    its values, and a batch rewrites only those that it touches: it's merged
    into a staged table first, so a batch that is repeated after a failure finds
    either the old or the new rows and gives the same. Without, each batch
    writes the whole table anew under path/<batch>, for small tables.
    """

    def whole(batch: DataFrame, batch_id: int) -> None:
        batch = prepare(batch) if prepare else batch
        if batch_id:
            batch = replace_by_key(batch.sparkSession.read.parquet(f"{path}/{batch_id - 1}"), batch, keys)
        batch.write.mode("overwrite").parquet(f"{path}/{batch_id}")

    def touched(batch: DataFrame, batch_id: int) -> None:
        batch = prepare(batch) if prepare else batch
        spark, staged = batch.sparkSession, f"{path}_staged"
        batch.write.mode("overwrite").parquet(f"{staged}/fresh")
        fresh = spark.read.schema(batch.schema).parquet(f"{staged}/fresh")
        merged = fresh
        if exists(spark, path):
            old = spark.read.schema(fresh.schema).parquet(path).join(fresh.select(by).distinct(), by, "left_semi")
            merged = replace_by_key(old.select(*fresh.columns), fresh, keys)
        merged.write.mode("overwrite").parquet(f"{staged}/merged")
        spark.read.schema(fresh.schema).parquet(f"{staged}/merged").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)

    return stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(touched if by else whole).trigger(availableNow=True).start()
