"""Small helpers that the corpus operators share."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one in the warehouse where that is unset (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        spark.conf.set("spark.checkpoint.dir", found)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(found)
    return found


#: Spark's setting that a query's shuffle files go when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Spark's limit of an Arrow batch's bytes, 64 MB unless set.
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession, most: int = 8 << 20) -> None:
    """From now on Arrow batches of this session have about so many bytes at most, unless it has a limit of its own: what executors hold of them lies outside the heap, in both processes."""
    if spark.conf.get(BATCH, None) is None:
        spark.conf.set(BATCH, str(most))


class Scratch:
    """Tables of one operator in the shared folder: lineage ends there and each is computed once.

    A table's shuffle files go when it's written, and tables that no later step
    reads are dropped, so disk holds what is in use only.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.top = spark, f"{shared_dir(spark).rstrip('/')}/t-{uuid.uuid4().hex}"
        self.paths: list[tuple[DataFrame, str]] = []

    def settled(self, df: DataFrame) -> DataFrame:
        """df, written and read back."""
        path = f"{self.top}/{len(self.paths)}-{uuid.uuid4().hex[:8]}"
        before = self.spark.conf.get(CLEANUP, "false")
        self.spark.conf.set(CLEANUP, "true")
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.set(CLEANUP, before)
        back = self.spark.read.schema(df.schema).parquet(path)
        self.paths.append((back, path))
        return back

    def drop(self, *frames: DataFrame) -> None:
        """Deletes these settled tables; nothing may read them any more."""
        self._delete([p for df, p in self.paths if any(df is x for x in frames)])

    def keep(self, *frames: DataFrame) -> None:
        """Deletes all settled tables but these."""
        self._delete([p for df, p in self.paths if not any(df is x for x in frames)])

    def _delete(self, paths: list[str]) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for path in paths:
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(conf).delete(at, True)
        self.paths = [x for x in self.paths if x[1] not in paths]


def settled(df: DataFrame) -> DataFrame:
    """df, written to the shared folder and read back, for good."""
    return Scratch(df.sparkSession).settled(df)


def crc(column: Column) -> Column:
    return F.crc32(column.cast("string").cast("binary"))


def release() -> None:
    """Gives freed memory of a Python worker back to the system, so that reused workers don't add up within an executor."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def per_batch(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, most: int = 1024) -> DataFrame:
    """work on each Arrow batch of df, at most so many rows at a time; Spark bounds a batch's bytes (spark.sql.execution.arrow.maxBytesPerBatch)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, most):
                yield work(batch.slice(k, most))
            release()

    return df.mapInArrow(run, schema)


def utf8(column: pa.Array) -> list[bytes]:
    """The bytes of a string column; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]
