"""Files that changed since they were last read, by a manifest of path, size and time; and tables that keep one part for each file."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ["path", "size", "changed"]
SCHEMA = "path string, size long, changed timestamp"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder. A table that was only written by partition has no _SUCCESS mark."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def listing(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, size, changed) of the files below a path; no file is opened."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    return found.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("changed"))


def contents(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, content) of files, named as in a listing."""
    return spark.read.format("binaryFile").load(paths).select("path", F.col("content").cast("string").alias("content"))


def changed(listed: DataFrame, known: DataFrame) -> DataFrame:
    """Files whose path, size and time the manifest doesn't have together."""
    return listed.join(known.select(*KEYS), KEYS, "left_anti")


class Manifest:
    """Versions of the table of known files; the highest counts. A version is written whole after the rows of its files, so what a lost job leaves is read again, never skipped."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def version(self) -> int:
        if not exists(self.spark, self.path):
            return 0
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(f"{self.path}/v*/_SUCCESS")
        found = at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at)
        return max((int(x.getPath().getParent().getName()[1:]) for x in found), default=0)

    def known(self) -> DataFrame:
        v = self.version()
        return self.spark.read.schema(SCHEMA).parquet(f"{self.path}/v{v}") if v else self.spark.createDataFrame([], SCHEMA)

    def replace(self, known: DataFrame) -> None:
        known.select(*KEYS).write.mode("overwrite").parquet(f"{self.path}/v{self.version() + 1}")


def refresh(spark: SparkSession, path: str, table: str, parse: Callable[[DataFrame], DataFrame], glob: str = "*", parts: int = 64, at_once: int = 10_000) -> dict[str, int]:
    """Brings a table up to date with the files below a path; only new and changed ones are opened.

    parse makes rows of (path, content), with `path` among their columns. The
    table lies in `parts` parts by hashes of paths; those with a changed file
    are written anew from the rows of their other files and the fresh ones,
    staged first, so a run that is lost can be repeated. Files that are gone
    keep their rows, as past answers do. How many files are there, were read, and stayed as they are.
    """
    manifest = Manifest(spark, f"{table}_manifest")
    listed = listing(spark, path, glob)
    now = f"{table}_staged/listed"
    listed.write.mode("overwrite").parquet(now)
    listed = spark.read.schema(SCHEMA).parquet(now)
    todo = changed(listed, manifest.known())
    paths = [r.path for r in todo.select("path").orderBy("path").collect()]  # Spark's own file index holds as many
    of = F.pmod(F.xxhash64("path"), F.lit(parts)).cast("int")
    for k in range(0, len(paths), at_once):
        own = paths[k : k + at_once]
        fresh = parse(contents(spark, own)).withColumn("part", of)
        staged = f"{table}_staged"
        fresh.write.mode("overwrite").parquet(f"{staged}/fresh")
        fresh = spark.read.schema(fresh.schema).parquet(f"{staged}/fresh")
        merged, mine = fresh, spark.createDataFrame([(p,) for p in own], "path string")
        if exists(spark, table):
            touched = [r.part for r in mine.select(of.alias("part")).distinct().collect()]
            old = spark.read.schema(fresh.schema).parquet(table).where(F.col("part").isin(touched)).select(*fresh.columns)
            merged = old.join(F.broadcast(mine), "path", "left_anti").unionByName(fresh)  # at_once rows
        merged.write.mode("overwrite").parquet(f"{staged}/merged")
        merged = spark.read.schema(fresh.schema).parquet(f"{staged}/merged")
        merged.repartition("part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(table)
    manifest.replace(listed.unionByName(manifest.known().join(listed, "path", "left_anti")))
    return {"files": listed.count(), "read": len(paths), "kept": listed.count() - len(paths)}
