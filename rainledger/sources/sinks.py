"""Sinks: partitioned tables, flat files, strict JSON documents, archives that are written once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DoubleType, FloatType, MapType, StructType

from rainledger.functions.columns import finite
from rainledger.functions.names import finished_season
from rainledger.operators.shape import positional


def strict(x: Column, kind: DataType) -> Column:
    """NaN and infinities as null, at any depth."""
    if isinstance(kind, (DoubleType, FloatType)):
        return finite(x)
    if isinstance(kind, StructType):
        return F.when(x.isNotNull(), F.struct(*[strict(x[f.name], f.dataType).alias(f.name) for f in kind]))
    if isinstance(kind, ArrayType):
        return F.transform(x, lambda v: strict(v, kind.elementType))
    if isinstance(kind, MapType):
        return F.transform_values(x, lambda _, v: strict(v, kind.valueType))
    return x


def strict_rows(df: DataFrame) -> DataFrame:
    return df.select(*[strict(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema])


def narrowed(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Columns cast to the narrower types that they're stored with."""
    return df.withColumns({c: F.col(c).cast(k) for c, k in kinds.items()})


def write_parts(df: DataFrame, path: str, by: list[str]) -> None:
    """Parquet by partition; only the partitions that df has are replaced. Rows are dealt by the partition first, so each gets few files."""
    df.repartition(*by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def write_csv(df: DataFrame, path: str, quoted: bool = False) -> None:
    """One CSV file with a header, for tables that people open; quoted: all values in quotes."""
    df.coalesce(1).write.mode("overwrite").option("header", True).option("quoteAll", quoted).csv(path)


def keyed(rows: DataFrame, key: str, meta: dict[str, Column] | None = None, counted: list[str] = ()) -> DataFrame:
    """(document): one JSON text of what is known of all, the counts of some columns' values, and the rows by key. For layers of a bounded number of keys."""
    clean, rest = strict_rows(rows), [c for c in rows.columns if c != key]
    by_key = F.array_sort(F.collect_list(F.struct(F.col(key).cast("string").alias("k"), F.struct(*rest).alias("v"))), lambda a, b: F.when(a["k"] < b["k"], -1).when(a["k"] > b["k"], 1).otherwise(0))
    values = [F.sort_array(F.collect_list(F.coalesce(F.col(c).cast("string"), F.lit("None")))).alias(f"{c}_counts") for c in counted]
    one = clean.agg(F.map_from_entries(by_key).alias("rows"), *values)
    counts = lambda c: F.map_from_entries(F.transform(F.array_distinct(c), lambda x: F.struct(x, F.size(F.filter(c, lambda y: y == x)))))
    said = [v.alias(k) for k, v in (meta or {}).items()] + [counts(F.col(f"{c}_counts")).alias(f"{c}_counts") for c in counted]
    return one.select(F.to_json(F.struct(*said, "rows"), {"ignoreNullFields": "false"}).alias("document"))


def write_json_parts(df: DataFrame, path: str, by: list[str]) -> None:
    """Strict JSON lines, a folder for each value of the partition columns."""
    strict_rows(df).repartition(*by).write.mode("overwrite").option("ignoreNullFields", "false").partitionBy(*by).json(path)


def snapshot_rows(history: DataFrame, snapshot: str, key: str, fields: list[str]) -> DataFrame:
    """(snapshot, key, row): the fields of each row as an array of texts, so that their names are written once."""
    return history.select(snapshot, key, positional(fields).alias("row"))


def index_of(history: DataFrame, snapshot: str, judged: str, layers: dict[str, str]) -> DataFrame:
    """(snapshots, classified, layer_from): all dates, how many rows of each are judged, and the first date that each layer has data on."""
    per = history.groupBy(snapshot).agg(F.count(judged).alias("n"), *[F.count(F.nullif(F.col(c).cast("string"), F.lit(""))).alias(f"n_{k}") for k, c in layers.items()])
    first = F.struct(*[F.min(F.when(F.col(f"n_{k}") > 0, F.col(snapshot))).alias(k) for k in layers])
    both = F.sort_array(F.collect_list(F.struct(snapshot, "n")))
    return per.agg(F.transform(both, lambda x: x[snapshot]).alias("snapshots"), F.map_from_entries(both).alias("classified"), first.alias("layer_from"))


def archive(df: DataFrame, path: str, keys: list[str]) -> int:
    """Appends the rows whose keys the archive lacks; what is archived never changes. How many keys were new."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    there = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
    fresh = df.join(spark.read.parquet(path).select(*keys).distinct(), keys, "left_anti") if there else df
    n = fresh.select(*keys).distinct().count()
    if n:
        fresh.write.mode("append").parquet(path)
    return n


def archive_finished(windows: DataFrame, path: str, start: str, end: str) -> int:
    """Archives windows of whole seasons, each once, by season and year: running ones wait, and what came later doesn't change an archived one. How many seasons were new."""
    rows = windows.withColumn("season", finished_season(F.col(start), F.col(end))).where("season IS NOT NULL").withColumn("season_year", F.year(end))
    return archive(rows, path, ["season", "season_year"])


def write_sorted(df: DataFrame, path: str, by: list[str], files: int) -> None:
    """Parquet in order, within files and from file to file by name: a range of keys lies in few files, which statistics tell from the others. No task holds more than its range."""
    df.repartitionByRange(files, *by).sortWithinPartitions(*by).write.mode("overwrite").parquet(path)


def out_of_order(spark: SparkSession, path: str, by: list[str]) -> int:
    """How many rows, in the order in which they are stored, come before the row in front of them; files are in the order of their names, and null is lowest."""
    key = F.struct(*by)
    rows = spark.read.parquet(path).select(key.alias("k"), F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at"))
    inside = rows.withColumn("before", F.lag("k").over(W.partitionBy("file").orderBy("at"))).where("before > k").count()
    ends = rows.groupBy("file").agg(F.min("k").alias("low"), F.max("k").alias("high")).where("high IS NOT NULL")
    across = ends.withColumn("before", F.lag("high").over(W.orderBy("file"))).where("before > low").count()  # a row a file
    return inside + across


def write_bucketed(df: DataFrame, path: str, by: list[str], buckets: int) -> DataFrame:
    """df in buckets by some columns, sorted by them within; joins and groups by them need no exchange. The table is named by the last part of its path."""
    name = "t_" + "".join(c if c.isalnum() else "_" for c in path.rstrip("/").rpartition("/")[2])
    spread = df.repartition(buckets, *by)  # rows go where their bucket is, so each has one file
    spread.write.mode("overwrite").option("path", path).bucketBy(buckets, *by).sortBy(*by).saveAsTable(name)
    return df.sparkSession.table(name)
