"""Landed files end to end: each query writes the given tables as files of a source, reads them by it, and equals the SQL over the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rainledger.sources import feeds, manifest, sinks
from rainledger.sources.shared import own_dir
from rainledger.sources.tables import load
from rainledger.streaming.grids import ingest_grids

NATIONS, PAGE = 25, 1009


def raster_source(spark, sf_dir):
    """Orders of each day and nation as yearly rasters, read back day by day: months of each cell."""
    o = load(spark, sf_dir, "orders").join(load(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    path = own_dir(spark, "rasters")
    feeds.write_rasters(o.groupBy(F.to_date("o_orderdate").alias("day"), F.col("c_nationkey").alias("cell")).agg(F.count("*").alias("value")), path, NATIONS)
    days = feeds.rasters_by_year(spark, path, NATIONS).where("value IS NOT NULL")
    return days.groupBy(F.year("day").cast("long").alias("year"), F.month("day").cast("long").alias("month"), F.col("cell").cast("long").alias("cell")).agg(F.count("*").alias("days"), F.sum("value").cast("long").alias("orders"), F.max("value").cast("long").alias("most"))


def paged_source(spark, sf_dir):
    """Events as an answer in pages, with older pages left behind the short one."""
    e = load(spark, sf_dir, "events")
    last = e.agg(F.floor(F.max("event_id") / PAGE).alias("last"))
    row = F.to_json(F.struct("event_id", "event_type", "value"))
    pages = e.select(F.floor(F.col("event_id") / PAGE).alias("page"), "event_id", row.alias("row"))
    old = pages.join(F.broadcast(last)).select((F.col("page") + F.col("last") + 1).alias("page"), "event_id", "row")  # one row
    path = own_dir(spark, "pages")
    feeds.write_pages(pages.unionByName(old), path, "page", "row", "event_id")
    got = feeds.paged(spark, path, PAGE)
    of = lambda k, t: F.get_json_object("row", f"$.{k}").cast(t).alias(k)
    return got.select(F.col("page").cast("long").alias("page"), F.col("place").cast("long").alias("place"), of("event_id", "long"), of("event_type", "string"), of("value", "double"))


def _weekly(e: DataFrame) -> DataFrame:
    week = F.date_trunc("week", "ts").cast("date")
    cents = F.sum(F.round(F.col("value") * 100).cast("long"))
    return e.groupBy(week.alias("week"), (F.col("user_id") % 50).alias("lat"), F.floor(F.col("user_id") / 50).alias("lon")).agg((cents / 100.0).alias("value"))


def stream_weekly_grids(spark, sf_dir):
    """Weekly sums of events as grids that land twice: up to 12 January at first, then the weeks from 8 January on with all that came since; the stream merges each file once."""
    e = load(spark, sf_dir, "events")
    path, table, checkpoint = (own_dir(spark, x) for x in ("grids", "index", "progress"))
    early = _weekly(e.where("ts < '2024-01-12'"))
    late = _weekly(e).where("week >= '2024-01-08'")
    for landed in (early, late):
        text = landed.select(F.date_format("week", "yyyyMMdd").alias("grid"), F.concat_ws(" ", "lat", "lon", "value").alias("line"))
        text.repartition("grid").write.mode("append").partitionBy("grid").text(path)
        ingest_grids(spark, path, table, checkpoint, r"grid=(\d{8})", 2).awaitTermination()
    got = spark.read.parquet(table)
    return got.select(F.date_format("week", "yyyy-MM-dd").alias("week"), F.col("lat").cast("long").alias("lat"), F.col("lon").cast("long").alias("lon"), F.col("value").cast("double").alias("value"))


def manifest_refresh(spark, sf_dir):
    """Customers as a file for each nation: all are read with half of the customers, then the files that change with the others."""
    c = load(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").cast("long").alias("nation"), F.round(F.col("c_acctbal") * 100).cast("long").alias("cents"))
    c = c.withColumn("line", F.concat_ws(";", "c_custkey", "nation", "cents")).withColumn("file", F.concat(F.lit("nation_"), F.col("nation"), F.lit(".csv")))
    first = F.col("c_custkey") <= F.floor(c.select(F.max("c_custkey")).scalar() / 2)
    path, table = own_dir(spark, "answers"), own_dir(spark, "customers")
    of = lambda i, n: F.split("row", ";")[i].cast("long").alias(n)
    parse = lambda raw: raw.select("path", F.explode(F.split("content", "\n")).alias("row")).where("row != ''").select("path", of(0, "c_custkey"), of(1, "nation"), of(2, "cents"))
    # nations of the first three regions' keys land whole; the others are replaced by their whole files later
    feeds.write_files(c.where(first | (F.col("nation") < 15)), path, "file", "line", "c_custkey")
    manifest.refresh(spark, path, table, parse, "*.csv", parts=8)
    feeds.write_files(c.where(F.col("nation") >= 15), path, "file", "line", "c_custkey")
    manifest.refresh(spark, path, table, parse, "*.csv", parts=8)
    return spark.read.parquet(table).select("c_custkey", "nation", "cents")


def bucketed_join(spark, sf_dir):
    """Orders by customer beside the customers, both stored in buckets by customer: the join moves no rows."""
    o = load(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("customer")).agg(F.count("*").alias("orders"), F.max(F.to_date("o_orderdate")).alias("last"))
    c = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer"), F.col("c_nationkey").cast("long").alias("nation"))
    left, right = (sinks.write_bucketed(df, own_dir(spark, n), ["customer"], 16) for df, n in ((o, "orders"), (c, "owners")))
    return left.join(right.hint("merge"), "customer").select("customer", "nation", "orders", F.date_format("last", "yyyy-MM-dd").alias("last"))


def sorted_store(spark, sf_dir):
    """Orders by nation and day stored in order: the rows that follow one of the same nation in their file, and the files' borders, in numbers."""
    o = load(spark, sf_dir, "orders").join(load(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    t = o.groupBy(F.col("c_nationkey").cast("long").alias("nation"), F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("orders"))
    path = own_dir(spark, "sorted")
    sinks.write_sorted(t, path, ["nation", "day"], 8)
    out_of_order = sinks.out_of_order(spark, path, ["nation", "day"])
    return spark.read.parquet(path).groupBy("nation").agg(F.count("*").alias("days"), F.sum("orders").alias("orders")).withColumn("out_of_order", F.lit(out_of_order).cast("long"))


QUERIES = {f.__name__: f for f in (raster_source, paged_source, stream_weekly_grids, manifest_refresh, bucketed_join, sorted_store)}

SQL = {
    "raster_source": "WITH d AS (SELECT o_orderdate::DATE AS day, c_nationkey AS cell, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL) SELECT year(day) AS year, month(day) AS month, cell::BIGINT AS cell, count(*) AS days, sum(n)::BIGINT AS orders, max(n) AS most FROM d GROUP BY ALL",
    "paged_source": f"SELECT event_id // {PAGE} AS page, event_id % {PAGE} AS place, event_id, event_type, value FROM events",
    "stream_weekly_grids": "SELECT strftime(date_trunc('week', ts), '%Y-%m-%d') AS week, user_id % 50 AS lat, user_id // 50 AS lon, sum(round(value * 100)::BIGINT)::BIGINT / 100.0 AS value FROM events GROUP BY ALL",
    "manifest_refresh": "SELECT c_custkey, c_nationkey::BIGINT AS nation, round(c_acctbal * 100)::BIGINT AS cents FROM customer",
    "bucketed_join": "SELECT o_custkey AS customer, c_nationkey::BIGINT AS nation, count(*) AS orders, strftime(max(o_orderdate), '%Y-%m-%d') AS last FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL",
    "sorted_store": "SELECT c_nationkey::BIGINT AS nation, count(DISTINCT o_orderdate::DATE) AS days, count(*) AS orders, 0::BIGINT AS out_of_order FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL",
}
