"""The run that publishes the status: steps over one stored table, each by itself, and the gate that decides whether the outputs go out."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rainledger.functions import names as N
from rainledger.operators.incremental import in_steps
from rainledger.plans import status as S
from rainledger.sources import sinks
from rainledger.sources.shared import own_dir
from rainledger.sources.tables import load

#: What a row of a snapshot's document says, by position.
FIELDS = ["code", "category", "dep", "source", "dry_weeks", "tier", "pct", "stress", "index_class"]
#: Layers whose first dates the index has, by a column that only they fill.
LAYERS = {"quadrant": "quadrant", "rain": "category", "level": "pct", "stress": "stress", "index": "index_class"}
MUST_PASS = {"status", "snapshots", "index"}


def steps(spark: SparkSession, out: str, status: Callable[[], DataFrame], names: Callable[[], DataFrame]) -> dict[str, Callable[[], None]]:
    """The steps by name, in their order; all but the first read what the first has stored, of this run or of an earlier one.

    status: the table of stored snapshots, by snapshot; snapshots and districts:
    strict JSON lines, a folder for each; index: all dates, how many districts
    each judges and where layers begin; table: the last judged snapshot as CSV.
    """

    def stored() -> DataFrame:
        return spark.read.parquet(f"{out}/status").withColumn("snapshot", F.col("snapshot").cast("string")).withColumn("code", N.coded(F.col("quadrant"), N.QUADRANT_CODES)).withColumn("dep", F.col("dep") + 0.0)  # no -0.0 in texts

    def table() -> None:
        s = stored()
        last = s.where("quadrant IS NOT NULL").agg(F.max("snapshot").alias("snapshot"))
        rows = s.join(F.broadcast(last), "snapshot").join(names(), "district").select("district", "name", "snapshot", "quadrant", *FIELDS[1:])  # one row
        sinks.write_csv(rows, f"{out}/table", quoted=True)

    return {
        "status": lambda: sinks.write_parts(status(), f"{out}/status", ["snapshot"]),
        "snapshots": lambda: sinks.write_json_parts(sinks.snapshot_rows(sinks.strict_rows(stored()), "snapshot", "district", FIELDS), f"{out}/snapshots", ["snapshot"]),
        "districts": lambda: sinks.write_json_parts(stored().select("district", "snapshot", *FIELDS), f"{out}/districts", ["district"]),
        "index": lambda: sinks.strict_rows(sinks.index_of(stored(), "snapshot", "quadrant", LAYERS)).write.mode("overwrite").option("ignoreNullFields", "false").json(f"{out}/index"),
        "table": table,
    }


def run(spark: SparkSession, out: str, status: Callable[[], DataFrame], names: Callable[[], DataFrame], only: Iterable[str] = (), skip: Iterable[str] = ()) -> tuple[list[dict], bool]:
    """Runs the steps, or only some, or all but some: a step that fails leaves its old output. What happened, and whether what must pass was among them and did."""
    every = steps(spark, out, status, names)
    only, skip = set(only), set(skip)
    if unknown := (only | skip) - every.keys():
        raise ValueError(f"no such steps: {sorted(unknown)}")
    return in_steps({k: f for k, f in every.items() if (not only or k in only) and k not in skip}, MUST_PASS)


def _published(spark, sf_dir) -> str:
    out = own_dir(spark, "published")
    log, ok = run(spark, out, lambda: S.status_full(spark, sf_dir), lambda: load(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("district"), F.col("n_name").alias("name")))
    if not ok:
        raise RuntimeError(f"not published: {log}")
    return out


def published_snapshots(spark, sf_dir):
    """The rows of the snapshots' documents, as they were written, joined to one text; nulls are dashes."""
    rows = spark.read.schema("snapshot string, district long, row array<string>").json(f"{_published(spark, sf_dir)}/snapshots")
    text = F.array_join(F.transform("row", lambda x: F.coalesce(x, F.lit("-"))), "|")
    return rows.select("snapshot", "district", text.alias("row"))


def published_index(spark, sf_dir):
    """The index and the table of a run: how many snapshots and judged rows, where layers begin, how many rows the table has."""
    out = _published(spark, sf_dir)
    first = ", ".join(f"{k}: string" for k in LAYERS)
    i = spark.read.schema(f"snapshots array<string>, classified map<string,long>, layer_from struct<{first}>").json(f"{out}/index")
    n = spark.read.option("header", True).csv(f"{out}/table").agg(F.count("*").alias("listed"), F.max("snapshot").alias("last"))
    total = F.aggregate(F.map_values("classified"), F.lit(0).cast("long"), lambda a, v: a + v)
    return i.select(F.size("snapshots").cast("long").alias("n_snapshots"), total.alias("judged"), *[F.col(f"layer_from.{k}").alias(f"{k}_from") for k in LAYERS]).join(F.broadcast(n))  # one row each


_code = "CASE quadrant WHEN 'fine' THEN 'F' WHEN 'hidden' THEN 'H' WHEN 'buffered' THEN 'B' WHEN 'double' THEN 'D' END"
_number = lambda x: f"CASE WHEN ({x}) = floor({x}) THEN ({x})::BIGINT || '.0' ELSE ({x})::VARCHAR END"
_row = ["round_even(dep * 1000, 0) / 1000", "pct"]
SQL = {
    "published_snapshots": S._FULL + f"SELECT strftime(snapshot, '%Y-%m-%d') AS snapshot, district::BIGINT AS district, concat_ws('|', " + ", ".join(f"coalesce({x}, '-')" for x in (_code, "category", _number(_row[0]), "source", "dry_weeks::VARCHAR", "tier", _number(_row[1]), "stress", S._CLASS)) + ") AS row FROM x8",
    "published_index": S._FULL + ", p AS (SELECT strftime(snapshot, '%Y-%m-%d') AS snapshot, quadrant, category, pct, stress, " + S._CLASS + " AS index_class FROM x8) SELECT count(DISTINCT snapshot) AS n_snapshots, count(quadrant) AS judged, " + ", ".join(f"min(snapshot) FILTER (WHERE {c} IS NOT NULL) AS {k}_from" for k, c in LAYERS.items()) + ", (SELECT count(*) FROM p WHERE snapshot = (SELECT max(snapshot) FROM p WHERE quadrant IS NOT NULL)) AS listed, max(snapshot) FILTER (WHERE quadrant IS NOT NULL) AS last FROM p",
}
QUERIES = {k: globals()[k] for k in SQL}
