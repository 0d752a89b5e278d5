"""Operators on readings, cycles and other series; DataFrame to DataFrame, all names parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rainledger.functions.columns import CYCLE_MONTHS, cycle_of, cycle_year


def cycle_medians(readings: DataFrame, unit: str, when: str, value: str, months: dict = CYCLE_MONTHS) -> DataFrame:
    """(unit, year, cycle, level, n, last_t): exact medians of a unit's readings in a cycle; readings without a key or outside the cycles go."""
    rows = readings.select(F.col(unit).alias("unit"), F.col(when).alias("t"), F.col(value).alias("v")).dropna()
    rows = rows.withColumn("cycle", cycle_of(F.col("t"), months)).where("cycle IS NOT NULL")
    return rows.groupBy("unit", cycle_year(F.col("t")).alias("year"), "cycle").agg(F.median("v").alias("level"), F.count("*").alias("n"), F.max("t").alias("last_t"))


def midrank(cycles: DataFrame, min_years: int = 1) -> DataFrame:
    """Adds hist_years and pct: the mid-rank percentile of the level among the unit's earlier years of the cycle, 100 where all were deeper.

    The earlier levels are the frame of one window over (unit, cycle), so a
    unit's history is never joined with itself.
    """
    before = W.partitionBy("unit", "cycle").orderBy("year").rowsBetween(W.unboundedPreceding, -1)
    hist = F.collect_list("level").over(before)
    above = F.aggregate("hist", F.lit(0.0), lambda a, h: a + F.when(h > F.col("level"), 1.0).when(h == F.col("level"), 0.5).otherwise(0.0))
    out = cycles.withColumn("hist", hist).withColumn("hist_years", F.size("hist").cast("long"))
    return out.withColumn("pct", F.when(F.col("hist_years") >= min_years, 100.0 * above / F.col("hist_years"))).drop("hist")


def trailing_mean(cycles: DataFrame, years: int = 10, least: int = 5) -> DataFrame:
    """Adds decadal: the mean level of the unit's cycle over the years before, if at least so many have one."""
    w = W.partitionBy("unit", "cycle").orderBy("year").rangeBetween(-years, -1)
    return cycles.withColumn("decadal", F.when(F.count("level").over(w) >= least, F.avg("level").over(w)))


def sen_slope(points: DataFrame, keys: list[str], x: str, y: str, least: int = 2) -> DataFrame:
    """Median of the slopes between all pairs of a key's points; a key has one point a year, so a few hundred pairs at most."""
    sides = points.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(F.col(x).alias("x"), F.col(y).alias("y")))).alias("p")).where(F.size("p") >= least)
    pairs = F.flatten(F.transform("p", lambda a: F.transform(F.filter("p", lambda b: b["x"] > a["x"]), lambda b: (b["y"] - a["y"]) / (b["x"] - a["x"]))))
    slopes = sides.select(*keys, F.size("p").cast("long").alias("n_years"), F.array_sort(pairs).alias("s")).where(F.size("s") > 0)
    half = F.floor((F.size("s") - 1) / 2).cast("int")
    other = F.floor(F.size("s") / 2).cast("int")
    return slopes.select(*keys, "n_years", ((F.get("s", half) + F.get("s", other)) / 2).alias("slope"))


def longest_run(flags: DataFrame, keys: list[str], order: str, flag: str) -> DataFrame:
    """(keys, longest): the most consecutive rows whose flag holds; a missing place in the order breaks a run. order: consecutive integers."""
    held = flags.where(F.col(flag)).withColumn("island", F.col(order) - F.row_number().over(W.partitionBy(*keys).orderBy(order)))
    runs = held.groupBy(*keys, "island").count().groupBy(*keys).agg(F.max("count").alias("longest"))
    return flags.select(*keys).distinct().join(runs, keys, "left").select(*keys, F.coalesce("longest", F.lit(0)).cast("long").alias("longest"))


def rolling_sum(series: DataFrame, keys: list[str], order: str, value: str, n: int) -> DataFrame:
    """Adds rolled: the sum of n consecutive places of the order, null unless all n are there."""
    w = W.partitionBy(*keys).orderBy(order).rangeBetween(-(n - 1), 0)
    return series.withColumn("rolled", F.when(F.count(value).over(w) == n, F.sum(value).over(w)))


def keep_first(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in an order that must break all ties."""
    return rows.withColumn("_turn", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("_turn = 1").drop("_turn")


def only_unambiguous(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key no other row has; all of a repeated key go."""
    return rows.withColumn("_n", F.count("*").over(W.partitionBy(*keys))).where("_n = 1").drop("_n")


def weighted_mean(cells: DataFrame, weights: DataFrame, cell: str, keys: list[str], value: str, weight: str) -> DataFrame:
    """(keys, mean, coverage): cells reduced to areas by weight; missing cells count for neither sum, coverage is their share of the weight."""
    seen = F.when(F.col(value).isNotNull(), F.col(weight))
    return cells.join(weights, cell).groupBy(*keys).agg((F.sum(F.col(weight) * F.col(value)) / F.nullif(F.sum(seen), F.lit(0.0))).alias("mean"), (F.coalesce(F.sum(seen), F.lit(0.0)) / F.sum(weight)).alias("coverage"))


def as_of(left: DataFrame, right: DataFrame, left_on: str, right_on: str, by: list[str], columns: list[str]) -> DataFrame:
    """Adds the columns of the last right row of the same key at or before the left one, by one window over the union of both: no range join. Of right rows of one time the one with the greatest columns counts."""
    rows = left.select(*by, F.col(left_on).alias("_t"), F.lit(1).alias("_side"), F.struct(*left.columns).alias("_left"), F.lit(None).cast(right.select(F.struct(right_on, *columns)).schema[0].dataType).alias("_right"))
    facts = right.select(*by, F.col(right_on).alias("_t"), F.lit(0).alias("_side"), F.lit(None).cast(rows.schema["_left"].dataType).alias("_left"), F.struct(right_on, *columns).alias("_right"))
    w = (W.partitionBy(*by) if by else W.partitionBy(F.lit(0))).orderBy("_t", "_side", "_right").rowsBetween(W.unboundedPreceding, 0)
    found = rows.unionByName(facts).withColumn("_right", F.last("_right", ignorenulls=True).over(w)).where("_side = 1")
    return found.select("_left.*", *[F.col(f"_right.{c}").alias(c if c != right_on else f"{c}_found") for c in [right_on, *columns]])
