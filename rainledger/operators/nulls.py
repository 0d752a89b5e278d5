"""Random-year null distributions: how often a rate of some marked years comes about with as many years taken at random."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def random_years(years: DataFrame, year: str, k: int, draws: int, seed: int = 0) -> DataFrame:
    """(draws): one row, an array of draws, each of k different years of the table: those whose hashes with the seed and the draw's number come first. The same in each run, and in SQL that has md5."""
    each = years.select(F.col(year).alias("y")).where("y IS NOT NULL").distinct().select("y", F.explode(F.sequence(F.lit(0), F.lit(draws - 1))).alias("d"))
    code = F.md5(F.concat_ws("-", F.lit(str(seed)), F.col("d").cast("string"), F.col("y").cast("string")))
    first = each.withColumn("k", F.row_number().over(W.partitionBy("d").orderBy(code, "y"))).where(F.col("k") <= k)
    per = first.groupBy("d").agg(F.array_sort(F.collect_list("y")).alias("ys"))
    return per.agg(F.transform(F.array_sort(F.collect_list(F.struct("d", "ys"))), lambda x: x["ys"]).alias("draws"))  # draws x k numbers


def _rate(known: Column, years: Column) -> Column:
    """The share of flagged years among these that the map knows; null if it knows none."""
    own = F.filter(F.transform(years, lambda y: F.try_element_at(known, y)), lambda v: v.isNotNull())
    return F.try_divide(F.aggregate(own, F.lit(0), lambda s, v: s + v.cast("int")).cast("double"), F.size(own))


def null_rates(flags: DataFrame, by: str, year: str, flag: str, marked: list[int], draws: int = 2000, seed: int = 0, at: tuple[float, ...] = (0.05, 0.5, 0.95)) -> DataFrame:
    """(by, n_years, rate, other_rate, p_value, q05, ...): the rate of flagged years among the marked ones and the others, and where it lies among draws of as many random years.

    flags has a row for each value of by and year; null flags are unknown years.
    A draw takes years from all of the table, and its rate is of those that are
    known. Quantiles are the draws' own values, the lower of two. Each value's
    years are one row, so draws are an array beside it and no row is multiplied.
    """
    all_years = flags.select(year).distinct()
    known = flags.where(F.col(year).isNotNull() & F.col(flag).isNotNull()).groupBy(by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(year).alias("k"), F.col(flag).alias("v"))))).alias("m"))
    k = all_years.where(F.col(year).isin(marked)).count()
    own = known.join(F.broadcast(random_years(flags, year, k, draws, seed)))  # one row
    is_marked = lambda y: y.isin(marked)
    own = own.withColumn("rates", F.array_sort(F.filter(F.transform("draws", lambda d: _rate(F.col("m"), d)), lambda v: v.isNotNull())))
    own = own.withColumn("rate", _rate(F.col("m"), F.filter(F.map_keys("m"), is_marked))).withColumn("other_rate", _rate(F.col("m"), F.filter(F.map_keys("m"), lambda y: ~is_marked(y))))
    p = F.try_divide(F.size(F.filter("rates", lambda v: v >= F.col("rate"))).cast("double"), F.size("rates"))
    quantile = lambda q: F.get("rates", F.floor(F.lit(q) * (F.size("rates") - 1)).cast("int")).alias(f"q{round(q * 100):02d}")
    return own.select(by, F.size("m").cast("long").alias("n_years"), "rate", "other_rate", F.when(F.col("rate").isNotNull(), p).alias("p_value"), *[quantile(q) for q in at])
