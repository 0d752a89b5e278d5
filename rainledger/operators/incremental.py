"""Stored tables brought up to date: what to fetch, what stays, what fresh rows replace."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rainledger.sources.tables import replace_by_key


def beyond(fresh: DataFrame, stored: DataFrame, when: str) -> DataFrame:
    """Fresh rows later than the last stored one; all, if nothing is stored."""
    last = stored.agg(F.max(when).alias("_last"))
    return fresh.join(F.broadcast(last)).where(F.col("_last").isNull() | (F.col(when) > F.col("_last"))).drop("_last")  # one row


def fetch_from(keys: DataFrame, stored: DataFrame, key: str, when: str, overlap_days: int, first: str) -> DataFrame:
    """(key, since): from what day to fetch each key: some days before its last stored row, else the first day."""
    last = stored.groupBy(key).agg(F.max(when).cast("date").alias("last"))
    return keys.select(key).distinct().join(last, key, "left").select(key, F.coalesce(F.date_sub("last", overlap_days), F.lit(first).cast("date")).alias("since"))


def whole_periods_win(stored: DataFrame, fresh: DataFrame, keys: list[str], period: str) -> DataFrame:
    """Stored sums with fresh ones in their place, but for the first fresh period, which the pull may have cut."""
    first = fresh.agg(F.min(period).alias("_first"))
    later = fresh.join(F.broadcast(first)).where(F.col(period) > F.col("_first")).drop("_first")  # one row
    return replace_by_key(stored, later, keys)


def rebuilt_from(stored: DataFrame, fresh: DataFrame, when: str, day: str) -> DataFrame:
    """Stored rows before a day and fresh ones from it on."""
    start = F.lit(day).cast("date")
    return stored.where(F.col(when) < start).unionByName(fresh.where(F.col(when) >= start))


def sticky(fresh: DataFrame, stored: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Fresh rows that keep what is already stored in these columns."""
    old = stored.select(key, *[F.col(c).alias(f"_{c}") for c in columns])
    joined = fresh.join(old, key, "left")
    return joined.select(*[F.coalesce(f"_{c}", c).alias(c) if c in columns else F.col(c) for c in fresh.columns])


def newest(stored: DataFrame, fresh: DataFrame, key: str, when: str) -> DataFrame:
    """One row a key: the fresh one if it's later than the stored one, else that."""
    both = stored.withColumn("_turn", F.lit(0)).unionByName(fresh.withColumn("_turn", F.lit(1)))
    kept = F.max_by(F.struct(*stored.columns), F.struct(F.col(when), -F.col("_turn")))  # equal times: stored
    return both.groupBy(key).agg(kept.alias("_row")).select("_row.*")


def later_years(stored: DataFrame, fresh: DataFrame, year: str) -> DataFrame:
    """Stored years as they are, and the fresh rows of years beyond them."""
    last = stored.agg(F.max(year).alias("_last"))
    return stored.unionByName(fresh.join(F.broadcast(last)).where(F.col("_last").isNull() | (F.col(year) > F.col("_last"))).drop("_last"))  # one row


def other_years(history: DataFrame, current: DataFrame, year: str) -> DataFrame:
    """History, and current rows of the years that it lacks."""
    return history.unionByName(current.join(history.select(year).distinct(), year, "left_anti").select(*history.columns))


def complete_months(daily: DataFrame, when: str) -> DataFrame:
    """Rows before the month of the last day, which may go on."""
    last = daily.agg(F.trunc(F.max(when), "MM").alias("_month"))
    return daily.join(F.broadcast(last)).where(F.col(when) < F.col("_month")).drop("_month")  # one row


def yearly(rows: Callable[[int], DataFrame], years: list[int], path: str) -> DataFrame:
    """The rows of each year, written once under path/year=...; years that are there already aren't made again.

    A year that a lost job left half written has no _SUCCESS mark and is made anew.
    """
    spark, made = None, []
    for y in years:
        at = f"{path}/year={y}"
        df = rows(y)
        spark = df.sparkSession
        jvm = spark.sparkContext._jvm
        mark = jvm.org.apache.hadoop.fs.Path(f"{at}/_SUCCESS")
        if not mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark):
            df.drop("year").write.mode("overwrite").parquet(at)
        made.append(at)
    return spark.read.option("basePath", path).parquet(*made)


def in_steps(steps: dict[str, Callable[[], None]], must: set[str]) -> tuple[list[dict], bool]:
    """Runs each step by itself: one that fails leaves its old output and the others go on. What happened, and whether all steps that must pass are there and did."""
    log = []
    for name, step in steps.items():
        try:
            step()
            log.append({"step": name, "ok": True, "error": None})
        except Exception as e:  # noqa: BLE001  any failure of a source is that step's alone
            log.append({"step": name, "ok": False, "error": f"{type(e).__name__}: {e}"[:300]})
    passed = {x["step"] for x in log if x["ok"]}
    return log, must <= passed
