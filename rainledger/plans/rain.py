"""Rain queries; orders stand for daily rain (total price / 1000), the customer's nation for the district."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rainledger.functions.columns import category, departure, finite, met_week, month_index, rain_reasons, rounded, season_window
from rainledger.operators import spi as S
from rainledger.operators.series import longest_run, rolling_sum
from rainledger.sources.tables import load

NORMAL_YEARS, LEAPS, AS_OF = (1995, 2000), 2, "2001-07-20"
CATEGORY_SQL = "CASE WHEN {d} IS NULL THEN NULL WHEN round_even({d}, 0) >= 60 THEN 'Large Excess' WHEN round_even({d}, 0) >= 20 THEN 'Excess' WHEN round_even({d}, 0) >= -19 THEN 'Normal' WHEN round_even({d}, 0) >= -59 THEN 'Deficient' WHEN round_even({d}, 0) >= -99 THEN 'Large Deficient' ELSE 'No Rain' END"
WEEK = "least(floor((dayofyear(day) - 1) / 7) + 1, 52)::BIGINT"
DAILY = "daily AS (SELECT c_nationkey AS district, o_orderdate::DATE AS day, sum(o_totalprice) / 1000 AS mm FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)"
r = rounded


def daily(spark, sf_dir) -> DataFrame:
    c = load(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("district"))
    o = load(spark, sf_dir, "orders").select("o_custkey", F.to_date("o_orderdate").alias("day"), "o_totalprice")
    return o.join(c, o.o_custkey == c.c_custkey).groupBy("district", "day").agg((F.sum("o_totalprice") / 1000).alias("mm"))


def monthly(spark, sf_dir) -> DataFrame:
    return daily(spark, sf_dir).groupBy("district", F.year("day").cast("long").alias("year"), F.month("day").cast("long").alias("month")).agg(F.sum("mm").alias("mm"))


def weekly(spark, sf_dir) -> DataFrame:
    return daily(spark, sf_dir).groupBy("district", F.year("day").cast("long").alias("year"), met_week(F.col("day")).alias("week")).agg(F.sum("mm").alias("mm"))


def rain_monthly_sum(spark, sf_dir):
    return monthly(spark, sf_dir).withColumn("mm", r(F.col("mm"), 5))


def rain_weekly_smw(spark, sf_dir):
    return weekly(spark, sf_dir).withColumn("mm", r(F.col("mm"), 5))


def daily_normals(spark, sf_dir) -> DataFrame:
    """Sums over the normal years by calendar day, over the number of years whether the day had rain or not; 29 February over the leap years."""
    years = NORMAL_YEARS[1] - NORMAL_YEARS[0] + 1
    d = daily(spark, sf_dir).where(F.year("day").between(*NORMAL_YEARS))
    leap = (F.month("day") == 2) & (F.dayofmonth("day") == 29)
    return d.groupBy("district", F.month("day").cast("long").alias("month"), F.dayofmonth("day").cast("long").alias("dom")).agg((F.sum("mm") / F.when(F.max(leap), LEAPS).otherwise(years)).alias("normal"))


def rain_daily_normal(spark, sf_dir):
    return daily_normals(spark, sf_dir).withColumn("normal", r(F.col("normal"), 7))


def weekly_normals(spark, sf_dir) -> DataFrame:
    return weekly(spark, sf_dir).where(F.col("year").between(*NORMAL_YEARS)).groupBy("district", "week").agg(F.avg("mm").alias("normal"))


def rain_weekly_normal(spark, sf_dir):
    return weekly_normals(spark, sf_dir).withColumn("normal", r(F.col("normal"), 7))


def season(spark, sf_dir) -> DataFrame:
    """(district, season, season_days, actual, normal, dep, category) of the season on AS_OF."""
    d = daily(spark, sf_dir)
    wins = d.select("district").distinct().withColumn("w", season_window(F.lit(AS_OF).cast("date"), F.col("district") % 5 == 0)).select("district", "w.*")
    days = wins.select("district", F.explode(F.sequence("start", "end")).alias("day"))
    actual = days.join(d, ["district", "day"]).groupBy("district").agg(F.sum("mm").alias("actual"))
    normal = days.select("district", F.month("day").cast("long").alias("month"), F.dayofmonth("day").cast("long").alias("dom")).join(daily_normals(spark, sf_dir), ["district", "month", "dom"]).groupBy("district").agg(F.sum("normal").alias("normal"))
    out = wins.join(actual, "district", "left").join(normal, "district", "left").withColumn("dep", departure(F.col("actual"), F.col("normal")))
    return out.select("district", "season", (F.datediff("end", "start") + 1).cast("long").alias("season_days"), "actual", "normal", "dep", category(F.col("dep")).alias("category"))


def rain_season_departure(spark, sf_dir):
    return season(spark, sf_dir).select("district", "season", "season_days", r(F.col("actual"), 5).alias("actual"), r(F.col("normal"), 7).alias("normal"), r(F.col("dep"), 3).alias("dep"), "category")


def rain_rolling_nmonth(spark, sf_dir):
    m = monthly(spark, sf_dir).withColumn("ym", month_index(F.col("year"), F.col("month")))
    return rolling_sum(m, ["district"], "ym", "mm", 3).select("district", "ym", r(F.col("rolled"), 5).alias("rolled"))


def dry_spells(spark, sf_dir) -> DataFrame:
    """(district, dry_weeks): the longest run of dry weeks among weeks 5 to 29 of 2001. A week counts if its normal is half the mean normal at least, and is dry below half its normal; districts without a positive mean normal are left out."""
    n = weekly_normals(spark, sf_dir).where(F.col("week").between(5, 29)).withColumn("mean_n", F.avg("normal").over(W.partitionBy("district"))).where("mean_n > 0")
    a = weekly(spark, sf_dir).where("year = 2001").select("district", "week", "mm")
    j = n.join(a, ["district", "week"], "left")
    j = j.withColumn("dry", F.coalesce((F.col("normal") >= 0.5 * F.col("mean_n")) & (F.col("mm") < 0.5 * F.col("normal")), F.lit(False)))
    return longest_run(j, ["district"], "week", "dry").withColumnRenamed("longest", "dry_weeks")


def rain_dry_spell(spark, sf_dir):
    return dry_spells(spark, sf_dir)


def _base(spark, sf_dir) -> DataFrame:
    return monthly(spark, sf_dir).where(F.col("year").between(*NORMAL_YEARS))


def rain_spi_base_stats(spark, sf_dir):
    s = S.base_stats(_base(spark, sf_dir), ["district", "month"], "mm")
    return s.select("district", "month", "n", "n_wet", r(F.col("zero_share"), 6).alias("zero_share"), r(F.col("mean"), 7).alias("mean"), r(F.col("mean_log"), 6).alias("mean_log"))


def rain_spi(spark, sf_dir):
    """SPI of the months of 2001; the tables have six base years, so five are asked for here."""
    now = monthly(spark, sf_dir).where("year = 2001").select("district", "month", "mm")
    return S.spi(now, _base(spark, sf_dir), ["district", "month"], "mm", least_years=5, least_wet=5)


def rain_short_rule(spark, sf_dir):
    s = season(spark, sf_dir).join(dry_spells(spark, sf_dir), "district", "left")
    reasons = rain_reasons(F.col("category"), F.lit(None).cast("double"), F.col("dry_weeks"))
    return s.select("district", "category", "dry_weeks", F.array_join(reasons, ",").alias("reasons"), (F.size(reasons) > 0).alias("short"))


def validation_agreement(spark, sf_dir):
    """How far departures of monthly sums and of monthly order counts agree, by month of 2001."""
    o = load(spark, sf_dir, "orders").join(load(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    m = o.groupBy(F.col("c_nationkey").alias("district"), F.year("o_orderdate").alias("year"), F.month("o_orderdate").cast("long").alias("month")).agg((F.sum("o_totalprice") / 1000).alias("mm"), F.count("*").alias("k"))
    base = m.where(F.col("year").between(*NORMAL_YEARS)).groupBy("district", "month").agg(F.avg("mm").alias("nm"), F.avg("k").alias("nk"))
    j = m.where("year = 2001").join(base, ["district", "month"]).select("month", departure(F.col("mm"), F.col("nm")).alias("a"), departure(F.col("k"), F.col("nk")).alias("b"))
    d = F.col("a") - F.col("b")
    share = lambda c: r(F.avg(c.cast("double")), 6)
    return j.groupBy("month").agg(r(F.median(F.abs(d)), 4).alias("median_abs"), r(F.avg(d), 4).alias("mean"), share(F.abs(d) <= 10).alias("within_10"), share(category(F.col("a")) == category(F.col("b"))).alias("same_category"), r(finite(F.corr("a", "b")), 6).alias("r"))


_monthly = DAILY + ", monthly AS (SELECT district, year(day) AS year, month(day) AS month, sum(mm) AS mm FROM daily GROUP BY ALL)"
_weekly = DAILY + f", weekly AS (SELECT district, year(day) AS year, {WEEK} AS week, sum(mm) AS mm FROM daily GROUP BY ALL), wn AS (SELECT district, week, avg(mm) AS normal FROM weekly WHERE year BETWEEN 1995 AND 2000 GROUP BY ALL)"
_normals = ", dn AS (SELECT district, month, dom, mm / CASE WHEN month = 2 AND dom = 29 THEN 2 ELSE 6 END AS normal FROM (SELECT district, month(day) AS month, dayofmonth(day) AS dom, sum(mm) AS mm FROM daily WHERE year(day) BETWEEN 1995 AND 2000 GROUP BY ALL))"
_season = _normals + f""", days AS (SELECT district, d::DATE AS day FROM (SELECT DISTINCT district FROM daily), unnest(range(DATE '2001-06-01', DATE '{AS_OF}' + INTERVAL 1 DAY, INTERVAL 1 DAY)) t(d)),
act AS (SELECT district, sum(mm) AS actual FROM days JOIN daily USING (district, day) GROUP BY ALL), nor AS (SELECT days.district, sum(normal) AS normal FROM days JOIN dn ON dn.district = days.district AND month = month(day) AND dom = dayofmonth(day) GROUP BY ALL),
season AS (SELECT district, actual, normal, CASE WHEN normal > 0 THEN (actual - normal) / normal * 100 END AS dep FROM (SELECT DISTINCT district FROM daily) LEFT JOIN act USING (district) LEFT JOIN nor USING (district))"""
_dry = """, el AS (SELECT *, avg(normal) OVER (PARTITION BY district) AS mean_n FROM wn WHERE week BETWEEN 5 AND 29),
dw AS (SELECT el.district, el.week, el.week - row_number() OVER (PARTITION BY el.district ORDER BY el.week) AS island FROM el JOIN weekly w ON w.district = el.district AND w.week = el.week AND w.year = 2001 WHERE normal >= 0.5 * mean_n AND mm < 0.5 * normal),
dry AS (SELECT d.district, coalesce(max(k), 0) AS dry_weeks FROM (SELECT DISTINCT district FROM el) d LEFT JOIN (SELECT district, island, count(*) AS k FROM dw GROUP BY ALL) x USING (district) GROUP BY ALL)"""
SQL = {
    "rain_monthly_sum": f"WITH {_monthly} SELECT district, year, month, round_even(mm * 1e5, 0) / 1e5 AS mm FROM monthly",
    "rain_weekly_smw": f"WITH {_weekly} SELECT district, year, week, round_even(mm * 1e5, 0) / 1e5 AS mm FROM weekly",
    "rain_daily_normal": f"WITH {DAILY}{_normals} SELECT district, month, dom, round_even(normal * 1e7, 0) / 1e7 AS normal FROM dn",
    "rain_weekly_normal": f"WITH {_weekly} SELECT district, week, round_even(normal * 1e7, 0) / 1e7 AS normal FROM wn",
    "rain_season_departure": f"WITH {DAILY}{_season} SELECT district, 'SW' AS season, date_diff('day', DATE '2001-06-01', DATE '{AS_OF}') + 1 AS season_days, round_even(actual * 1e5, 0) / 1e5 AS actual, round_even(normal * 1e7, 0) / 1e7 AS normal, round_even(dep * 1e3, 0) / 1e3 AS dep, {CATEGORY_SQL.format(d='dep')} AS category FROM season",
    "rain_rolling_nmonth": f"WITH {_monthly}, m AS (SELECT district, year * 12 + month - 1 AS ym, mm FROM monthly) SELECT district, ym, round_even(CASE WHEN count(mm) OVER w = 3 THEN sum(mm) OVER w END * 1e5, 0) / 1e5 AS rolled FROM m WINDOW w AS (PARTITION BY district ORDER BY ym RANGE BETWEEN 2 PRECEDING AND CURRENT ROW)",
    "rain_dry_spell": f"WITH {_weekly}{_dry} SELECT * FROM dry",
    "rain_spi_base_stats": f"WITH {_monthly} SELECT district, month, count(*) AS n, count(*) FILTER (WHERE mm > 0) AS n_wet, round_even(avg((mm <= 0)::INT::DOUBLE) * 1e6, 0) / 1e6 AS zero_share, round_even(avg(mm) FILTER (WHERE mm > 0) * 1e7, 0) / 1e7 AS mean, round_even(avg(ln(mm)) FILTER (WHERE mm > 0) * 1e6, 0) / 1e6 AS mean_log FROM monthly WHERE year BETWEEN 1995 AND 2000 GROUP BY ALL",
    "rain_short_rule": f"WITH {_weekly}{_season}{_dry}, j AS (SELECT s.district, {CATEGORY_SQL.format(d='dep')} AS category, dry_weeks FROM season s LEFT JOIN dry USING (district)), k AS (SELECT *, list_filter([CASE WHEN category IN ('Deficient', 'Large Deficient', 'No Rain') THEN 'deviation' END, CASE WHEN dry_weeks >= 4 THEN 'dry_spell' END], lambda x: x IS NOT NULL) AS found FROM j) SELECT district, category, dry_weeks, CASE WHEN category IS NOT NULL OR dry_weeks IS NOT NULL THEN coalesce(array_to_string(found, ','), '') END AS reasons, CASE WHEN category IS NOT NULL OR dry_weeks IS NOT NULL THEN len(found) > 0 END AS short FROM k",
    "validation_agreement": f"""WITH m AS (SELECT c_nationkey AS district, year(o_orderdate) AS year, month(o_orderdate) AS month, sum(o_totalprice) / 1000 AS mm, count(*) AS k FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL), base AS (SELECT district, month, avg(mm) AS nm, avg(k) AS nk FROM m WHERE year BETWEEN 1995 AND 2000 GROUP BY ALL),
j AS (SELECT m.month, (mm - nm) / nm * 100 AS a, (k - nk) / nk * 100 AS b FROM m JOIN base USING (district, month) WHERE year = 2001) SELECT month, round_even(median(abs(a - b)) * 1e4, 0) / 1e4 AS median_abs, round_even(avg(a - b) * 1e4, 0) / 1e4 AS mean, round_even(avg((abs(a - b) <= 10)::INT::DOUBLE) * 1e6, 0) / 1e6 AS within_10, round_even(avg(({CATEGORY_SQL.format(d='a')} = {CATEGORY_SQL.format(d='b')})::INT::DOUBLE) * 1e6, 0) / 1e6 AS same_category, round_even(CASE WHEN NOT isnan(corr(a, b)) THEN corr(a, b) END * 1e6, 0) / 1e6 AS r FROM j GROUP BY month""",
}
QUERIES = {k: globals()[k] for k in [*SQL, "rain_spi"]}
