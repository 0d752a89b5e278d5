"""The status of each district on each snapshot, from five layers: official and gridded rain, dry spells and SPI, water levels, stress editions and the drought index.

All snapshots are one plan. Windows, weeks and editions are small dimensions; the
facts meet them by equality, and no snapshot is looped over.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rainledger.functions.columns import category, headline, index_class, level_verdict, month_index, quadrant, rain_reasons, rain_verdict, rounded, season_window, whole_months, window_weeks
from rainledger.operators.series import longest_run, midrank
from rainledger.operators.spi import spi
from rainledger.plans import groundwater as G
from rainledger.plans import rain as R
from rainledger.plans.layers import EDITIONS, _snaps, snapshots
from rainledger.sources.tables import load

BASE_YEARS, LEAST_BASE = (1971, 2020), 30


def windows_of(dates: DataFrame) -> DataFrame:
    """(snapshot, north_east, season, start, end) of both groups of districts on each snapshot."""
    both = dates.select("snapshot", F.explode(F.array(F.lit(False), F.lit(True))).alias("north_east"))
    return both.withColumn("w", season_window(F.col("snapshot"), F.col("north_east"))).select("snapshot", "north_east", "w.*")


def _ym(day: Column) -> Column:
    return month_index(F.year(day), F.month(day))


def gridded_actual(monthly: DataFrame, spans: DataFrame) -> DataFrame:
    """(district, start, end, actual): sums of whole windows' months; null unless all months are there."""
    months = spans.select("start", "end", (_ym(F.col("end")) - _ym(F.col("start")) + 1).alias("k"), F.explode(F.sequence(_ym(F.col("start")), _ym(F.col("end")))).alias("ym"))
    m = monthly.where("mm IS NOT NULL").select("district", month_index(F.col("year"), F.col("month")).alias("ym"), "mm")
    return m.join(F.broadcast(months), "ym").groupBy("district", "start", "end", "k").agg(F.sum("mm").alias("actual"), F.countDistinct("ym").alias("n")).where("n = k").select("district", "start", "end", "actual")


def normal_sums(normals: DataFrame, spans: DataFrame) -> DataFrame:
    """(district, from, to, normal): sums of daily normals, once for each pair of first and last calendar day."""
    md = lambda c: F.date_format(c, "MM-dd")
    days = spans.groupBy(md("start").alias("from"), md("end").alias("to")).agg(F.min("start").alias("start"), F.min_by("end", "start").alias("end"))
    days = days.select("from", "to", F.explode(F.sequence("start", "end")).alias("day")).select("from", "to", F.month("day").cast("long").alias("month"), F.dayofmonth("day").cast("long").alias("dom"))
    return normals.join(F.broadcast(days), ["month", "dom"]).groupBy("district", "from", "to").agg(F.sum("normal").alias("normal"))


def dry_spells(weekly: DataFrame, normals: DataFrame, spans: DataFrame) -> DataFrame:
    """(district, start, end, dry_weeks): the longest run of dry weeks among a window's whole weeks; districts without a positive mean normal are left out."""
    weeks = spans.select("start", "end", F.posexplode(window_weeks(F.col("start"), F.col("end"))).alias("place", "w")).select("start", "end", "place", "w.*")
    n = normals.join(F.broadcast(weeks), "week").withColumn("mean", F.avg("normal").over(W.partitionBy("district", "start", "end"))).where("mean > 0")
    j = n.join(weekly, ["district", "year", "week"], "left")
    j = j.withColumn("dry", F.coalesce((F.col("normal") >= 0.5 * F.col("mean")) & (F.col("mm") < 0.5 * F.col("normal")), F.lit(False)))
    return longest_run(j, ["district", "start", "end"], "place", "dry").withColumnRenamed("longest", "dry_weeks")


def season_spi(monthly: DataFrame, spans: DataFrame, base_years: tuple[int, int] = BASE_YEARS, least_years: int = LEAST_BASE, least_wet: int = 15) -> DataFrame:
    """(district, start, end, spi) of windows of whole months, against the same months of the base years."""
    whole = spans.where(whole_months(F.col("start"), F.col("end"))).select("start", "end", (_ym(F.col("end")) - _ym(F.col("start")) + 1).alias("k"), F.month("end").cast("long").alias("last"), _ym(F.col("end")).alias("end_ym"))
    kinds = whole.select("k", "last").distinct()
    m = monthly.where("mm IS NOT NULL").select("district", month_index(F.col("year"), F.col("month")).alias("ym"), "mm")
    to = m.join(F.broadcast(kinds)).select("district", "k", "last", "mm", F.explode(F.sequence(F.col("ym"), F.col("ym") + F.col("k") - 1)).alias("end_ym")).where("end_ym % 12 = last - 1")  # a few kinds of window
    sums = to.groupBy("district", "k", "last", "end_ym").agg(F.sum("mm").alias("rolled"), F.count("*").alias("n")).where("n = k").drop("n")
    base = sums.where(F.floor(F.col("end_ym") / 12).between(*base_years))
    asked = sums.join(F.broadcast(whole.select("k", "last", "end_ym").distinct()), ["k", "last", "end_ym"])
    scored = spi(asked, base, ["district", "k", "last"], "rolled", least_years, least_wet)
    return scored.join(F.broadcast(whole), ["k", "last", "end_ym"]).select("district", "start", "end", "spi")


def district_status(districts: DataFrame, dates: DataFrame, monthly: DataFrame, daily_normals: DataFrame, weekly: DataFrame, weekly_normals: DataFrame, official: DataFrame, levels: DataFrame, editions: DataFrame, index: DataFrame, base_years: tuple[int, int] = BASE_YEARS, least_years: int = LEAST_BASE, least_wet: int = 15) -> DataFrame:
    """One row a district and snapshot, with what each layer says and the quadrant.

    districts (district, north_east), dates (snapshot date, year, cycle), monthly
    (district, year, month, mm), daily_normals (district, month, dom, normal),
    weekly (district, year, week, mm), weekly_normals (district, week, normal),
    official (start, end, district, dep, category), levels (district, year, cycle,
    tier, pct, low), editions (edition, end_year, district, category, stage_pct),
    index (week, district, mean, d0plus). Districts and dates are dimensions and
    are broadcast; so are windows, editions' years and weeks.
    """
    windows = windows_of(dates)
    spans = windows.select("start", "end").distinct()
    out = districts.join(F.broadcast(dates)).join(F.broadcast(windows), ["snapshot", "north_east"])  # dimensions
    by = ["district", "start", "end"]
    out = out.join(gridded_actual(monthly, spans), by, "left")
    out = out.withColumn("from", F.date_format("start", "MM-dd")).withColumn("to", F.date_format("end", "MM-dd")).join(normal_sums(daily_normals, spans), ["district", "from", "to"], "left")
    out = out.join(official.select(*by, F.col("dep").alias("o_dep"), F.col("category").alias("o_cat")), by, "left")
    out = out.join(dry_spells(weekly, weekly_normals, spans), by, "left").join(season_spi(monthly, spans, base_years, least_years, least_wet), by, "left")
    gridded = F.try_divide(F.col("actual") - F.col("normal"), F.col("normal")) * 100
    out = out.withColumn("rain", headline(F.col("o_dep"), F.col("o_cat"), gridded)).withColumn("spi", rounded(F.col("spi"), 2))
    out = out.withColumn("reasons", rain_reasons(F.col("rain.category"), F.col("spi"), F.col("dry_weeks")))
    days = F.datediff("end", "start") + 1
    out = out.withColumn("r", rain_verdict(F.col("rain.category"), days, F.size("reasons") > 0))
    out = out.join(levels, ["district", "year", "cycle"], "left").withColumn("tier", F.coalesce("tier", F.lit("insufficient")))
    out = out.withColumn("g", level_verdict(F.col("tier"), F.col("low"))).withColumn("quadrant", quadrant(F.col("r.short"), F.col("g.low")))
    last = dates.select("snapshot").join(F.broadcast(editions.select("edition", "end_year").distinct()), F.col("end_year") <= F.year("snapshot")).groupBy("snapshot").agg(F.max_by("edition", "end_year").alias("edition"))
    out = out.join(F.broadcast(last), "snapshot", "left").join(editions.select("edition", "district", F.col("category").alias("stress"), "stage_pct"), ["edition", "district"], "left")
    near = dates.select("snapshot").join(F.broadcast(index.select("week").distinct()), F.col("week").between(F.date_sub("snapshot", 7), F.col("snapshot"))).groupBy("snapshot").agg(F.max("week").alias("week"))
    out = out.join(F.broadcast(near), "snapshot", "left").join(index, ["week", "district"], "left")
    mean = rounded(F.col("mean"), 2)
    return out.select(
        "district", F.date_format("snapshot", "yyyy-MM-dd").alias("snapshot"), "quadrant", (F.col("quadrant").isNotNull() & (F.col("tier") == "provisional")).alias("provisional"),
        F.when(F.col("quadrant").isNull(), F.coalesce("r.why", "g.why")).alias("why"), "season", days.cast("long").alias("season_days"),
        F.col("rain.category").alias("category"), rounded(F.col("rain.dep"), 3).alias("dep"), F.col("rain.source").alias("source"), "spi", "dry_weeks",
        F.array_join("reasons", ",").alias("reasons"), F.col("r.short").alias("short"), "tier", "pct", "edition", "stress", "stage_pct",
        index_class(mean).alias("index_class"), mean.alias("index_mean"), rounded(F.col("d0plus"), 1).alias("d0plus"),
    )


def layers_of(spark, sf_dir) -> dict[str, DataFrame]:
    """The layers on the synthetic tables: official rows for every third district in even years, editions by supplier balances, index weeks from every third week of lines."""
    n = load(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("district"))
    c = load(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("district")).agg(F.avg("c_acctbal").alias("bal"))
    dates = snapshots(spark).select(F.to_date("snapshot").alias("snapshot"), "year", "cycle")
    o = c.where("district % 3 = 0").join(F.broadcast(windows_of(dates).select("start", "end").distinct().where("year(start) % 2 = 0")))  # a few windows
    dep = rounded(F.col("bal") / 100 - 60 + F.month("end"), 1)
    official = o.select("start", "end", "district", dep.alias("dep"), category(dep).alias("category"))
    s = load(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("district")).agg(F.max("s_acctbal").alias("most"), F.avg("s_acctbal").alias("mean"))
    e = spark.createDataFrame([(f"{y - 1}-{y}", y) for y in EDITIONS], "edition string, end_year int")
    editions = s.join(F.broadcast(e)).select("edition", "end_year", "district", F.when(F.col("most") + F.col("end_year") > 11500, "Critical").when(F.col("most") > 7000, "Safe").alias("category"), rounded(F.col("mean") / 100 + F.col("end_year") % 7, 2).alias("stage_pct"))
    week = F.date_trunc("week", "l_shipdate").cast("date")
    li = load(spark, sf_dir, "lineitem").select("l_suppkey", week.alias("week"), "l_discount", "l_tax").where("datediff(week, date'1990-01-01') % 21 = 0")
    index = li.join(G.districts(spark, sf_dir), F.col("l_suppkey") == F.col("unit")).groupBy("week", "district").agg((F.avg("l_discount") * -25).alias("mean"), (F.avg("l_tax") * 1000).alias("d0plus"))
    levels = G.tiers(midrank(G.cycles(spark, sf_dir)).join(G.districts(spark, sf_dir), "unit"), ["district", "year", "cycle"]).drop("n_units")
    return {"districts": n.withColumn("north_east", F.col("district") % 5 == 0), "dates": dates, "monthly": R.monthly(spark, sf_dir), "daily_normals": R.daily_normals(spark, sf_dir), "weekly": R.weekly(spark, sf_dir), "weekly_normals": R.weekly_normals(spark, sf_dir), "official": official, "levels": levels, "editions": editions, "index": index}


def status_full(spark, sf_dir):
    """All five layers; the tables have fewer base years than SPI asks for, so it's null here."""
    return district_status(**layers_of(spark, sf_dir))


def status_why(spark, sf_dir):
    """How many districts have each quadrant, or reason for none, by snapshot and source of rain."""
    s = status_full(spark, sf_dir)
    return s.groupBy("snapshot", F.coalesce("quadrant", "why").alias("verdict"), F.coalesce("source", F.lit("none")).alias("source")).agg(F.count("*").alias("n"))


_FULL = f"""WITH {G.MIDRANK_SQL}, {R._weekly}{R._normals}, monthly AS (SELECT district, year(day) AS year, month(day) AS month, sum(mm) AS mm FROM daily GROUP BY ALL),
placed AS (SELECT r.*, s_nationkey AS district FROM ranked r JOIN supplier ON s_suppkey = unit), tiers AS ({G._tier_sql("district, year, cycle", "placed")}),
snaps(year, cycle, ym, s) AS (VALUES {_snaps}), snap AS (SELECT year, cycle, s::DATE AS snapshot FROM snaps),
win0 AS (SELECT snapshot, ne, year(snapshot) AS y, month(snapshot) AS m FROM snap, (VALUES (false), (true)) b(ne)),
win AS (SELECT snapshot, ne, CASE WHEN ne AND (m >= 10 OR m <= 5) THEN 'NE' ELSE 'SW' END AS season,
  CASE WHEN ne AND m >= 10 THEN make_date(y, 10, 1) WHEN ne AND m <= 5 THEN make_date(y - 1, 10, 1) WHEN m >= 6 THEN make_date(y, 6, 1) ELSE make_date(y - 1, 6, 1) END AS a,
  CASE WHEN ne AND m >= 10 THEN snapshot WHEN ne AND m <= 5 THEN make_date(y - 1, 12, 31) WHEN m BETWEEN 6 AND 9 THEN snapshot WHEN m >= 10 THEN make_date(y, 9, 30) ELSE make_date(y - 1, 9, 30) END AS b FROM win0),
spans AS (SELECT DISTINCT a, b FROM win),
act AS (SELECT district, a, b, sum(mm) AS actual FROM spans JOIN monthly ON year * 12 + month BETWEEN year(a) * 12 + month(a) AND year(b) * 12 + month(b) GROUP BY ALL HAVING count(*) = max(month(b) - month(a)) + 1),
nrm AS (SELECT district, a, b, sum(normal) AS normal FROM spans JOIN dn ON make_date(year(a), month, dom) BETWEEN a AND b AND NOT (month = 2 AND dom = 29) GROUP BY ALL),
wks AS (SELECT a, b, year(a) AS year, k AS week, row_number() OVER (PARTITION BY a, b ORDER BY k) AS place FROM spans, range(1, 53) t(k) WHERE make_date(year(a), 1, 1) + (7 * (k - 1))::INT >= a AND CASE WHEN k = 52 THEN make_date(year(a), 12, 31) ELSE make_date(year(a), 1, 1) + (7 * k - 1)::INT END <= b),
wn2 AS (SELECT wks.*, wn.district, normal, avg(normal) OVER (PARTITION BY wn.district, a, b) AS mean FROM wks JOIN wn USING (week)),
wj AS (SELECT wn2.*, coalesce(normal >= 0.5 * mean AND mm < 0.5 * normal, false) AS dry FROM wn2 LEFT JOIN weekly USING (district, year, week) WHERE mean > 0),
isl AS (SELECT district, a, b, place - row_number() OVER (PARTITION BY district, a, b ORDER BY place) AS i FROM wj WHERE dry),
dry AS (SELECT w.district, w.a, w.b, coalesce(max(k), 0) AS dry_weeks FROM (SELECT DISTINCT district, a, b FROM wj) w LEFT JOIN (SELECT district, a, b, i, count(*) AS k FROM isl GROUP BY ALL) x USING (district, a, b) GROUP BY ALL),
bal AS (SELECT c_nationkey AS district, avg(c_acctbal) AS bal FROM customer GROUP BY ALL), off AS (SELECT district, a, b, round_even((bal / 100 - 60 + month(b)) * 10, 0) / 10 AS o FROM bal, spans WHERE district % 3 = 0 AND year(a) % 2 = 0),
sup AS (SELECT s_nationkey AS district, max(s_acctbal) AS most, avg(s_acctbal) AS mean FROM supplier GROUP BY ALL),
ed AS (SELECT (y - 1) || '-' || y AS edition, y, district, CASE WHEN most + y > 11500 THEN 'Critical' WHEN most > 7000 THEN 'Safe' END AS stress, round_even((mean / 100 + y % 7) * 100, 0) / 100 AS stage_pct FROM sup, unnest([{', '.join(map(str, EDITIONS))}]) t(y)),
idx AS (SELECT date_trunc('week', l_shipdate)::DATE AS week, s_nationkey AS district, avg(l_discount) * -25 AS mean, avg(l_tax) * 1000 AS d0 FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE date_diff('day', DATE '1990-01-01', date_trunc('week', l_shipdate)::DATE) % 21 = 0 GROUP BY ALL),
near AS (SELECT snapshot, max(week) AS week FROM snap JOIN (SELECT DISTINCT week FROM idx) ON week BETWEEN snapshot - 7 AND snapshot GROUP BY ALL),
x0 AS (SELECT n_nationkey AS district, snap.*, season, a, b FROM nation, snap JOIN win USING (snapshot) WHERE ne = (n_nationkey % 5 = 0)),
x1 AS (SELECT x0.*, o, CASE WHEN normal <> 0 THEN round_even((actual - normal) / normal * 100, 0) END AS g, dry_weeks, coalesce(tier, 'insufficient') AS tier, pct, low FROM x0 LEFT JOIN act USING (district, a, b) LEFT JOIN nrm USING (district, a, b) LEFT JOIN off USING (district, a, b) LEFT JOIN dry USING (district, a, b) LEFT JOIN tiers USING (district, year, cycle)),
x2 AS (SELECT *, coalesce(o, g) AS dep, CASE WHEN o IS NOT NULL THEN 'official' WHEN g IS NOT NULL THEN 'gridded' END AS source FROM x1),
x3 AS (SELECT *, {R.CATEGORY_SQL.format(d="dep")} AS category FROM x2),
x4 AS (SELECT *, CASE WHEN category IS NOT NULL OR dry_weeks IS NOT NULL THEN list_filter([CASE WHEN category IN ('Deficient', 'Large Deficient', 'No Rain') THEN 'deviation' END, CASE WHEN dry_weeks >= 4 THEN 'dry_spell' END], lambda x: x IS NOT NULL) END AS found, date_diff('day', a, b) + 1 AS season_days FROM x3),
x5 AS (SELECT *, CASE WHEN season_days >= 15 THEN len(found) > 0 END AS short, CASE WHEN found IS NULL THEN 'no_rain_data' WHEN season_days < 15 THEN 'season_just_started' WHEN tier NOT IN ('full', 'short', 'provisional') THEN 'gw_' || tier END AS why, CASE WHEN tier IN ('full', 'short', 'provisional') THEN low END AS gl FROM x4),
x6 AS (SELECT *, CASE WHEN short IS NULL OR gl IS NULL THEN NULL WHEN short AND gl THEN 'double' WHEN short THEN 'buffered' WHEN gl THEN 'hidden' ELSE 'fine' END AS quadrant FROM x5),
x7 AS (SELECT x6.*, (SELECT max(y) FROM ed WHERE y <= year(snapshot)) AS ey FROM x6),
x8 AS (SELECT x7.*, edition0.edition, ed.stress, ed.stage_pct, near.week, round_even(i.mean * 100, 0) / 100 AS x, round_even(i.d0 * 10, 0) / 10 AS d0plus FROM x7 LEFT JOIN (SELECT DISTINCT edition, y FROM ed) edition0 ON edition0.y = ey LEFT JOIN ed ON ed.y = ey AND ed.district = x7.district LEFT JOIN near ON near.snapshot = x7.snapshot LEFT JOIN idx i ON i.week = near.week AND i.district = x7.district)
"""
_CLASS = "CASE WHEN x IS NULL THEN NULL WHEN x <= -2.0 THEN 'd4' WHEN x <= -1.6 THEN 'd3' WHEN x <= -1.3 THEN 'd2' WHEN x <= -0.8 THEN 'd1' WHEN x <= -0.5 THEN 'd0' ELSE 'none' END"
SQL = {
    "status_full": _FULL + f"SELECT district, strftime(snapshot, '%Y-%m-%d') AS snapshot, quadrant, quadrant IS NOT NULL AND tier = 'provisional' AS provisional, CASE WHEN quadrant IS NULL THEN why END AS why, season, season_days, category, round_even(dep * 1000, 0) / 1000 AS dep, source, NULL::DOUBLE AS spi, dry_weeks, array_to_string(found, ',') AS reasons, short, tier, pct, edition, stress, stage_pct, {_CLASS} AS index_class, x AS index_mean, d0plus FROM x8",
    "status_why": _FULL + "SELECT strftime(snapshot, '%Y-%m-%d') AS snapshot, coalesce(quadrant, why) AS verdict, coalesce(source, 'none') AS source, count(*) AS n FROM x6 GROUP BY ALL",
}
QUERIES = {k: globals()[k] for k in SQL}
