"""Dimensions, reshaped tables, grids of polygons and stored tables brought up to date, each over the synthetic tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rainledger.functions import names as N
from rainledger.functions.columns import TELEMETRY_MONTHS, cycle_of, current_cycle, month_index, rounded
from rainledger.operators import geometry, incremental, shape
from rainledger.operators.matching import crosswalk
from rainledger.operators.series import keep_first, trailing_mean
from rainledger.operators.stress import missing, publish_gate, stress_status
from rainledger.plans import groundwater as G
from rainledger.plans import rain as R
from rainledger.plans.layers import EDITIONS, _history, history, snapshots, stress_units
from rainledger.sources.sinks import index_of
from rainledger.sources.tables import load

r = rounded
#: Corners of the test polygons, a star, in units that each nation shifts.
STAR = ((0.0, 0.0), (2.0, 0.5), (4.0, 0.0), (3.0, 2.0), (4.0, 4.0), (2.0, 3.0), (0.0, 4.0), (1.0, 2.0))


def gw_wells(spark, sf_dir):
    """A unit's source, last attributes, first year and last day, from its readings; ties of the last time go to the higher line."""
    li = load(spark, sf_dir, "lineitem")
    last = F.max(F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus"))
    w = li.groupBy(F.col("l_suppkey").alias("unit")).agg(last.alias("x"), F.min(F.year("l_shipdate")).cast("long").alias("first_year"), F.count("*").alias("n"))
    return w.select("unit", F.col("x.l_returnflag").alias("mode"), F.col("x.l_linestatus").alias("place"), "first_year", F.date_format("x.l_shipdate", "yyyy-MM-dd").alias("last"), "n")


def gw_cycle_attributes(spark, sf_dir):
    """Cycle medians with what the cycle's last reading says of its station."""
    li = load(spark, sf_dir, "lineitem").select("l_suppkey", "l_shipdate", "l_quantity", "l_returnflag", "l_orderkey", "l_linenumber").withColumn("cycle", cycle_of(F.col("l_shipdate")))
    year = (F.year("l_shipdate") + F.when(F.month("l_shipdate") == 12, 1).otherwise(0)).cast("long")
    last = F.max_by("l_returnflag", F.struct("l_shipdate", "l_orderkey", "l_linenumber"))
    return li.groupBy(F.col("l_suppkey").alias("unit"), year.alias("year"), "cycle").agg(F.median("l_quantity").alias("level"), F.count("*").alias("n"), last.alias("mode"))


def gw_telemetry_campaigns(spark, sf_dir):
    """Readings of campaign months only, by calendar year; a telemetry cycle has no December."""
    li = load(spark, sf_dir, "lineitem").where(F.month("l_shipdate").isin(*TELEMETRY_MONTHS))
    return li.groupBy(F.col("l_suppkey").alias("unit"), F.year("l_shipdate").cast("long").alias("year"), cycle_of(F.col("l_shipdate")).alias("cycle")).agg(F.median("l_quantity").alias("level"), F.count("*").alias("n"))


def gw_district_medians(spark, sf_dir):
    """District medians of the level, its change since the year before, and its difference from the trailing mean; nulls don't count."""
    c = trailing_mean(G.cycles(spark, sf_dir), 10, 3).withColumn("ago", F.lag("level").over(W.partitionBy("unit", "cycle").orderBy("year"))).withColumn("y0", F.lag("year").over(W.partitionBy("unit", "cycle").orderBy("year")))
    c = c.join(G.districts(spark, sf_dir), "unit").withColumn("change", F.when(F.col("y0") == F.col("year") - 1, F.col("ago") - F.col("level"))).withColumn("vs", F.col("level") - F.col("decadal"))
    return c.groupBy("district", "year", "cycle").agg(*[r(F.median(x), 4).alias(f"median_{x}") for x in ("level", "change", "vs")], F.median("n").alias("median_n"))


def gw_nearest(spark, sf_dir):
    """The nearest customer of the same nation within 50 of a supplier's balance, as the nearest manual well of a recorder."""
    return G.best_pairs(spark, sf_dir)


def gw_season_years(spark, sf_dir):
    """Years with a reading in May or November, of each unit."""
    li = load(spark, sf_dir, "lineitem")
    in_ = lambda m: F.countDistinct(F.when(F.month("l_shipdate") == m, F.year("l_shipdate")))
    return li.groupBy(F.col("l_suppkey").alias("unit")).agg(in_(5).alias("may_years"), in_(11).alias("november_years"))


def gw_station_months(spark, sf_dir):
    e = load(spark, sf_dir, "events")
    return e.groupBy(F.col("user_id").alias("station"), F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.median("value").alias("median"), F.min("value").alias("low"), F.max("value").alias("high"), F.count("value").alias("n"), F.max_by("event_type", F.struct("ts", "event_id")).alias("last_type"))


def gw_current_cycle(spark, sf_dir):
    """The cycle that has ended last before each order day."""
    days = load(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    return days.select(F.date_format("day", "yyyy-MM-dd").alias("day"), current_cycle(F.col("day")).alias("c")).select("day", "c.*")


def rain_land_cells(spark, sf_dir):
    """Part sizes as cells: those that have any value over time, sea being null."""
    v = load(spark, sf_dir, "part").select(F.col("p_size").alias("cell"), F.when(F.col("p_size") % 7 != 0, F.col("p_retailprice")).alias("v"))
    return v.groupBy("cell").agg(F.count("v").alias("days")).where("days > 0")


def rain_complete_months(spark, sf_dir):
    """Monthly sums without the month of the last day, and, of years that the history lacks, only those."""
    d = R.daily(spark, sf_dir)
    m = incremental.complete_months(d, "day").groupBy("district", F.year("day").cast("long").alias("year"), F.month("day").cast("long").alias("month")).agg(F.sum("mm").alias("mm"))
    return incremental.other_years(m.where("year < 2000"), m.where("year >= 1999"), "year").withColumn("mm", r(F.col("mm"), 5))


def rain_month_grid(spark, sf_dir):
    """Orders by customer's nation over the full grid of nations, years and months: zero where there are none."""
    o = load(spark, sf_dir, "orders").join(load(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).where("o_orderpriority = '1-URGENT'")
    m = o.groupBy(F.col("c_nationkey").alias("district"), F.year("o_orderdate").cast("long").alias("year"), F.month("o_orderdate").cast("long").alias("month")).agg(F.count("*").alias("n"))
    sides = (load(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("district")), spark.range(1995, 2001).toDF("year"), spark.range(1, 13).toDF("month"))
    return shape.full_grid(m, *sides).withColumn("n", F.coalesce("n", F.lit(0)))


def rain_wide(spark, sf_dir):
    """Months across, a row for each district and year."""
    m = R.monthly(spark, sf_dir).withColumn("name", F.concat(F.lit("m"), F.col("month"))).withColumn("mm", r(F.col("mm"), 5))
    return shape.wide(m, ["district", "year"], "name", "mm", [f"m{k}" for k in range(1, 13)])


def rain_long(spark, sf_dir):
    """The wide table turned back."""
    return shape.long(rain_wide(spark, sf_dir), ["district", "year"], [f"m{k}" for k in range(1, 13)], "name", "mm")


def rain_largest_differences(spark, sf_dir):
    """The fifteen largest absolute differences of a month's rain from the year before's."""
    m = R.monthly(spark, sf_dir).withColumn("ym", month_index(F.col("year"), F.col("month")))
    d = m.join(m.select("district", (F.col("ym") + 12).alias("ym"), F.col("mm").alias("ago")), ["district", "ym"]).select("district", "ym", r(F.col("mm") - F.col("ago"), 5).alias("diff"))
    return d.orderBy(F.abs("diff").desc(), "district", "ym").limit(15)


def stress_crosstab(spark, sf_dir):
    u = stress_units(spark, sf_dir)
    return shape.crosstab(u, "p_brand", "category", ["Safe", "Semi-Critical", "Critical", "Over-Exploited"]).withColumnsRenamed({"Safe": "n_safe", "Semi-Critical": "n_semi", "Critical": "n_critical", "Over-Exploited": "n_over"})


def stress_by_state(spark, sf_dir):
    """Critical units, all units and their share by manufacturer."""
    u = load(spark, sf_dir, "part").join(stress_units(spark, sf_dir).select("p_partkey", "category"), "p_partkey")
    bad = F.col("category").isin("Critical", "Over-Exploited")
    return u.groupBy("p_type").agg(F.count_if(bad).alias("n_critical"), F.count("*").alias("n"), r(F.avg(bad.cast("double")), 6).alias("share"))


def stress_one_row(spark, sf_dir):
    """One row an edition and district: the better method, then the one with a category, then the lower key."""
    rows = load(spark, sf_dir, "supplier").withColumn("edition", F.explode(F.array(*[F.lit(y).cast("long") for y in EDITIONS])))
    k = (F.col("s_suppkey") + F.col("edition")) % 5
    method = F.when(k == 0, "exact").when(k == 1, "alias").when(k == 2, "fuzzy").otherwise("other")
    cat = F.when(F.col("s_acctbal") > 5000, "Critical").when(F.col("s_acctbal") > 0, "Safe")
    rows = rows.select("edition", F.col("s_nationkey").alias("district"), "s_suppkey", method.alias("method"), cat.alias("category"))
    rank = F.when(F.col("method") == "exact", 0).when(F.col("method") == "alias", 1).when(F.col("method") == "fuzzy", 2).otherwise(3)
    return keep_first(rows, ["edition", "district"], [rank, F.col("category").isNull(), F.col("s_suppkey")])


def stress_categories(spark, sf_dir):
    """Units by brand and category, `Not given` where there's none."""
    u = stress_units(spark, sf_dir).withColumn("category", F.when(F.col("stage") > 905, F.col("category")))
    return u.groupBy("p_brand", F.coalesce("category", F.lit("Not given")).alias("category")).agg(F.count("*").alias("n"))


def crosswalk_states(spark, sf_dir):
    """Keys of names that states are spelt with."""
    n = load(spark, sf_dir, "nation").join(load(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    name = F.concat(F.lit("Día & "), "n_name", F.when(F.col("n_nationkey") % 2 == 0, " ISLANDS").otherwise(" Dist."))
    name = F.when(F.col("n_nationkey") == 3, F.lit("Dadra and Nagar Haveli")).otherwise(name)
    return n.select("n_nationkey", N.state_key(name).alias("key"), N.slug(F.concat(F.lit(" "), "r_name", F.lit(" - "), "n_name", F.lit("!"))).alias("slug"), N.title(F.concat("r_name", F.lit(" AND "), "n_name")).alias("title"))


def crosswalk_composed(spark, sf_dir):
    """Misspelt part names against the list of their brand: by relation, alias, whole name, then likeness."""
    p = load(spark, sf_dir, "part").select(F.col("p_brand").alias("state"), F.col("p_name").alias("district"), F.col("p_partkey").cast("long").alias("code"))
    master = p.groupBy("state", "district").agg(F.min("code").alias("code"))
    k = F.col("code") % 4
    names = master.select("state", F.when(k == 0, F.col("district")).when(k == 1, F.upper("district")).when(k == 2, F.concat(F.substring("district", 1, 4), F.expr("substring(district, 6)"))).otherwise(F.concat("district", F.lit("x"))).alias("name"))
    aliases = master.where("code % 4 = 3 AND code % 3 = 0").select("state", F.concat("district", F.lit("x")).alias("name"), F.col("district").alias("target"))
    relations = master.where("code % 40 = 0").select("state", F.col("district").alias("name"), F.lit("part_of").alias("relation"), F.lit(None).cast("string").alias("target"))
    return crosswalk(names.distinct(), master, aliases, relations)


def stress_state(spark, sf_dir):
    """Nations by their suppliers: heads and extras from customers, units from suppliers."""
    n = load(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("district"))
    k = F.col("c_custkey")
    rel = F.when(k % 9 == 0, "one").when(k % 9 == 1, "part_of").when(k % 9 == 2, "child_of").otherwise("none")
    cat = lambda v: F.when(v > 7000, "Over-exploited").when(v > 5000, "Critical").when(v > 2000, "Semi-critical").when(v > 0, "Safe")
    rows = load(spark, sf_dir, "customer").where("c_nationkey % 4 <> 3").where((k % 9 != 0) | (F.col("c_nationkey") % 4 != 2)).select(F.col("c_nationkey").alias("district"), rel.alias("relation"), cat(F.col("c_acctbal")).alias("category"), F.col("c_acctbal").alias("stage_pct"))
    units = load(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("district"), F.col("s_suppkey").alias("name"), cat(F.col("s_acctbal")).alias("category"), F.col("s_acctbal").alias("stage_pct"))
    s = stress_status(n, rows.where("relation <> 'none'"), units)
    text = F.array_join(F.transform(F.array_sort(F.map_entries("by_category")), lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string"))), ",")
    return s.withColumn("by_category", text)


def publish_layers(spark, sf_dir):
    """The gate over the last snapshot's layers: floors by layer, and as of when."""
    h = history(spark, sf_dir).where("snapshot = '1998-05-31'")
    long = h.select("snapshot", F.explode(F.array(*[F.struct(F.lit(k).alias("layer"), F.col(c).cast("string").alias("value")) for k, c in (("rain", "category"), ("level", "pct"), ("quadrant", "quadrant"))])).alias("x")).select("x.*", F.when(F.col("x.value").isNotNull(), F.col("snapshot")).alias("as_of"))
    return publish_gate(long, {"rain": 20, "level": 3, "quadrant": 26, "index": 1})


def rain_missing(spark, sf_dir):
    """Nations without an urgent order in January 1995."""
    o = load(spark, sf_dir, "orders").join(load(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).where("o_orderpriority = '1-URGENT' AND o_orderdate >= DATE '1995-01-01' AND o_orderdate < DATE '1995-01-04'")
    return missing(load(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("district")), o.select(F.col("c_nationkey").alias("district")), "district")


def gw_sign_telemetry(spark, sf_dir):
    """Signs of wells, turned for telemetry ones (odd keys) alone."""
    raw = G.cycles(spark, sf_dir).withColumn("raw", F.col("level") - 30)
    tele = F.first(F.col("unit") % 2 == 1)
    return raw.groupBy("unit").agg(F.when(tele & (F.median("raw") < 0), -1).otherwise(1).alias("sign"))


def snapshot_dates(spark, sf_dir):
    """Cycle ends before the day of the last order."""
    last = load(spark, sf_dir, "orders").agg(F.max(F.to_date("o_orderdate")).alias("today"))
    return snapshots(spark, (1995, 2002)).join(F.broadcast(last), F.to_date("snapshot") < F.col("today")).select("snapshot", "year", "cycle")  # one row


def _areas(spark, sf_dir) -> DataFrame:
    k = F.col("n_nationkey")
    ring = F.array(*[F.struct((F.lit(x) + (k % 5) * 2.5).alias("x"), (F.lit(y) + F.floor(k / 5) * 2.5).alias("y")) for x, y in STAR])
    return load(spark, sf_dir, "nation").select(k.alias("area"), F.array(ring).alias("rings"))


def point_in_polygon(spark, sf_dir):
    """Customers in overlapping star-shaped areas: the smallest area that holds each."""
    c = load(spark, sf_dir, "customer").select("c_custkey", (F.col("c_acctbal") / 700).alias("x"), (F.col("c_custkey") * 37 % 1501 / 100.0).alias("y"))
    return geometry.point_in_polygon(c, _areas(spark, sf_dir), 1.0).select("c_custkey", "area")


def grid_overlay(spark, sf_dir):
    """Square kilometres of each half-degree cell in each area, in an equal-area projection."""
    shifted = F.transform("rings", lambda ring: F.transform(ring, lambda p: F.struct((p["x"] + 70).alias("x"), (p["y"] + 15).alias("y"))))
    return geometry.cell_areas(_areas(spark, sf_dir).withColumn("rings", shifted), 0.5)


def trace_compare(spark, sf_dir):
    """Monthly rain by two ways, compared within a tolerance; one way leaves out single-order months."""
    a = R.monthly(spark, sf_dir).select("district", "year", "month", r(F.col("mm"), 5).alias("mm"))
    o = load(spark, sf_dir, "orders").join(load(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("c_nationkey").alias("district"), F.year("o_orderdate").cast("long").alias("year"), F.month("o_orderdate").cast("long").alias("month"))
    b = o.agg((F.round(F.avg("o_totalprice"), -1) * F.count("*") / 1000).alias("mm"), F.count("*").alias("k")).where("k > 1").select("district", "year", "month", r(F.col("mm"), 5).alias("mm"))
    d = shape.differences(a, b, ["district", "year", "month"], ["mm"], 0.01)
    return d.groupBy("district").agg(F.count_if("same").alias("n_same"), F.count("*").alias("n"))


def history_rows(spark, sf_dir):
    """History rows by position, without names, joined to one text; nulls are dashes."""
    h = history(spark, sf_dir).withColumn("code", N.coded(F.col("quadrant"), N.QUADRANT_CODES))
    fields = F.transform(shape.positional(["code", "category", "tier", "why"]), lambda x: F.coalesce(x, F.lit("-")))
    return h.select("snapshot", "district", F.array_join(fields, "|").alias("row"))


def history_index(spark, sf_dir):
    """All dates, how many districts are judged on each, and where layers begin."""
    i = index_of(history(spark, sf_dir), "snapshot", "quadrant", {"rain": "category", "level": "pct"})
    counts = F.array_join(F.transform("snapshots", lambda s: F.concat(s, F.lit(":"), F.element_at("classified", s).cast("string"))), ",")
    return i.select(F.array_join("snapshots", ",").alias("snapshots"), counts.alias("classified"), "layer_from.rain", "layer_from.level")


def anomaly_by_year(spark, sf_dir):
    """Anomalies of a district's PRE cycles by year, in order."""
    a = G.gw_climatology_anomaly(spark, sf_dir).where("cycle = 'PRE'")
    m = a.groupBy("district").agg(shape.by_year(F.col("year"), r(F.col("anomaly"), 2).cast("decimal(12,2)"), F.col("n").cast("decimal(12,2)")).alias("m"))
    text = F.transform(F.array_sort(F.map_entries("m")), lambda e: F.concat(e["key"], F.lit("="), F.array_join(F.transform(e["value"], lambda v: v.cast("string")), "/")))
    return m.select("district", F.array_join(text, ",").alias("years"))


def _day_sums(e: DataFrame) -> DataFrame:
    return e.groupBy("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(r(F.sum("value"), 4).alias("total"), F.count("*").alias("n"))


def incremental_beyond(spark, sf_dir):
    """Day sums of events later than the last stored day, 20 January."""
    sums = _day_sums(load(spark, sf_dir, "events"))
    return incremental.beyond(sums, sums.where("day <= '2024-01-20'"), "day")


def incremental_since(spark, sf_dir):
    """From what day to fetch each user again: ten days before the last purchase, else the first of the year."""
    e = load(spark, sf_dir, "events")
    since = incremental.fetch_from(e, e.where("event_type = 'purchase'"), "user_id", "ts", 10, "2024-01-01")
    return since.select("user_id", F.date_format("since", "yyyy-MM-dd").alias("since"))


def incremental_whole_periods(spark, sf_dir):
    """Stored day sums to 20 January, and a pull from noon of the 18th: its first day is cut, so the stored sum stays."""
    e = load(spark, sf_dir, "events")
    return incremental.whole_periods_win(_day_sums(e.where("ts < TIMESTAMP '2024-01-21'")), _day_sums(e.where("ts >= TIMESTAMP '2024-01-18 12:00:00'")), ["user_id", "day"], "day")


def incremental_rebuilt(spark, sf_dir):
    """Stored rows before 15 January with values halved, as they were, and rebuilt ones from then on."""
    e = load(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("day"), "value")
    return incremental.rebuilt_from(e.withColumn("value", F.col("value") / 2), e, "day", "2024-01-15").select("event_id", "value")


def incremental_sticky(spark, sf_dir):
    """Users' first event type stays once it's known; users without an event before 10 January get the newest."""
    e = load(spark, sf_dir, "events")
    of = lambda d, f: d.groupBy("user_id").agg(f("event_type", F.struct("ts", "event_id")).alias("kind"), F.count("*").alias("n"))
    return incremental.sticky(of(e, F.max_by), of(e.where("ts < TIMESTAMP '2024-01-10'"), F.min_by), "user_id", ["kind"])


def incremental_newest(spark, sf_dir):
    """Latest rows of two sources by user: the later one, the first source's if they're equal."""
    e = load(spark, sf_dir, "events")
    of = lambda t: e.where(F.col("event_type") == t).groupBy("user_id").agg(F.to_date(F.max("ts")).alias("last"), F.lit(t).alias("source"))
    return incremental.newest(of("view"), of("click"), "user_id", "last").select("user_id", F.date_format("last", "yyyy-MM-dd").alias("last"), "source")


def incremental_years(spark, sf_dir):
    """Weekly rain to 1998 as stored (rounded), and what is fresh of the years beyond."""
    w = R.weekly(spark, sf_dir)
    old = w.where("year <= 1998").withColumn("mm", r(F.col("mm")))
    return incremental.later_years(old, w.where("year >= 1997").withColumn("mm", r(F.col("mm"), 5)), "year")


_ev = "e AS (SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, round_even(sum(value) * 1e4, 0) / 1e4 AS total, count(*) AS n FROM {src} GROUP BY ALL)"
_units = "u AS (SELECT p_partkey, p_type, p_brand, p_retailprice AS stage, CASE WHEN p_size > 45 THEN 'Over-Exploited' WHEN p_size > 40 THEN 'Critical' WHEN p_size > 25 THEN 'Semi-Critical' ELSE 'Safe' END AS category FROM part)"
_ends = ", ".join(f"({m}, {d}, '{c}')" for c, (m, d) in (("JAN", (1, 31)), ("PRE", (5, 31)), ("AUG", (8, 31)), ("NOV", (11, 30))))
_star = ", ".join(f"({i}, {x}, {y})" for i, (x, y) in enumerate(STAR))
_wide = f"WITH {R._monthly} SELECT district, year, " + ", ".join(f"max(round_even(mm * 1e5, 0) / 1e5) FILTER (WHERE month = {k}) AS m{k}" for k in range(1, 13)) + " FROM monthly GROUP BY ALL"
SQL = {
    "gw_wells": "SELECT l_suppkey AS unit, arg_max(l_returnflag, (l_shipdate, l_orderkey, l_linenumber)) AS mode, arg_max(l_linestatus, (l_shipdate, l_orderkey, l_linenumber)) AS place, min(year(l_shipdate)) AS first_year, strftime(max(l_shipdate), '%Y-%m-%d') AS last, count(*) AS n FROM lineitem GROUP BY ALL",
    "gw_cycle_attributes": f"WITH x AS (SELECT l_suppkey AS unit, year(l_shipdate) + CASE WHEN month(l_shipdate) = 12 THEN 1 ELSE 0 END AS year, CASE {G._case.replace('(t)', '(l_shipdate)')} END AS cycle, * FROM lineitem) SELECT unit, year, cycle, median(l_quantity) AS level, count(*) AS n, arg_max(l_returnflag, (l_shipdate, l_orderkey, l_linenumber)) AS mode FROM x GROUP BY ALL",
    "gw_telemetry_campaigns": "SELECT l_suppkey AS unit, year(l_shipdate) AS year, CASE month(l_shipdate) WHEN 1 THEN 'JAN' WHEN 8 THEN 'AUG' WHEN 11 THEN 'NOV' ELSE 'PRE' END AS cycle, median(l_quantity) AS level, count(*) AS n FROM lineitem WHERE month(l_shipdate) IN (1, 4, 5, 8, 11) GROUP BY ALL",
    "gw_district_medians": f"WITH {G.CYCLES_SQL}, d AS (SELECT c.*, s_nationkey AS district, count(level) OVER w AS k, avg(level) OVER w AS m FROM cycles c JOIN supplier ON s_suppkey = unit WINDOW w AS (PARTITION BY unit, cycle ORDER BY year RANGE BETWEEN 10 PRECEDING AND 1 PRECEDING)) SELECT d.district, d.year, d.cycle, round_even(median(d.level) * 1e4, 0) / 1e4 AS median_level, round_even(median(p.level - d.level) * 1e4, 0) / 1e4 AS median_change, round_even(median(d.level - CASE WHEN d.k >= 3 THEN d.m END) * 1e4, 0) / 1e4 AS median_vs, median(d.n)::DOUBLE AS median_n FROM d LEFT JOIN cycles p ON p.unit = d.unit AND p.cycle = d.cycle AND p.year = d.year - 1 GROUP BY ALL",
    "gw_nearest": "WITH p AS (SELECT s_suppkey AS tele, c_custkey AS manual, round_even(abs(s_acctbal - c_acctbal) * 100, 0) / 100 AS gap FROM supplier JOIN customer ON s_nationkey = c_nationkey) SELECT * FROM p WHERE gap <= 50 QUALIFY row_number() OVER (PARTITION BY tele ORDER BY gap, manual) = 1",
    "gw_season_years": "SELECT l_suppkey AS unit, count(DISTINCT year(l_shipdate)) FILTER (WHERE month(l_shipdate) = 5) AS may_years, count(DISTINCT year(l_shipdate)) FILTER (WHERE month(l_shipdate) = 11) AS november_years FROM lineitem GROUP BY ALL",
    "gw_station_months": "SELECT user_id AS station, strftime(ts, '%Y-%m-%d') AS day, median(value) AS median, min(value) AS low, max(value) AS high, count(value) AS n, arg_max(event_type, (ts, event_id)) AS last_type FROM events GROUP BY ALL",
    "gw_current_cycle": f"WITH d AS (SELECT DISTINCT o_orderdate::DATE AS day FROM orders), e AS (SELECT day, make_date(year(day) - k, m::INT, dd::INT) AS ended, year(day) - k AS year, c AS cycle FROM d, (VALUES (0), (1)) y(k), (VALUES {_ends}) t(m, dd, c)) SELECT strftime(day, '%Y-%m-%d') AS day, max_by(year, ended) AS year, max_by(cycle, ended) AS cycle FROM e WHERE ended < day GROUP BY ALL",
    "rain_land_cells": "SELECT p_size AS cell, count(*) AS days FROM part WHERE p_size % 7 <> 0 GROUP BY ALL",
    "rain_complete_months": f"WITH {R.DAILY}, m AS (SELECT district, year(day) AS year, month(day) AS month, sum(mm) AS mm FROM daily WHERE day < (SELECT date_trunc('month', max(day)) FROM daily) GROUP BY ALL) SELECT district, year, month, round_even(mm * 1e5, 0) / 1e5 AS mm FROM m",
    "rain_month_grid": "WITH m AS (SELECT c_nationkey AS district, year(o_orderdate) AS year, month(o_orderdate) AS month, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderpriority = '1-URGENT' GROUP BY ALL) SELECT n_nationkey AS district, y AS year, k AS month, coalesce(n, 0) AS n FROM nation, range(1995, 2001) a(y), range(1, 13) b(k) LEFT JOIN m ON m.district = n_nationkey AND m.year = y AND m.month = k",
    "rain_wide": _wide,
    "rain_long": f"WITH w AS ({_wide}) UNPIVOT w ON {', '.join(f'm{k}' for k in range(1, 13))} INTO NAME name VALUE mm",
    "rain_largest_differences": f"WITH {R._monthly}, m AS (SELECT district, year * 12 + month - 1 AS ym, mm FROM monthly) SELECT a.district, a.ym, round_even((a.mm - b.mm) * 1e5, 0) / 1e5 AS diff FROM m a JOIN m b ON b.district = a.district AND b.ym = a.ym - 12 ORDER BY abs(diff) DESC, a.district, a.ym LIMIT 15",
    "stress_crosstab": f"WITH {_units} SELECT p_brand, count(*) FILTER (WHERE category = 'Safe') AS n_safe, count(*) FILTER (WHERE category = 'Semi-Critical') AS n_semi, count(*) FILTER (WHERE category = 'Critical') AS n_critical, count(*) FILTER (WHERE category = 'Over-Exploited') AS n_over FROM u GROUP BY ALL",
    "stress_by_state": f"WITH {_units} SELECT p_type, count(*) FILTER (WHERE category IN ('Critical', 'Over-Exploited')) AS n_critical, count(*) AS n, round_even(avg((category IN ('Critical', 'Over-Exploited'))::INT::DOUBLE) * 1e6, 0) / 1e6 AS share FROM u GROUP BY ALL",
    "stress_one_row": f"WITH x AS (SELECT e AS edition, s_nationkey AS district, s_suppkey, CASE (s_suppkey + e) % 5 WHEN 0 THEN 'exact' WHEN 1 THEN 'alias' WHEN 2 THEN 'fuzzy' ELSE 'other' END AS method, CASE WHEN s_acctbal > 5000 THEN 'Critical' WHEN s_acctbal > 0 THEN 'Safe' END AS category FROM supplier, unnest([{', '.join(map(str, EDITIONS))}]) t(e)) SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY edition, district ORDER BY CASE method WHEN 'exact' THEN 0 WHEN 'alias' THEN 1 WHEN 'fuzzy' THEN 2 ELSE 3 END, category IS NULL, s_suppkey) = 1",
    "stress_categories": f"WITH {_units} SELECT p_brand, CASE WHEN stage > 905 THEN category ELSE 'Not given' END AS category, count(*) AS n FROM u GROUP BY ALL",
    "stress_state": """WITH c AS (SELECT c_nationkey AS district, c_acctbal AS v, c_custkey % 9 AS k FROM customer WHERE c_nationkey % 4 <> 3 AND (c_custkey % 9 <> 0 OR c_nationkey % 4 <> 2)),
cat AS (SELECT *, CASE WHEN v > 7000 THEN 'Over-exploited' WHEN v > 5000 THEN 'Critical' WHEN v > 2000 THEN 'Semi-critical' WHEN v > 0 THEN 'Safe' END AS category FROM c),
h AS (SELECT district, category, v FROM cat WHERE k = 0 QUALIFY row_number() OVER (PARTITION BY district ORDER BY category NULLS FIRST, v) = 1), x AS (SELECT district, count(*) AS n_extra FROM c WHERE k IN (1, 2) GROUP BY ALL),
u AS (SELECT s_nationkey AS district, s_suppkey AS name, s_acctbal AS v, CASE WHEN s_acctbal > 7000 THEN 'Over-exploited' WHEN s_acctbal > 5000 THEN 'Critical' WHEN s_acctbal > 2000 THEN 'Semi-critical' WHEN s_acctbal > 0 THEN 'Safe' END AS category FROM supplier),
b AS (SELECT district, string_agg(kind || ':' || n, ',' ORDER BY kind) AS by_category FROM (SELECT district, coalesce(category, 'Not given') AS kind, count(*) AS n FROM u GROUP BY ALL) GROUP BY ALL),
m AS (SELECT district, count(*) AS n_units, arg_max(name, (list_position(['Safe', 'Semi-critical', 'Critical', 'Over-exploited'], category), v, name)) FILTER (WHERE category IS NOT NULL) AS worst, bool_or(coalesce(category IN ('Critical', 'Over-exploited'), false)) AS critical FROM u GROUP BY ALL),
j AS (SELECT n_nationkey AS district, CASE WHEN h.district IS NOT NULL THEN 'assessed' WHEN n_extra IS NOT NULL THEN 'only_sub_units' ELSE 'not_in_source' END AS status, h.category, h.v, n_units, by_category, worst, critical, coalesce(n_extra, 0) AS n_extra FROM nation LEFT JOIN h ON h.district = n_nationkey LEFT JOIN x ON x.district = n_nationkey LEFT JOIN m ON m.district = n_nationkey LEFT JOIN b ON b.district = n_nationkey)
SELECT district, status, category, v AS stage_pct, CASE WHEN status <> 'not_in_source' THEN n_units END AS n_units, CASE WHEN status <> 'not_in_source' THEN by_category END AS by_category, CASE WHEN status <> 'not_in_source' THEN worst END AS worst, CASE WHEN status <> 'not_in_source' THEN critical END AS critical, CASE WHEN status <> 'not_in_source' THEN critical AND NOT coalesce(category IN ('Critical', 'Over-exploited'), false) END AS hidden, n_extra FROM j""",
    "publish_layers": _history + ", s AS (SELECT * FROM h WHERE snapshot = '1998-05-31'), f(layer, floor) AS (VALUES ('rain', 20), ('level', 3), ('quadrant', 26), ('index', 1)), v AS (SELECT 'rain' AS layer, count(category) AS n FROM s UNION ALL SELECT 'level', count(pct) FROM s UNION ALL SELECT 'quadrant', count(quadrant) FROM s) SELECT f.layer, floor::BIGINT AS floor, coalesce(n, 0) AS n, CASE WHEN n > 0 THEN '1998-05-31' END AS as_of, coalesce(n, 0) >= floor AND coalesce(n, 0) > 0 AS ok FROM f LEFT JOIN v USING (layer)",
    "rain_missing": "SELECT n_nationkey AS district FROM nation WHERE n_nationkey NOT IN (SELECT c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderpriority = '1-URGENT' AND o_orderdate >= DATE '1995-01-01' AND o_orderdate < DATE '1995-01-04')",
    "gw_sign_telemetry": f"WITH {G.CYCLES_SQL} SELECT unit, CASE WHEN unit % 2 = 1 AND median(level - 30) < 0 THEN -1 ELSE 1 END AS sign FROM cycles GROUP BY unit",
    "snapshot_dates": "WITH e(y, m, d, cycle) AS (SELECT y, m, d, c FROM range(1995, 2003) t(y), (VALUES " + _ends + ") v(m, d, c)) SELECT strftime(make_date(y, m::INT, d::INT), '%Y-%m-%d') AS snapshot, y AS year, cycle FROM e WHERE make_date(y, m::INT, d::INT) < (SELECT max(o_orderdate)::DATE FROM orders)",
    "crosswalk_states": "WITH n AS (SELECT n_nationkey, n_name, r_name, CASE WHEN n_nationkey = 3 THEN 'Dadra and Nagar Haveli' ELSE 'Día & ' || n_name || CASE WHEN n_nationkey % 2 = 0 THEN ' ISLANDS' ELSE ' Dist.' END END AS s FROM nation JOIN region ON n_regionkey = r_regionkey), k AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(strip_accents(s)), '&', ' and ', 'g'), '\\b(district|dist)\\b', ' ', 'g'), '[^a-z0-9]', '', 'g'), 'islands$', '') AS key FROM n) SELECT n_nationkey, CASE WHEN key LIKE 'dadra%' OR key LIKE 'daman%' THEN 'dnhdd' ELSE key END AS key, trim(regexp_replace(r_name || ' - ' || n_name || '!', '[^A-Za-z0-9]+', '_', 'g'), '_') AS slug, array_to_string(list_transform(regexp_extract_all(lower(r_name || ' AND ' || n_name), '\\p{L}+|[^\\p{L}]+'), lambda p: upper(p[1]) || p[2:]), '').replace(' And ', ' and ') AS title FROM k",
    "point_in_polygon": f"WITH c AS (SELECT c_custkey, c_acctbal / 700 AS x, c_custkey * 37 % 1501 / 100.0::DOUBLE AS y FROM customer), s(i, a, b) AS (VALUES {_star}), p AS (SELECT n_nationkey AS area, i, a + (n_nationkey % 5) * 2.5 AS x, b + floor(n_nationkey / 5) * 2.5 AS y FROM nation, s), e AS (SELECT p.area, p.x::DOUBLE AS x1, p.y::DOUBLE AS y1, q.x::DOUBLE AS x2, q.y::DOUBLE AS y2 FROM p JOIN p q ON q.area = p.area AND q.i = (p.i + 1) % {len(STAR)}), h AS (SELECT c_custkey, area FROM c JOIN e ON (y1 > c.y) <> (y2 > c.y) AND c.x < (x2 - x1) * (c.y - y1) / (y2 - y1) + x1 GROUP BY ALL HAVING count(*) % 2 = 1) SELECT c_custkey, min(area) AS area FROM customer LEFT JOIN h USING (c_custkey) GROUP BY ALL",
    "trace_compare": f"WITH {R._monthly}, a AS (SELECT district, year, month, round_even(mm * 1e5, 0) / 1e5 AS mm FROM monthly), b AS (SELECT c_nationkey AS district, year(o_orderdate) AS year, month(o_orderdate) AS month, round_even(round(avg(o_totalprice), -1) * count(*) / 1000 * 1e5, 0) / 1e5 AS mm FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL HAVING count(*) > 1) SELECT a.district, count(*) FILTER (WHERE abs(a.mm - b.mm) <= 0.01) AS n_same, count(*) AS n FROM a LEFT JOIN b USING (district, year, month) GROUP BY ALL",
    "history_rows": _history + "SELECT snapshot, district, concat_ws('|', CASE quadrant WHEN 'fine' THEN 'F' WHEN 'hidden' THEN 'H' WHEN 'buffered' THEN 'B' WHEN 'double' THEN 'D' ELSE '-' END, coalesce(category, '-'), tier, coalesce(why, '-')) AS row FROM h",
    "history_index": _history + ", p AS (SELECT snapshot, count(quadrant) AS n, count(category) AS rain, count(pct) AS level FROM h GROUP BY ALL) SELECT string_agg(snapshot, ',' ORDER BY snapshot) AS snapshots, string_agg(snapshot || ':' || n, ',' ORDER BY snapshot) AS classified, min(snapshot) FILTER (WHERE rain > 0) AS rain, min(snapshot) FILTER (WHERE level > 0) AS level FROM p",
    "anomaly_by_year": f"WITH {G.CYCLES_SQL}, clim AS (SELECT unit, cycle, avg(level) AS m FROM cycles GROUP BY unit, cycle HAVING count(level) >= 4), a AS (SELECT s_nationkey AS district, year, round_even(round_even(median(level - m) * 1e6, 0) / 1e6 * 100, 0) / 100 AS v, count(*) AS n FROM cycles JOIN clim USING (unit, cycle) JOIN supplier ON s_suppkey = unit WHERE cycle = 'PRE' GROUP BY ALL) SELECT district, string_agg(year || '=' || v::DECIMAL(12,2) || '/' || n::DECIMAL(12,2), ',' ORDER BY year) AS years FROM a GROUP BY ALL",
    "incremental_beyond": "WITH " + _ev.format(src="events") + " SELECT * FROM e WHERE day > '2024-01-20'",
    "incremental_since": "SELECT user_id, strftime(coalesce(max(ts) FILTER (WHERE event_type = 'purchase')::DATE - 10, DATE '2024-01-01'), '%Y-%m-%d') AS since FROM events GROUP BY ALL",
    "incremental_whole_periods": "WITH " + _ev.format(src="events") + " SELECT * FROM e",
    "incremental_rebuilt": "SELECT event_id, CASE WHEN ts < TIMESTAMP '2024-01-15' THEN value / 2 ELSE value END AS value FROM events",
    "incremental_sticky": "SELECT user_id, coalesce(arg_min(event_type, (ts, event_id)) FILTER (WHERE ts < TIMESTAMP '2024-01-10'), arg_max(event_type, (ts, event_id))) AS kind, count(*) AS n FROM events GROUP BY ALL",
    "incremental_newest": "WITH x AS (SELECT user_id, max(ts)::DATE AS last, event_type AS source FROM events WHERE event_type IN ('view', 'click') GROUP BY ALL) SELECT user_id, strftime(last, '%Y-%m-%d') AS last, source FROM x QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY last DESC, source = 'click') = 1",
    "incremental_years": f"WITH {R._weekly} SELECT district, year, week, CASE WHEN year <= 1998 THEN round_even(mm, 0) ELSE round_even(mm * 1e5, 0) / 1e5 END AS mm FROM weekly",
}
QUERIES = {k: globals()[k] for k in [*SQL, "crosswalk_composed", "grid_overlay"]}
