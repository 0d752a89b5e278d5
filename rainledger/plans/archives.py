"""Files of each landed format, written from the given tables and read back by their source; the SQL is over the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rainledger.functions import names as N
from rainledger.functions.columns import rounded
from rainledger.operators import incremental, matching
from rainledger.operators.spi import spi
from rainledger.plans import rain as R
from rainledger.sources import feeds, landed, sinks, tables
from rainledger.sources.shared import own_dir
from rainledger.sources.tables import load

STAGES = ("safe", "semi_critical", "critical", "over_exploited", "new word")


def _json(*columns: Column) -> Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def _suppliers(spark, sf_dir) -> DataFrame:
    s = load(spark, sf_dir, "supplier").join(load(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return s.select("s_suppkey", "n_nationkey", "n_name", "n_regionkey", F.round(F.col("s_acctbal") * 100).cast("long").alias("cents"))


def landed_answers(spark, sf_dir):
    """Suppliers as assessed units, an answer for each nation: nested and plain categories, totals and units without a key between them."""
    s = _suppliers(spark, sf_dir)
    label = F.element_at(F.array(*[F.lit(x) for x in STAGES]), (F.col("s_suppkey") % 5 + 1).cast("int"))
    stage = (F.col("cents") / 1000.0).alias("total")
    nested = _json(F.concat(F.lit("unit "), F.col("s_suppkey")).alias("locationName"), F.col("s_suppkey").cast("string").alias("locationUUID"), F.struct(label.alias("total"), F.lit("salinity").alias("poor_quality")).alias("category"), F.struct(stage).alias("stageOfExtraction"), F.lit(None).cast("double").alias("draftData"))
    plain = _json(F.concat(F.lit("unit "), F.col("s_suppkey")).alias("locationName"), F.col("s_suppkey").cast("string").alias("locationUUID"), label.alias("category"), stage.alias("stageOfExtraction"))
    sums = s.groupBy("n_nationkey").agg(F.sum("cents").alias("c")).select("n_nationkey", F.lit(-1).cast("long").alias("s_suppkey"), _json(F.lit(" Total").alias("locationName"), F.lit("x").alias("locationUUID"), (F.col("c") / 100.0).alias("stageOfExtraction")).alias("row"))
    keyless = s.where("s_suppkey % 7 = 0").select("n_nationkey", F.lit(-2).cast("long").alias("s_suppkey"), _json(F.lit("no key").alias("locationName"), F.lit("").alias("locationUUID")).alias("row"))
    rows = s.select("n_nationkey", "s_suppkey", F.when(F.col("s_suppkey") % 2 == 0, nested).otherwise(plain).alias("row")).unionByName(sums).unionByName(keyless)
    path = own_dir(spark, "answers")
    feeds.write_pages(rows, path, "n_nationkey", "row", "s_suppkey")
    got = landed.real_rows(landed.answers(spark, path).select(*landed.assessment(F.col("row"))), "name", "key")
    return got.select("name", "key", "category", "poor_quality", "stage_pct", "extraction")


def landed_places(spark, sf_dir):
    """Suppliers nested as districts in the answers of nations, under several names of fields."""
    s = _suppliers(spark, sf_dir)
    district = F.struct(F.concat(F.lit("d "), F.col("s_suppkey")).alias("districtname"), F.col("s_suppkey").alias("districtcode"))
    states = s.groupBy("n_regionkey", "n_nationkey", "n_name").agg(F.sort_array(F.collect_list(district)).alias("districts"))
    one = _json(F.col("n_name").alias("statename"), F.lit("").alias("statecode"), F.col("n_nationkey").cast("string").alias("stateCode"), "districts")
    two = _json(F.lit(None).cast("string").alias("statename"), F.col("n_name").alias("name"), F.col("n_nationkey").cast("string").alias("statecode"), F.col("districts").alias("data"))
    path = own_dir(spark, "places")
    feeds.write_pages(states.select("n_regionkey", "n_nationkey", F.when(F.col("n_nationkey") % 2 == 0, one).otherwise(two).alias("row")), path, "n_regionkey", "row", "n_nationkey")
    return landed.nested_places(spark, path)


def landed_readings(spark, sf_dir):
    """Lines as readings of two kinds of CSV, whose value columns are named differently; those whose time or place doesn't parse go."""
    li = load(spark, sf_dir, "lineitem").select("l_suppkey", "l_linenumber", F.to_timestamp("l_shipdate").alias("t"), F.col("l_quantity").cast("long").alias("q"), "l_orderkey")
    time = F.when(F.col("l_orderkey") % 50 == 0, "never").otherwise(F.date_format("t", "dd-MM-yyyy HH:mm"))
    lat = F.when(F.col("l_orderkey") % 70 == 0, "n/a").otherwise((F.col("l_suppkey") / 8.0).cast("string"))
    rows = li.select(F.concat(F.lit("well "), F.col("l_suppkey")).alias("Station"), lat.alias("Latitude"), (F.col("l_suppkey") / 4.0).cast("string").alias("Longitude"), time.alias("Data Acquisition Time"), "q", "l_linenumber")
    paths = [own_dir(spark, "manual"), own_dir(spark, "telemetry")]
    for k, (path, name) in enumerate(zip(paths, ("Groundwater Level (m)", "Groundwater Level Telemetry"), strict=True)):
        rows.where(F.col("l_linenumber") % 2 == k).drop("l_linenumber").withColumnRenamed("q", name).write.option("header", True).csv(path)
    got = tables.readings(spark, *paths)
    return got.groupBy("station", F.year("t").cast("long").alias("year")).agg(F.count("*").alias("n"), F.sum("value").cast("long").alias("total"), F.min("lat").alias("lat"), F.max("lon").alias("lon"))


def landed_boundaries(spark, sf_dir):
    """Customers as features, one JSON object a line: polygons with a hole and pairs of polygons; some are skipped, and their plane areas."""
    k = F.col("c_custkey")
    at = lambda x, y, s: F.array(*[F.array((k % 100 + x + a * s).cast("double"), (k % 90 + y + b * s).cast("double")) for a, b in ((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))])
    one = _json(F.struct(k.alias("code"), F.col("c_mktsegment").alias("skip")).alias("properties"), F.struct(F.lit("Polygon").alias("type"), F.array(at(0, 0, 4), F.reverse(at(1, 1, 2))).alias("coordinates")).alias("geometry"))
    two = _json(F.struct(k.cast("string").alias("code"), F.col("c_mktsegment").alias("skip")).alias("properties"), F.struct(F.lit("MultiPolygon").alias("type"), F.array(F.array(at(0, 0, 2)), F.array(at(5, 5, 3))).alias("coordinates")).alias("geometry"))
    path = own_dir(spark, "boundaries")
    load(spark, sf_dir, "customer").select(F.when(k % 2 == 0, one).otherwise(two).alias("value")).write.text(path)
    from rainledger.operators.coverage import signed_area

    got = landed.boundaries(spark, path, "code", F.col("properties")["skip"] == "BUILDING")
    total = F.aggregate(F.transform("rings", lambda r: signed_area(F.slice(r, F.lit(1), F.size(r) - 1))), F.lit(0.0), lambda a, v: a + v)
    return got.select(F.col("area").alias("c_custkey"), F.size("rings").cast("long").alias("n_rings"), total.cast("long").alias("size"), F.col("properties")["skip"].alias("segment"))


def landed_lines(spark, sf_dir):
    """Suppliers as lines of an official report a region: headings of groups and places, rows of names, numbers and codes, and noise."""
    s = _suppliers(spark, sf_dir)
    code = F.element_at(F.array(*[F.lit(c) for c in landed.HALF_CODES]), (F.col("s_suppkey") % 7 + 1).cast("int"))
    n = (F.col("cents") / 10).cast("long") / 10.0
    whole = F.concat_ws(" ", n.cast("string"), (F.col("s_suppkey") % 90 + 1).cast("string"), F.concat((F.col("s_suppkey") % 40 - 20).cast("string"), F.lit("%")), code)
    day = F.when(F.col("s_suppkey") % 3 == 0, F.concat_ws(" ", (F.col("s_suppkey") % 90 + 1).cast("string"), F.lit("ND"))).otherwise(whole)
    row = F.concat_ws(" ", F.col("s_suppkey").cast("string"), F.concat(F.lit("NORTH 24 UNIT"), F.translate(F.col("s_suppkey").cast("string"), "0123456789", "ABCFGHIJKM")), day, whole)
    order = F.col("n_nationkey") * 1_000_000 + F.col("s_suppkey")
    heads = s.select("n_regionkey", "n_nationkey", "n_name").distinct()
    name = F.when(F.col("n_nationkey") % 2 == 0, F.concat("n_name", F.lit(" (UT) 12 3"))).otherwise(F.concat(F.lit("GROUP OF "), F.translate(F.col("n_nationkey").cast("string"), "0123456789", "ABCFGHIJKM")))
    noise = heads.select(F.concat(F.lit("region_"), F.col("n_regionkey"), F.lit(".txt")).alias("file"), (F.col("n_nationkey") * 1_000_000 - 1).alias("at"), F.lit("PERIOD: 01-06-2024 to 07-09-2024").alias("line"))
    text = s.select(F.concat(F.lit("region_"), F.col("n_regionkey"), F.lit(".txt")).alias("file"), (order + 1).alias("at"), row.alias("line")).unionByName(heads.select(F.concat(F.lit("region_"), F.col("n_regionkey"), F.lit(".txt")).alias("file"), (F.col("n_nationkey") * 1_000_000).alias("at"), name.alias("line"))).unionByName(noise)
    path = own_dir(spark, "reports")
    feeds.write_files(text, path, "file", "line", "at")
    groups = [("GROUP OF " + str(k).translate(str.maketrans("0123456789", "ABCFGHIJKM")), f"STATE {k}") for k in range(1, 25, 2)]
    rows = landed.under_headings(landed.numbered_lines(spark, path), "file", "line_no", "line", groups, "^PERIOD")
    got = landed.official_rows(rows, "row")
    return got.select("file", "name", "group", "place", F.col("day.actual").alias("day_actual"), F.col("day.normal").alias("day_normal"), F.col("day.dep").alias("day_dep"), F.col("day.code").alias("day_code"), F.col("period.actual").alias("actual"), F.col("period.dep").alias("dep"), F.col("period.code").alias("code"))


def landed_weekly_table(spark, sf_dir):
    """Suppliers as rows of a week-by-week table, a text for each nation: names over two lines, ND, and feet between rows; the last week counts."""
    s = _suppliers(spark, sf_dir)
    unit = F.translate(F.col("s_suppkey").cast("string"), "0123456789", "ABCFGHIJKM")
    last = F.when(F.col("s_suppkey") % 4 == 0, "ND").otherwise((F.col("s_suppkey") % 200 - 100).cast("string"))
    values = F.concat_ws(" ", F.array_repeat(F.lit("-5"), (F.col("s_suppkey") % 6 + 1).cast("int")), last)
    line = F.concat(F.col("s_suppkey").cast("string"), F.lit(" UNIT"), F.when(F.col("s_suppkey") % 3 == 0, F.lit("\n")).otherwise(F.lit(" ")), unit, F.lit(" (X) "), values, F.when(F.col("s_suppkey") % 5 == 0, F.lit("\nfoot of the page 7 8")).otherwise(F.lit("")))
    texts = s.groupBy("n_nationkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("s_suppkey", line.alias("line")))), lambda x: x["line"]), "\n").alias("text"))
    rows = texts.select(F.col("n_nationkey").cast("long").alias("nation"), F.explode(landed.cumulative_last(F.concat(F.lit("WEEK BY WEEK\n"), F.col("text")))).alias("r"))
    return rows.select("nation", F.col("r.number").cast("long").alias("unit"), F.col("r.name").alias("name"), F.col("r.dep").cast("long").alias("dep"), F.col("r.n_weeks").alias("n_weeks"))


def landed_html_tables(spark, sf_dir):
    """Conversations as tables in pages, beside other tables, with hints that are no text and minus signs of print."""
    c = load(spark, sf_dir, "conversations").where("conv_id IS NOT NULL AND turn IS NOT NULL")
    safe = lambda x: F.replace(F.replace(x, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    row = F.concat(F.lit("<tr><td>"), F.col("turn").cast("string"), F.lit('<span class="x tooltip">not <b>this</b></span></td><td>'), safe(F.coalesce("role", F.lit(""))), F.lit("</td><td>−"), F.length(F.coalesce("text", F.lit(""))).cast("string"), F.lit("<!-- nor this --></td></tr>"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", row.alias("row")))), lambda x: x["row"]), "\n")
    pages = c.groupBy("conv_id").agg(F.concat(F.lit('<table id="menu"><tr><td>no</td></tr></table><p><TABLE class=big id="probs">'), body, F.lit("</TABLE>")).alias("html"))
    got = landed.html_tables(pages, "conv_id", "html", "probs")
    cell = lambda i: F.get("cells", F.lit(i))
    return got.groupBy("conv_id").agg(F.count("*").alias("n"), F.sum(cell(0).cast("long")).alias("turns"), F.sum(cell(2).cast("long")).alias("length"), F.max(cell(1)).alias("role"))


def landed_windows(spark, sf_dir):
    """Customers' balances as official departures in archived files of two years; where a snapshot of a window is there too, it counts."""
    c = load(spark, sf_dir, "customer").select("c_custkey", rounded(F.col("c_acctbal") / 100, 1).alias("dep"))
    rows = []
    for name, start, end, add in (("season_1997_SW.csv", "1997-06-01", "1997-09-30", 0.0), ("season_1998_SW.csv", "1998-06-01", "1998-09-30", 1.0), ("snapshot_1998-09-30.csv", "1998-06-01", "1998-09-30", 5.0)):
        dep = F.when(F.col("c_custkey") % 9 == 0, "").otherwise((F.col("dep") + add).cast("string"))
        rows.append(c.select(F.lit(name).alias("file"), "c_custkey", F.concat_ws(",", F.lit(start), F.lit(end), F.col("c_custkey").cast("string"), dep, F.lit("Normal")).alias("line")))
        rows.append(spark.range(1).select(F.lit(name).alias("file"), F.lit(-1).cast("long").alias("c_custkey"), F.lit("period_start,period_end,dist_lgd,period_dep_pct,category").alias("line")))
    path, whole = own_dir(spark, "windows"), rows[0]
    for x in rows[1:]:
        whole = whole.unionByName(x)
    feeds.write_files(whole, path, "file", "line", "c_custkey")
    got = landed.official_windows(spark, path)
    return got.select(F.date_format("start", "yyyy-MM-dd").alias("start"), F.date_format("end", "yyyy-MM-dd").alias("end"), F.col("district").alias("c_custkey"), rounded(F.col("dep"), 1).alias("dep"), "category")


def strict_documents(spark, sf_dir):
    """Nations' balances as one strict document, and as lines by region, read back: no NaN is left, null fields stay."""
    c = load(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(F.count("*").alias("n"), F.sum(F.round(F.col("c_acctbal") * 100).cast("long")).alias("cents"))
    odd = F.when(F.col("nation") % 5 == 0, float("nan")).when(F.col("nation") % 5 == 1, float("inf")).otherwise(F.col("cents") / 4.0)
    rows = c.select("nation", "n", odd.alias("quarter"), F.when(F.col("nation") % 2 == 0, "even").alias("kind"))
    document = sinks.keyed(rows, "nation", {"as_of": F.lit("2024")}, ["kind"]).select(F.parse_json("document").alias("d"))
    each = document.select(F.explode(F.try_variant_get("d", "$.rows", "map<string,variant>")).alias("k", "v"), F.try_variant_get("d", "$.kind_counts.None", "long").alias("n_odd"))
    got = each.select(F.col("k").cast("long").alias("nation"), F.try_variant_get("v", "$.n", "long").alias("n"), F.try_variant_get("v", "$.quarter", "double").alias("quarter"), F.try_variant_get("v", "$.kind", "string").alias("kind"), "n_odd")
    path = own_dir(spark, "lines")
    sinks.write_json_parts(rows, path, ["kind"])
    lines = spark.read.schema("nation long, n long, quarter double, kind string").json(path).select("nation", F.col("quarter").alias("line_quarter"), F.col("n").alias("line_n"))
    return got.join(lines, "nation")


def stored_parts(spark, sf_dir):
    """Monthly orders as a table by year, in narrower types; one year is written anew with doubled counts, and an archive keeps what it first had."""
    o = load(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")).agg(F.count("*").alias("n"))
    path, old = own_dir(spark, "months"), own_dir(spark, "archive")
    sinks.write_parts(sinks.narrowed(o, {"n": "int", "month": "short"}), path, ["year"])
    sinks.write_parts(sinks.narrowed(o.where("year = 1996").withColumn("n", F.col("n") * 2), {"n": "int", "month": "short"}), path, ["year"])
    months = spark.read.parquet(path).select(F.col("year").cast("long").alias("year"), F.col("month").cast("long").alias("month"), F.col("n").cast("long").alias("n"))
    sinks.archive(months.where("year <= 1995"), old, ["year"])
    sinks.archive(months.withColumn("n", F.lit(-1).cast("long")).where("year <= 1996"), old, ["year"])
    kept = spark.read.parquet(old).select("year", "month", F.col("n").alias("archived"))
    return months.join(kept, ["year", "month"], "left")


def stored_years(spark, sf_dir):
    """Orders reduced year by year, each written once: a second run makes only the year that is new."""
    o = load(spark, sf_dir, "orders")
    made: list[int] = []

    def rows(year: int) -> DataFrame:
        made.append(year)
        return o.where(F.year("o_orderdate") == year).groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n")).withColumn("year", F.lit(year))

    path = own_dir(spark, "years")
    incremental.yearly(rows, [1995, 1996, 1997], path)
    got = incremental.yearly(rows, [1995, 1996, 1997, 1998], path)
    return got.select(F.col("year").cast("long").alias("year"), "status", "n")


def named_periods(spark, sf_dir):
    """What the names of orders' windows say: period, season, days of the year, codes, and keys of wells and cells."""
    o = load(spark, sf_dir, "orders")
    day = F.to_date("o_orderdate")
    said = F.concat(F.lit("for the Period "), F.date_format(day, "dd-MM-yyyy"), F.when(F.col("o_orderkey") % 2 == 0, " TO ").otherwise(" to "), F.date_format(F.date_add(day, 9), "dd-MM-yyyy"), F.lit(" only"))
    p = N.period(F.when(F.col("o_orderkey") % 10 == 0, F.replace(said, F.lit("-"), F.lit("/"))).otherwise(said))
    lat, lon = F.col("o_custkey") / 16.0, F.col("o_custkey") / 32.0
    code = F.element_at(F.array(*[F.lit(c) for c in ("LE", "E", "N", "D", "LD", "NR", "ND")]), (F.col("o_orderkey") % 7 + 1).cast("int"))
    bins = F.array(*[(F.col("o_orderkey") % 8 + k).cast("double") for k in range(9)])
    rows = o.select("o_orderkey", p.alias("p"), N.days_in_year(F.year(day)).cast("long").alias("days"), N.season_of(day).alias("season"), N.coded(code, N.OFFICIAL_CODES).alias("label"), N.well_key(F.when(F.col("o_orderkey") % 2 == 0, "manual").otherwise("telemetry"), lat, lon, F.lit("site")).alias("well"), N.cell_key(lat, lon).alias("cell"), N.odds(bins).alias("odds"))
    return rows.select("o_orderkey", F.date_format("p.start", "yyyy-MM-dd").alias("start"), F.date_format("p.end", "yyyy-MM-dd").alias("end"), "days", "season", "label", "well", "cell", F.col("odds.cold").alias("cold"), F.col("odds.warm").alias("warm"))


def rain_spi_months(spark, sf_dir):
    """SPI of every month with rain to two places, against the months of the normal years."""
    m = R.monthly(spark, sf_dir)
    base = m.where(F.col("year").between(*R.NORMAL_YEARS))
    scored = spi(m.select("district", "year", "month", "mm"), base, ["district", "month"], "mm", least_years=5, least_wet=5)
    return scored.select("district", "year", "month", rounded(F.col("spi"), 2).alias("spi"))


def archived_seasons(spark, sf_dir):
    """Nations' orders in windows of running and finished seasons, archived twice: the second time with other sums, and with a season that has ended since."""
    o = load(spark, sf_dir, "orders").join(load(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(F.to_date("o_orderdate").alias("day"), F.col("c_nationkey").cast("long").alias("nation"))
    spans = spark.createDataFrame([(a, b) for y in (1996, 1997) for a, b in ((f"{y}-06-01", f"{y}-09-30"), (f"{y}-06-01", f"{y}-08-31"), (f"{y}-06-02", f"{y}-09-30"), (f"{y}-10-01", f"{y}-12-31"), (f"{y}-01-01", f"{y}-12-31"))], "start string, end string")
    spans = spans.select(F.col("start").cast("date"), F.col("end").cast("date"))
    sums = o.join(F.broadcast(spans), F.col("day").between(F.col("start"), F.col("end"))).groupBy("start", "end", "nation").agg(F.count("*").alias("n"))
    path = own_dir(spark, "seasons")
    sinks.archive_finished(sums.where("end < '1997-12-01'"), path, "start", "end")
    sinks.archive_finished(sums.withColumn("n", F.col("n") * 10), path, "start", "end")
    return spark.read.parquet(path).select("season", F.col("season_year").cast("long").alias("year"), "nation", "n")


def nearby_wells(spark, sf_dir):
    """Suppliers as recorders and customers as wells on a map of a kilometre: pairs at most 50 m apart, one to one."""
    at = lambda k, m: 20 + (k * m % 9973) / 1_000_000.0
    s = load(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), at(F.col("s_suppkey"), 3571).alias("lat"), at(F.col("s_suppkey"), 7919).alias("lon"))
    c = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("other"), at(F.col("c_custkey"), 2741).alias("lat"), at(F.col("c_custkey"), 6133).alias("lon"))
    return matching.greedy_pairs(matching.closest(s, c, 50.0), "id", "other", "m")


QUERIES = {f.__name__: f for f in (archived_seasons, nearby_wells, landed_answers, landed_places, landed_readings, landed_boundaries, landed_lines, landed_weekly_table, landed_html_tables, landed_windows, strict_documents, stored_parts, stored_years, named_periods, rain_spi_months)}

_units = "SELECT s_suppkey, n_nationkey, n_name, n_regionkey, round(s_acctbal * 100)::BIGINT AS cents FROM supplier JOIN nation ON s_nationkey = n_nationkey"
_stage = "round_even(cents / 1000.0::DOUBLE * 100, 0) / 100"
_letters = lambda x: f"translate({x}::VARCHAR, '0123456789', 'ABCFGHIJKM')"
_codes = "['LE', 'E', 'N', 'D', 'LD', 'NR', 'ND'][s_suppkey % 7 + 1]"
_actual = "(cents // 10) / 10.0::DOUBLE"

_digamma = "(ln(a + 8) - 0.5 / (a + 8) - 1.0 / (12 * pow(a + 8, 2)) + 1.0 / (120 * pow(a + 8, 4)) - 1.0 / (252 * pow(a + 8, 6)) + 1.0 / (240 * pow(a + 8, 8)) - list_sum(list_transform(range(8), lambda k: 1.0::DOUBLE / (a + k))))"
_trigamma = "(1.0 / (a + 8) + 0.5 / pow(a + 8, 2) + 1.0 / (6 * pow(a + 8, 3)) - 1.0 / (30 * pow(a + 8, 5)) + 1.0 / (42 * pow(a + 8, 7)) + list_sum(list_transform(range(8), lambda k: 1.0::DOUBLE / pow(a + k, 2))))"
#: A rational approximation of the standard normal quantile, below 0.02425, and between this and 0.97575.
_TAIL = "(((((-0.007784894002430293 * q - 0.3223964580411365) * q - 2.400758277161838) * q - 2.549732539343734) * q + 4.374664141464968) * q + 2.938163982698783) / ((((0.007784695709041462 * q + 0.3224671290700398) * q + 2.445134137142996) * q + 3.754408661907416) * q + 1)"
_MIDDLE = "(((((-39.69683028665376 * r + 220.9460984245205) * r - 275.9285104469687) * r + 138.357751867269) * r - 30.66479806614716) * r + 2.506628277459239) * q / (((((-54.47609879822406 * r + 161.5858368580409) * r - 155.6989798598866) * r + 66.80131188771972) * r - 13.28068155288572) * r + 1)"
_low, _mid = _TAIL.replace("q", "sqrt(-2 * ln(p))"), _MIDDLE.replace("* r", "* pow(p - 0.5, 2)").replace("* q", "* (p - 0.5)")
_high = "-(" + _TAIL.replace("q", "sqrt(-2 * ln(1 - p))") + ")"
_spi = f"""WITH RECURSIVE {R._monthly},
b0 AS (SELECT district, month, count(mm) AS n, count(*) FILTER (WHERE mm > 0) AS n_wet, avg((mm <= 0)::INT) AS zero_share, avg(mm) FILTER (WHERE mm > 0) AS mean, avg(ln(mm)) FILTER (WHERE mm > 0) AS mean_log FROM monthly WHERE year BETWEEN {R.NORMAL_YEARS[0]} AND {R.NORMAL_YEARS[1]} GROUP BY ALL HAVING count(mm) >= 5 AND count(*) FILTER (WHERE mm > 0) >= 5),
b1 AS (SELECT *, greatest(ln(mean) - mean_log, 1e-12) AS s FROM b0),
fit AS (SELECT district, month, s, (3 - s + sqrt(pow(s - 3, 2) + 24 * s)) / (12 * s) AS a, 0 AS turn FROM b1
  UNION ALL SELECT district, month, s, greatest(a - (ln(a) - {_digamma} - s) / (1 / a - {_trigamma}), 1e-9), turn + 1 FROM fit WHERE turn < 12),
x AS (SELECT m.district, m.year, m.month, m.mm, zero_share, a, mm * a / mean AS x FROM monthly m LEFT JOIN b1 USING (district, month) LEFT JOIN (SELECT * FROM fit WHERE turn = 12) f USING (district, month)),
p AS (SELECT *, CASE WHEN mm IS NOT NULL AND a IS NOT NULL THEN greatest(least(CASE WHEN mm <= 0 THEN zero_share ELSE zero_share + (1 - zero_share) * least(list_sum(list_transform(range(2500), lambda k: exp((a + k) * ln(x) - x - lgamma(a + k + 1)))), 1) END, 1 - 1e-6), 1e-6) END AS p FROM x)
SELECT district, year, month, CASE WHEN p IS NOT NULL THEN round_even(greatest(least(CASE WHEN p < 0.02425 THEN {_low} WHEN p <= 0.97575 THEN {_mid} ELSE {_high} END, 3.5), -3.5) * 100, 0) / 100 END AS spi FROM p"""
SQL = {
    "rain_spi_months": _spi,
    "archived_seasons": "WITH w(season, y, a, b, k) AS (VALUES ('SW', 1996, DATE '1996-06-01', DATE '1996-09-30', 1), ('NE', 1996, DATE '1996-10-01', DATE '1996-12-31', 1), ('SW', 1997, DATE '1997-06-01', DATE '1997-09-30', 1), ('NE', 1997, DATE '1997-10-01', DATE '1997-12-31', 10)) SELECT season, y::BIGINT AS year, c_nationkey::BIGINT AS nation, count(*) * any_value(k) AS n FROM w JOIN orders ON o_orderdate::DATE BETWEEN a AND b JOIN customer ON o_custkey = c_custkey GROUP BY ALL",
    "nearby_wells": "WITH s AS (SELECT s_suppkey AS id, 20 + (s_suppkey * 3571 % 9973) / 1000000.0::DOUBLE AS lat, 20 + (s_suppkey * 7919 % 9973) / 1000000.0::DOUBLE AS lon FROM supplier), c AS (SELECT c_custkey AS other, 20 + (c_custkey * 2741 % 9973) / 1000000.0::DOUBLE AS lat, 20 + (c_custkey * 6133 % 9973) / 1000000.0::DOUBLE AS lon FROM customer), p AS (SELECT id, other, sqrt(pow(radians(c.lon - s.lon) * cos(radians(s.lat)), 2) + pow(radians(c.lat - s.lat), 2)) * 6371000.0 AS d FROM s, c WHERE abs(c.lat - s.lat) < 0.001 AND abs(c.lon - s.lon) < 0.001), q AS (SELECT id, other, round_even(d * 100, 0) / 100 AS m FROM p WHERE d <= 50), b AS (SELECT * FROM q QUALIFY row_number() OVER (PARTITION BY id ORDER BY m, other) = 1) SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY other ORDER BY m, id) = 1",
    "landed_answers": f"WITH u AS ({_units}) SELECT 'unit ' || s_suppkey AS name, s_suppkey::VARCHAR AS key, ['Safe', 'Semi-critical', 'Critical', 'Over-exploited', 'new word'][s_suppkey % 5 + 1] AS category, CASE WHEN s_suppkey % 2 = 0 THEN 'Saline' END AS poor_quality, {_stage} AS stage_pct, NULL::DOUBLE AS extraction FROM u",
    "landed_places": f"WITH u AS ({_units}) SELECT n_name AS state, n_nationkey::VARCHAR AS state_code, 'd ' || s_suppkey AS district, s_suppkey::VARCHAR AS district_code FROM u",
    "landed_readings": "SELECT 'well ' || l_suppkey AS station, year(l_shipdate) AS year, count(*) AS n, sum(l_quantity::BIGINT)::BIGINT AS total, min(l_suppkey / 8.0::DOUBLE) AS lat, max(l_suppkey / 4.0::DOUBLE) AS lon FROM lineitem WHERE l_orderkey % 50 <> 0 AND l_orderkey % 70 <> 0 GROUP BY ALL",
    "landed_boundaries": "SELECT c_custkey, 2::BIGINT AS n_rings, CASE WHEN c_custkey % 2 = 0 THEN 12 ELSE 13 END::BIGINT AS size, c_mktsegment AS segment FROM customer WHERE c_mktsegment <> 'BUILDING'",
    "landed_lines": f"WITH u AS ({_units}) SELECT 'region_' || n_regionkey || '.txt' AS file, 'NORTH 24 UNIT' || {_letters('s_suppkey')} AS name, (SELECT CASE WHEN max(k) IS NOT NULL THEN 'GROUP OF ' || {_letters('max(k)')} END FROM (SELECT DISTINCT n_nationkey AS k, n_regionkey AS r FROM u) h WHERE h.r = u.n_regionkey AND k % 2 = 1 AND k <= u.n_nationkey) AS \"group\", CASE WHEN n_nationkey % 2 = 1 THEN 'STATE ' || n_nationkey ELSE n_name END AS place, CASE WHEN s_suppkey % 3 <> 0 THEN {_actual} END AS day_actual, (s_suppkey % 90 + 1)::DOUBLE AS day_normal, CASE WHEN s_suppkey % 3 <> 0 THEN (s_suppkey % 40 - 20)::DOUBLE END AS day_dep, CASE WHEN s_suppkey % 3 = 0 THEN 'ND' ELSE {_codes} END AS day_code, {_actual} AS actual, (s_suppkey % 40 - 20)::DOUBLE AS dep, {_codes} AS code FROM u",
    "landed_weekly_table": f"WITH u AS ({_units}) SELECT n_nationkey::BIGINT AS nation, s_suppkey AS unit, 'UNIT ' || {_letters('s_suppkey')} || ' (X)' AS name, CASE WHEN s_suppkey % 4 <> 0 THEN s_suppkey % 200 - 100 END AS dep, s_suppkey % 6 + 2 AS n_weeks FROM u",
    "landed_html_tables": "SELECT conv_id, count(*) AS n, sum(turn)::BIGINT AS turns, -sum(length(coalesce(text, '')))::BIGINT AS length, max(coalesce(role, '')) AS role FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY ALL",
    "landed_windows": "WITH w(s, e, a) AS (VALUES ('1997-06-01', '1997-09-30', 0.0::DOUBLE), ('1998-06-01', '1998-09-30', 5.0::DOUBLE)) SELECT s AS start, e AS end, c_custkey, round_even((round_even(c_acctbal / 100 * 10, 0) / 10 + a) * 10, 0) / 10 AS dep, 'Normal' AS category FROM customer, w WHERE c_custkey % 9 <> 0",
    "strict_documents": "WITH c AS (SELECT c_nationkey::BIGINT AS nation, count(*) AS n, sum(round(c_acctbal * 100)::BIGINT)::BIGINT AS cents FROM customer GROUP BY ALL), r AS (SELECT nation, n, CASE WHEN nation % 5 > 1 THEN cents / 4.0::DOUBLE END AS quarter, CASE WHEN nation % 2 = 0 THEN 'even' END AS kind FROM c) SELECT *, (SELECT count(*) FROM r WHERE kind IS NULL) AS n_odd, quarter AS line_quarter, n AS line_n FROM r",
    "stored_parts": "WITH o AS (SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, count(*) AS n FROM orders GROUP BY ALL) SELECT year, month, CASE WHEN year = 1996 THEN 2 * n ELSE n END AS n, CASE WHEN year <= 1995 THEN n WHEN year = 1996 THEN -1 END AS archived FROM o",
    "stored_years": "SELECT year(o_orderdate) AS year, o_orderstatus AS status, count(*) AS n FROM orders WHERE year(o_orderdate) BETWEEN 1995 AND 1998 GROUP BY ALL",
    "named_periods": "SELECT o_orderkey, CASE WHEN o_orderkey % 10 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS start, CASE WHEN o_orderkey % 10 <> 0 THEN strftime(o_orderdate + INTERVAL 9 DAYS, '%Y-%m-%d') END AS end, dayofyear(make_date(year(o_orderdate), 12, 31)) AS days, CASE WHEN month(o_orderdate) = 6 AND day(o_orderdate) = 1 THEN 'SW' WHEN month(o_orderdate) = 10 AND day(o_orderdate) = 1 THEN 'NE' END AS season, ['Large Excess', 'Excess', 'Normal', 'Deficient', 'Large Deficient', 'No Rain', NULL][o_orderkey % 7 + 1] AS label, CASE WHEN o_orderkey % 2 = 0 THEN 'm:' ELSE 't:' END || format('{:.4f}', o_custkey / 16.0::DOUBLE) || ',' || format('{:.4f}', round_even(o_custkey / 32.0::DOUBLE * 10000, 0) / 10000) || ':site' AS well, format('{:.3f}', round_even(o_custkey / 16.0::DOUBLE * 1000, 0) / 1000) || ',' || format('{:.3f}', round_even(o_custkey / 32.0::DOUBLE * 1000, 0) / 1000) AS cell, (4 * (o_orderkey % 8) + 6)::DOUBLE AS cold, (4 * (o_orderkey % 8) + 26)::DOUBLE AS warm FROM orders",
}
