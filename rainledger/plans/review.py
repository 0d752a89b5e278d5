"""What is asked of the finished status: reasons for what is missing, search and order, replays of a past date, and chance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rainledger.functions.columns import rounded
from rainledger.operators import borders, coverage
from rainledger.operators import table_view as T
from rainledger.operators.geometry import edges_of
from rainledger.operators.nulls import null_rates
from rainledger.operators.series import cycle_medians, midrank
from rainledger.plans import groundwater as G
from rainledger.plans import rain as R
from rainledger.plans import status as S
from rainledger.plans.tables import STAR
from rainledger.sources.shared import settled
from rainledger.sources.tables import load

#: Reasons by layer, in the order in which they are tried: layer, fact, reason.
RULES = [
    ("quadrant", "no_rain", "no_rain_data"), ("quadrant", "young", "season_just_started"), ("quadrant", "few_wells", "gw_too_few_wells"), ("quadrant", "no_wells", "gw_no_wells"),
    ("rain", "no_rain", "no_rain_data"),
    ("spi", "no_rain", "no_rain_data"), ("spi", "always", "too_few_base_years"),
    ("levels", "few_wells", "too_few_wells"), ("levels", "no_wells", "no_wells"),
    ("stress", "no_edition", "no_edition_yet"), ("stress", "assessed", "no_category"), ("stress", "always", "not_assessed"),
    ("index", "before_index", "before_first_week"), ("index", "always", "no_week_in_reach"),
]
MARKED = [1993, 1995, 1998]
REPLAYED = ("2001-05-31", 2001, "PRE")


def _explained(spark, sf_dir) -> DataFrame:
    s = S.status_full(spark, sf_dir)
    layers = {"quadrant": F.col("quadrant"), "rain": F.col("category"), "spi": F.col("spi"), "levels": F.col("pct"), "stress": F.col("stress"), "index": F.col("index_class")}
    facts = {
        "no_rain": F.col("category").isNull() & F.col("spi").isNull() & F.col("dry_weeks").isNull(), "young": F.col("season_days") < 15,
        "few_wells": F.col("tier") == "level_only", "no_wells": F.col("tier") == "insufficient", "no_edition": F.col("edition").isNull(),
        "assessed": F.col("stage_pct").isNotNull(), "before_index": F.col("snapshot") < "1998-06-01",
    }
    place = {}
    rules = [(layer, place.setdefault(layer, []).append(0) or len(place[layer]), fact, reason) for layer, fact, reason in RULES]
    table = spark.createDataFrame(rules, "layer string, place int, fact string, reason string")
    return T.explained(T.unpivoted(s, ["district", "snapshot"], layers, facts), table, ["district", "snapshot"])


def no_data_reasons(spark, sf_dir):
    """Why each layer of each district's status has no value."""
    return _explained(spark, sf_dir).where("reason IS NOT NULL").select("district", "snapshot", "layer", "reason")


def layers_with_data(spark, sf_dir):
    """The layers that do have a value, by district and date."""
    return T.layers_with_data(_explained(spark, sf_dir), ["district", "snapshot"]).select("district", "snapshot", F.array_join("layers", ",").alias("layers"))


def status_search(spark, sf_dir):
    """Customers of nations whose name or segment holds a text, whatever its case and accents: the first forty, by nation down, those without a balance class last."""
    c = load(spark, sf_dir, "customer").join(load(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    kind = F.when(F.col("c_acctbal") < 0, "double").when(F.col("c_acctbal") < 3000, "hidden").when(F.col("c_acctbal") < 6000, "fine")
    rows = c.select("c_custkey", F.col("n_name").alias("district"), F.concat(F.lit("Région "), F.col("n_regionkey")).alias("state"), kind.alias("quadrant"))
    found = T.search(rows, " régiÓN 1", ["district", "state"])
    up = T.page(found, "quadrant", False, T.QUADRANT_RANKS, "c_custkey", 40).withColumn("view", F.lit("quadrant up"))
    down = T.page(found, "quadrant", True, T.QUADRANT_RANKS, "c_custkey", 40, 1).withColumn("view", F.lit("quadrant down, second page"))
    names = T.page(T.search(rows, "NATION_1", ["district"], quadrant="fine"), "district", True, None, "c_custkey", 40).withColumn("view", F.lit("names down"))
    return up.unionByName(down).unionByName(names)


def rain_null_rates(spark, sf_dir):
    """Short years of each district, 20 per cent or more below its mean June to September, in marked years against 2,000 draws of as many random years."""
    d = R.daily(spark, sf_dir).where(F.month("day").between(6, 9)).groupBy("district", F.year("day").cast("long").alias("year")).agg(F.sum("mm").alias("mm"))
    mean = d.groupBy("district").agg(F.avg("mm").alias("normal"))
    flags = d.join(mean, "district").select("district", "year", (rounded((F.col("mm") - F.col("normal")) / F.col("normal") * 100, 6) <= -20).alias("short"))
    n = null_rates(flags, "district", "year", "short", MARKED)
    return n.select("district", "n_years", *[rounded(F.col(c), 6).alias(c) for c in ("rate", "other_rate", "p_value", "q05", "q50", "q95")])


def known_on(layers: dict[str, DataFrame], levels: DataFrame, day: str) -> dict[str, DataFrame]:
    """The layers as they were known on a day: its own snapshot, months and weeks that had ended, official windows, editions and index weeks up to it. levels: ranked among the readings up to it."""
    at = F.lit(day).cast("date")
    first = F.make_date("year", F.lit(1), F.lit(1))
    week_end = F.when(F.col("week") >= 52, F.make_date("year", F.lit(12), F.lit(31))).otherwise(F.date_add(first, (7 * F.col("week") - 1).cast("int")))
    return layers | {
        "dates": layers["dates"].where(F.col("snapshot") == at),
        "monthly": layers["monthly"].where(F.last_day(F.make_date("year", "month", F.lit(1))) <= at),
        "weekly": layers["weekly"].where(week_end <= at),
        "official": layers["official"].where(F.col("end") <= at),
        "editions": layers["editions"].where(F.col("end_year") <= F.year(at)),
        "index": layers["index"].where(F.col("week") <= at),
        "levels": levels,
    }


def replayed(spark, sf_dir, day: str, official: bool = True) -> DataFrame:
    """The status of a day's snapshot from what was known then; without official rain, the gridded one alone decides."""
    layers = S.layers_of(spark, sf_dir)
    readings = load(spark, sf_dir, "lineitem").where(F.to_date("l_shipdate") <= F.lit(day).cast("date"))
    known = cycle_medians(readings, "l_suppkey", "l_shipdate", "l_quantity")
    levels = G.tiers(midrank(known).join(G.districts(spark, sf_dir), "unit"), ["district", "year", "cycle"]).drop("n_units")
    then = known_on(layers, levels, day)
    if not official:
        then["official"] = then["official"].limit(0)
    return S.district_status(**then)


LAYERS = {"rain": ["category", "dep", "source", "dry_weeks", "short"], "levels": ["tier", "pct"], "stress": ["edition", "stress", "stage_pct"], "index": ["index_class", "index_mean", "d0plus"], "quadrant": ["quadrant", "why"]}


def backtest(spark, sf_dir):
    """The status of one snapshot, replayed from what was known then and without official rain."""
    return replayed(spark, sf_dir, REPLAYED[0], False).select("district", "snapshot", "quadrant", "why", "category", "dep", "source", "dry_weeks", "tier", "pct", "stress", "index_class")


def backtest_differences(spark, sf_dir):
    """How many districts a replay with what was known then has as the history has them, by layer: later data change ranks, nothing else."""
    then, now = replayed(spark, sf_dir, REPLAYED[0]), S.status_full(spark, sf_dir).where(F.col("snapshot") == REPLAYED[0])
    old = now.select("district", *[F.col(c).alias(f"_{c}") for c in now.columns if c != "district"])
    same = lambda cs: F.forall(F.array(*[F.col(c).eqNullSafe(F.col(f"_{c}")) for c in cs]), lambda x: x)
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("layer"), same(cs).alias("same")) for k, cs in LAYERS.items()]))
    return then.join(old, "district").select(each.alias("x")).groupBy("x.layer").agg(F.count_if("x.same").alias("n_same"), F.count("*").alias("n"))


def _cells(spark, sf_dir) -> DataFrame:
    x, y = F.col("c_custkey") % 64, F.floor(F.col("c_custkey") / 64)
    corner = lambda a, b: F.struct((x + a).cast("double").alias("x"), (y + b).cast("double").alias("y"))
    ring = F.array(*[corner(a, b) for a, b in ((0, 0), (1, 0), (1, 1), (0, 1))])
    # every other cell goes the other way round, as sources differ in this
    return load(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"), F.array(F.when(F.col("c_custkey") % 2 == 0, ring).otherwise(F.reverse(ring))).alias("rings"))


def dissolved_borders(spark, sf_dir):
    """Customers as cells of a map, the nations' unions of them: the edges of the rings."""
    u = coverage.dissolved(_cells(spark, sf_dir), "nation")
    e = u.select(F.col("area").cast("long").alias("nation"), F.explode(edges_of(F.col("rings"))).alias("e"))
    return e.select("nation", *[F.col(f"e.{c}").cast("long").alias(c) for c in ("x1", "y1", "x2", "y2")])


def dissolved_areas(spark, sf_dir):
    """Area and length of each nation's union."""
    u = coverage.dissolved(_cells(spark, sf_dir), "nation")
    area = F.aggregate(F.transform("rings", coverage.signed_area), F.lit(0.0), lambda s, v: s + v)
    return u.select(F.col("area").cast("long").alias("nation"), area.cast("long").alias("cells"), F.size(edges_of(F.col("rings"))).cast("long").alias("length"))


def inner_points(spark, sf_dir):
    """A point inside a star of each customer, of its own place and size."""
    k, s = F.col("c_custkey"), 1 + F.col("c_custkey") % 7 / 8.0
    ring = F.array(*[F.struct((F.lit(x) * s + k % 97).alias("x"), (F.lit(y) * s + k % 89).alias("y")) for x, y in STAR])
    p = load(spark, sf_dir, "customer").select("c_custkey", coverage.inner_point(F.array(ring)).alias("p"))
    return p.select("c_custkey", rounded(F.col("p.x"), 6).alias("x"), rounded(F.col("p.y"), 6).alias("y"))


#: Shapes that need repair: a bow tie, a square with a spike and corners said twice, two parts that overlap.
BROKEN = (
    [[(0, 0), (2, 2), (2, 0), (0, 2)]],
    [[(0, 0), (4, 0), (4, 0), (4, 4), (2, 4), (2, 6), (2, 4), (0, 4), (0, 0)]],
    [[(0, 0), (4, 0), (4, 2), (0, 2)], [(2, 0), (6, 0), (6, 2), (2, 2)]],
)


def repaired_areas(spark, sf_dir):
    """Rings and area of a broken shape of each customer, of its own place and size, once it's repaired."""
    k, s = F.col("c_custkey"), 1 + F.col("c_custkey") % 5
    corner = lambda x, y: F.struct((x * s + k % 50).cast("double").alias("x"), (y * s + k % 40).cast("double").alias("y"))
    shapes = [F.array(*[F.array(*[corner(x, y) for x, y in ring]) for ring in shape]) for shape in BROKEN]
    p = load(spark, sf_dir, "customer").select(k.alias("area"), F.when(k % 3 == 0, shapes[0]).when(k % 3 == 1, shapes[1]).otherwise(shapes[2]).alias("rings"))
    fixed = borders.repaired(p, 4.0)
    return fixed.select(F.col("area").alias("c_custkey"), F.size("rings").cast("long").alias("n_rings"), F.aggregate(F.transform("rings", coverage.signed_area), F.lit(0.0), lambda a, v: a + v).cast("long").alias("size"))


def simplified_borders(spark, sf_dir):
    """The nations' unions of their customers' cells with half of their corners' text: corners that are left of each ring."""
    u = settled(coverage.dissolved(_cells(spark, sf_dir), "nation"), "unions")
    corners = u.agg(F.sum(F.size(F.flatten("rings"))).alias("n")).first()["n"] or 0
    kept = borders.simplified(u, corners * 5, 0)
    return kept.select(F.col("area").cast("long").alias("nation"), F.posexplode("rings").alias("ring", "line")).select("nation", "ring", F.size("line").alias("corners"))


def _rules_sql(layer: str, missing: str, facts: dict[str, str]) -> str:
    whens = " ".join(f"WHEN {facts[f]} THEN '{r}'" for name, f, r in RULES if name == layer)
    return f"SELECT district, strftime(snapshot, '%Y-%m-%d') AS snapshot, '{layer}' AS layer, {missing} AS missing, CASE WHEN {missing} THEN CASE {whens} ELSE 'no_data' END END AS reason FROM x8"


_facts = {"no_rain": "category IS NULL AND dry_weeks IS NULL", "young": "season_days < 15", "few_wells": "tier = 'level_only'", "no_wells": "tier = 'insufficient'", "no_edition": "edition IS NULL", "assessed": "stage_pct IS NOT NULL", "before_index": "snapshot < DATE '1998-06-01'", "always": "true"}
_missing = {"quadrant": "quadrant IS NULL", "rain": "category IS NULL", "spi": "true", "levels": "pct IS NULL", "stress": "stress IS NULL", "index": "x IS NULL"}
_reasons = S._FULL + ", reasons AS (" + " UNION ALL ".join(_rules_sql(k, v, _facts) for k, v in _missing.items()) + ")"
_then = f"orders AS (SELECT * FROM orders WHERE o_orderdate < DATE '{REPLAYED[0]}' + 1), lineitem AS (SELECT * FROM lineitem WHERE l_shipdate < DATE '{REPLAYED[0]}' + 1), "
_plain_off = S._FULL.replace("WHERE district % 3 = 0 AND year(a) % 2 = 0)", "WHERE false)")
_replay = lambda full: full.replace("WITH ", "WITH " + _then, 1)
_columns = f"district, snapshot, quadrant, CASE WHEN quadrant IS NULL THEN why END AS why, category, round_even(dep * 1000, 0) / 1000 AS dep, source, dry_weeks, short, tier, pct, edition, stress, stage_pct, {S._CLASS} AS index_class, x AS index_mean, d0plus"
_of_day = f"SELECT {_columns} FROM x8 WHERE snapshot = DATE '{REPLAYED[0]}'"
_same = lambda cs: " AND ".join(f"t.{c} IS NOT DISTINCT FROM n.{c}" for c in cs)
_view = """SELECT c_custkey, n_name AS district, 'Région ' || n_regionkey AS state, CASE WHEN c_acctbal < 0 THEN 'double' WHEN c_acctbal < 3000 THEN 'hidden' WHEN c_acctbal < 6000 THEN 'fine' END AS quadrant,
  CASE WHEN c_acctbal < 0 THEN 0 WHEN c_acctbal < 3000 THEN 1 WHEN c_acctbal < 6000 THEN 3 END AS k FROM customer JOIN nation ON c_nationkey = n_nationkey"""
_like = "strip_accents(lower(district || ', ' || state)) LIKE '%region 1%'"
_edges = "c AS (SELECT c_nationkey::BIGINT AS nation, c_custkey % 64 AS x, c_custkey // 64 AS y FROM customer), e AS (SELECT nation, x + a AS x1, y + b AS y1, x + p AS x2, y + q AS y2 FROM c, (VALUES (0, 0, 1, 0), (1, 0, 1, 1), (1, 1, 0, 1), (0, 1, 0, 0)) v(a, b, p, q)), u AS (SELECT * FROM e WHERE NOT EXISTS (SELECT 1 FROM e f WHERE f.nation = e.nation AND f.x1 = e.x2 AND f.y1 = e.y2 AND f.x2 = e.x1 AND f.y2 = e.y1))"
_star = ", ".join(f"({i}, {a}, {b})" for i, (a, b) in enumerate(STAR))

SQL = {
    "no_data_reasons": _reasons + " SELECT district, snapshot, layer, reason FROM reasons WHERE reason IS NOT NULL",
    "layers_with_data": _reasons + " SELECT district, snapshot, coalesce(string_agg(layer, ',' ORDER BY layer) FILTER (WHERE NOT missing), '') AS layers FROM reasons GROUP BY ALL",
    "status_search": f"WITH v AS ({_view}) SELECT c_custkey, district, state, quadrant, view FROM (SELECT * FROM (SELECT *, 'quadrant up' AS view FROM v WHERE {_like} ORDER BY k NULLS LAST, c_custkey LIMIT 40) UNION ALL SELECT * FROM (SELECT *, 'quadrant down, second page' FROM v WHERE {_like} ORDER BY k DESC NULLS LAST, c_custkey LIMIT 40 OFFSET 40) UNION ALL SELECT * FROM (SELECT *, 'names down' FROM v WHERE district LIKE '%NATION_1%' ESCAPE '!' AND contains(district, 'NATION_1') AND quadrant = 'fine' ORDER BY district DESC, c_custkey LIMIT 40))",
    "rain_null_rates": f"WITH {R.DAILY}, s AS (SELECT district, year(day) AS year, sum(mm) AS mm FROM daily WHERE month(day) BETWEEN 6 AND 9 GROUP BY ALL), f AS (SELECT district, year, round_even((mm - avg(mm) OVER w) / avg(mm) OVER w * 100 * 1e6, 0) / 1e6 <= -20 AS short FROM s WINDOW w AS (PARTITION BY district)), ys AS (SELECT DISTINCT year FROM f), k AS (SELECT count(*) AS k FROM ys WHERE year IN {tuple(MARKED)}), dr AS (SELECT d, year FROM ys, range(2000) t(d) QUALIFY row_number() OVER (PARTITION BY d ORDER BY md5('0-' || d || '-' || year), year) <= (SELECT k FROM k)), r AS (SELECT district, d, avg(short::INT) AS rate FROM dr JOIN f USING (year) GROUP BY ALL), l AS (SELECT district, list_sort(list(rate)) AS rates FROM r GROUP BY ALL), o AS (SELECT district, count(*) AS n_years, avg(short::INT) FILTER (WHERE year IN {tuple(MARKED)}) AS rate, avg(short::INT) FILTER (WHERE year NOT IN {tuple(MARKED)}) AS other_rate FROM f GROUP BY ALL) SELECT district, n_years, round_even(rate * 1e6, 0) / 1e6 AS rate, round_even(other_rate * 1e6, 0) / 1e6 AS other_rate, round_even(len(list_filter(rates, lambda v: v >= rate))::DOUBLE / len(rates) * 1e6, 0) / 1e6 AS p_value, " + ", ".join(f"round_even(rates[floor({q} * (len(rates) - 1))::BIGINT + 1] * 1e6, 0) / 1e6 AS q{round(q * 100):02d}" for q in (0.05, 0.5, 0.95)) + " FROM o JOIN l USING (district)",
    "backtest": _replay(_plain_off) + f"SELECT district, '{REPLAYED[0]}' AS snapshot, quadrant, why, category, dep, source, dry_weeks, tier, pct, stress, index_class FROM ({_of_day})",
    "backtest_differences": f"WITH past AS ({_replay(S._FULL)} {_of_day}), present AS ({S._FULL} {_of_day}) SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{k}' AS layer, count(*) FILTER (WHERE {_same(cs)}) AS n_same, count(*) AS n FROM past t JOIN present n USING (district)" for k, cs in LAYERS.items()) + ")",
    "dissolved_borders": f"WITH {_edges} SELECT nation, x1, y1, x2, y2 FROM u",
    "dissolved_areas": f"WITH {_edges} SELECT nation, cells, length FROM (SELECT nation, count(*) AS cells FROM c GROUP BY ALL) JOIN (SELECT nation, count(*) AS length FROM u GROUP BY ALL) USING (nation)",
    "repaired_areas": "SELECT c_custkey, CASE c_custkey % 3 WHEN 1 THEN 1 ELSE 2 END::BIGINT AS n_rings, (1 + c_custkey % 5) * (1 + c_custkey % 5) * CASE c_custkey % 3 WHEN 0 THEN 2 WHEN 1 THEN 16 ELSE 8 END AS size FROM customer",
    "inner_points": f"WITH p AS (SELECT c_custkey, i, a::DOUBLE * (1 + c_custkey % 7 / 8.0::DOUBLE) + c_custkey % 97 AS x, b::DOUBLE * (1 + c_custkey % 7 / 8.0::DOUBLE) + c_custkey % 89 AS y FROM customer, (VALUES {_star}) v(i, a, b)), m AS (SELECT c_custkey, (min(y) + max(y)) / 2 AS mid FROM p GROUP BY ALL), h AS (SELECT c_custkey, (max(y) FILTER (WHERE y <= mid) + min(y) FILTER (WHERE y > mid)) / 2 AS h FROM p JOIN m USING (c_custkey) GROUP BY ALL), x AS (SELECT p.c_custkey, h, p.x + (h - p.y) / (q.y - p.y) * (q.x - p.x) AS x FROM p JOIN p q ON q.c_custkey = p.c_custkey AND q.i = (p.i + 1) % {len(STAR)} JOIN h ON h.c_custkey = p.c_custkey WHERE (p.y > h) <> (q.y > h)), n AS (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY x) AS n, lead(x) OVER (PARTITION BY c_custkey ORDER BY x) AS e FROM x), b AS (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY e - x DESC, x) AS k FROM n WHERE n % 2 = 1) SELECT c_custkey, round_even((x + e) / 2 * 1e6, 0) / 1e6 AS x, round_even(h * 1e6, 0) / 1e6 AS y FROM b WHERE k = 1",
}
QUERIES = {k: globals()[k] for k in [*SQL, "simplified_borders"]}
