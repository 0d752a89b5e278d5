import math
from datetime import date, datetime
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from rainledger.functions import columns as C
from rainledger.functions.columns import rounded
from rainledger.operators import matching, series, spi
from rainledger.plans.groundwater import tiers
from rainledger.sources import tables as T
from rainledger.streaming.upserts import upsert, windowed


def values(spark, rows, kind, *columns):
    return [tuple(r) for r in spark.createDataFrame([(x,) for x in rows], f"x {kind}").select(*columns).collect()]


def test_category_rounds_half_even_first(spark):
    got = values(spark, [60.0, 59.5, 19.5, 20.5, -19.5, -19.4, -59.5, -99.4, -100.0, None], "double", C.category(F.col("x")))
    assert [g[0] for g in got] == ["Large Excess", "Large Excess", "Excess", "Excess", "Deficient", "Normal", "Large Deficient", "Large Deficient", "No Rain", None]


def test_index_class_is_closed_on_the_dry_side(spark):
    assert [g[0] for g in values(spark, [-0.49, -0.5, -0.8, -1.3, -1.6, -2.0, None], "double", C.index_class(F.col("x")))] == ["none", "d0", "d1", "d2", "d3", "d4", None]


def test_met_week_and_cycles(spark):
    x = F.col("x")
    got = values(spark, [date(2024, 12, 31), date(2023, 1, 7), date(2023, 1, 8), date(2022, 12, 5)], "date", C.met_week(x), C.cycle_of(x), C.cycle_year(x))
    assert got == [(52, "JAN", 2025), (1, "JAN", 2023), (2, "JAN", 2023), (49, "JAN", 2023)]


def test_season_windows(spark):
    days = [date(2024, 11, 2), date(2024, 3, 1), date(2024, 7, 9)]
    north = values(spark, days, "date", C.season_window(F.col("x"), F.lit(True)).alias("w"))
    south = values(spark, days, "date", C.season_window(F.col("x"), F.lit(False)).alias("w"))
    assert [tuple(w[0]) for w in north] == [("NE", date(2024, 10, 1), days[0]), ("NE", date(2023, 10, 1), date(2023, 12, 31)), ("SW", date(2024, 6, 1), days[2])]
    assert [tuple(w[0]) for w in south] == [("SW", date(2024, 6, 1), date(2024, 9, 30)), ("SW", date(2023, 6, 1), date(2023, 9, 30)), ("SW", date(2024, 6, 1), days[2])]


def test_rules_have_three_values(spark):
    q = spark.sql("SELECT * FROM VALUES (true, true), (true, false), (false, true), (false, false), (null, true), (true, null) t(a, b)")
    assert [r[0] for r in q.select(C.quadrant(F.col("a"), F.col("b"))).collect()] == ["double", "buffered", "hidden", "fine", None, None]
    rows = spark.sql("SELECT * FROM VALUES ('Deficient', -1.0D, 4), ('Normal', null, 3), (null, null, null) t(c, s, d)")
    got = [r[0] for r in rows.select(C.rain_reasons(F.col("c"), F.col("s"), F.col("d"))).collect()]
    assert got == [["deviation", "spi", "dry_spell"], [], None]


def test_rounding_and_names(spark):
    assert values(spark, [2.5, 0.125, math.nan], "double", C.rounded(F.col("x")), C.rounded(F.col("x"), 2))[:2] == [(2.0, 2.5), (0.0, 0.12)]
    assert values(spark, [math.nan, math.inf, 1.0], "double", C.finite(F.col("x"))) == [(None,), (None,), (1.0,)]
    assert values(spark, ["Site A_12 "], "string", C.base_name(F.trim("x"))) == [("site a",)]
    assert values(spark, ["North & South Dist. 24"], "string", C.plain_name(F.col("x"))) == [("northandsouth24",)]


def test_midrank_low_and_tiers(spark):
    rows = [(u, 2000 + y, "PRE", float(v)) for u, levels in {"a": [1, 2, 3, 2], "b": [5, 5, 5, 9]}.items() for y, v in enumerate(levels)]
    got = {(r.unit, r.year): (r.hist_years, r.pct) for r in series.midrank(spark.createDataFrame(rows, "unit string, year long, cycle string, level double")).collect()}
    assert got["a", 2003] == (3, 50.0) and got["b", 2002] == (2, 50.0) and got["b", 2003] == (3, 0.0) and got["a", 2000] == (0, None)
    ranked = spark.createDataFrame([("d", 12, 20.04), ("e", 1, 9.0)], "district string, hist_years long, pct double")
    got = {r.district: (r.tier, r.pct, r.low) for r in tiers(ranked, ["district"]).collect()}
    assert got == {"d": ("provisional", 20.0, False), "e": ("level_only", None, None)}  # the exact percentile decides, not the rounded one


def test_runs_rolling_and_slopes(spark):
    flags = spark.createDataFrame([("a", 1, True), ("a", 2, True), ("a", 4, True), ("b", 1, False)], "k string, w int, dry boolean")
    assert {r.k: r.longest for r in series.longest_run(flags, ["k"], "w", "dry").collect()} == {"a": 2, "b": 0}
    s = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0), ("a", 3, 3.0), ("a", 5, 9.0)], "k string, m int, v double")
    assert [r.rolled for r in series.rolling_sum(s, ["k"], "m", "v", 3).orderBy("m").collect()] == [None, None, 6.0, None]
    dice = np.random.default_rng(4)
    y = dice.normal(size=9)
    want = np.median([(y[j] - y[i]) / (j - i) for i in range(9) for j in range(i + 1, 9)])
    got = series.sen_slope(spark.createDataFrame([("a", i, float(v)) for i, v in enumerate(y)], "k string, x int, y double"), ["k"], "x", "y").first()
    assert got.slope == pytest.approx(want) and got.n_years == 9


def test_as_of_and_pairs(spark):
    left = spark.createDataFrame([("a", 5), ("a", 1), ("b", 9)], "k string, t int")
    right = spark.createDataFrame([("a", 2, "x"), ("a", 5, "y"), ("b", 10, "z")], "k string, u int, name string")
    assert {(r.k, r.t): r.name for r in series.as_of(left, right, "t", "u", ["k"], ["name"]).collect()} == {("a", 5): "y", ("a", 1): None, ("b", 9): None}
    scored = spark.createDataFrame([(1, 7, 0.1), (1, 8, 0.2), (2, 7, 0.05), (2, 8, 0.3)], "l int, r int, s double")
    assert [tuple(x) for x in matching.greedy_pairs(scored, "l", "r", "s").collect()] == [(2, 7, 0.05)]
    a = spark.createDataFrame([(1, 20.0, 75.0)], "id int, lat double, lon double")
    b = spark.createDataFrame([(10, 20.0003, 75.0), (11, 20.0, 75.0006), (12, 20.0, 75.0004)], "other int, lat double, lon double")
    assert {r.other for r in matching.within(a, b, 50).collect()} == {10, 12}


def test_closest_of_crowded_places(spark):
    dice = np.random.default_rng(5)
    at = lambda n, spread: [(k, 20 + float(y) * spread, 75 + float(x) * spread) for k, (y, x) in enumerate(dice.integers(0, 30, (n, 2)))]
    a, b = at(60, 4e-5) + [(100, 20.01, 75.0), (101, None, 75.0)], at(400, 2e-5) + [(999, 20.0103, 75.0)]
    left, right = spark.createDataFrame(a, "id int, lat double, lon double"), spark.createDataFrame(b, "other int, lat double, lon double")
    pairs = matching.within(left, right, 50).select("id", "other", rounded(F.col("m"), 2).alias("m")).collect()
    want = {i: min((r.m, r.other) for r in pairs if r.id == i) for i in {r.id for r in pairs}}
    assert {r.id: (r.m, r.other) for r in matching.closest(left, right, 50).collect()} == want and 100 in want
    assert len(want) < 60


def test_crowded_places_are_met_once(spark):
    """40,000 recorders and 40,000 wells at three places each are 1.6 billion pairs."""
    at = lambda name: spark.range(40_000).select(F.col("id").alias(name), (20 + (F.col("id") % 3) * 1e-5).alias("lat"), F.lit(75.0).alias("lon"))
    got = matching.closest(at("id"), at("other"), 50)
    assert {(r.k, r.other, r.m): r["count"] for r in got.groupBy((F.col("id") % 3).alias("k"), "other", "m").count().collect()} == {(0, 0, 0.0): 13_334, (1, 1, 0.0): 13_333, (2, 2, 0.0): 13_333}


def test_closest_values(spark):
    dice = np.random.default_rng(6)
    for grain, low in ((1.0, 0), (100.0, 0), (100.0, 490_000), (7.3, 0)):
        a = [(k, int(n), float(v + low) / grain) for k, (n, v) in enumerate(zip(dice.integers(0, 3, 80), dice.integers(-300, 900, 80)))] + [(500, None, 1.0), (501, 1, None)]
        b = [(k, int(n), float(v + low) / grain) for k, (n, v) in enumerate(zip(dice.integers(0, 3, 150), dice.integers(-300, 900, 150)))] + [(500, None, 1.0)]
        got = matching.closest_value(spark.createDataFrame(a, "id int, n int, x double"), spark.createDataFrame(b, "other int, n int, y double"), "n", 3.0)
        gap = lambda x, y: float(np.rint(abs(x - y) * 100) / 100)
        near = {i: [(gap(x, y), o) for o, m, y in b if m == n and gap(x, y) <= 3] for i, n, x in a[:-2]}
        assert {r.id: (r.gap, r.other) for r in got.collect()} == {i: min(v) for i, v in near.items() if v}


def test_counts_in_intervals(spark):
    dice = np.random.default_rng(7)
    for grain, n in ((100.0, 600), (3.0, 600), (1.0, 40)):
        points = [(k, float(v) / grain) for k, v in enumerate(dice.integers(-500, 2000, n))] + [(900, None)]
        boxes = [(float(a) / grain, float(a + w) / grain) for a, w in zip(dice.integers(-900, 2400, 200), dice.choice([0, 1, 7, 300, 5000], 200))] + [(None, 1.0), (5.0, 1.0), (-math.inf, math.inf)]
        got = matching.within_interval(spark.createDataFrame(boxes, "low double, high double"), spark.createDataFrame(points, "id int, x double"), "id")
        held = {b: [k for k, x in points if x is not None and None not in b and b[0] <= x <= b[1]] for b in boxes}
        assert {(r.low, r.high): (r.n, r.first) for r in got.collect()} == {b: (len(v), min(v)) for b, v in held.items() if v}
    assert matching.within_interval(spark.createDataFrame([(0.0, 1.0)], "low double, high double"), spark.createDataFrame([], "id int, x double"), "id").collect() == []


def test_many_values_in_wide_intervals(spark):
    """20,000 intervals that hold most of 100,000 points are two billion pairs."""
    points = spark.range(100_000).select("id", (F.col("id") / 7.0).alias("x"))
    boxes = spark.range(20_000).select((F.col("id") / 10.0).alias("low"), (10_000 + F.col("id") / 10.0).alias("high"))
    got = matching.within_interval(boxes, points, "id").orderBy("low").collect()
    assert len(got) == 20_000 and [(r.n, r.first) for r in got[:2]] == [(70_001, 0), (70_000, 1)]


def test_overlaps_are_worked_out_where_pairs_meet(spark):
    left, right = spark.createDataFrame([(1, 0), (2, 0), (3, 1)], "id int, k int"), spark.createDataFrame([(7, 0), (8, 0), (9, 2)], "other int, k int")
    recorded = spark.createDataFrame([(1, 2000, 1.0), (1, 2001, 4.0), (1, 2002, None), (2, 2000, 5.0), (2, 2009, 1.0)], "id int, year int, v double")
    measured = spark.createDataFrame([(7, 2000, 3.0), (7, 2001, 1.0), (7, 2002, 0.0), (8, 2001, 1.0)], "other int, year int, v double")
    got = matching.overlaps(left, right, ["k"], F.col("id") < 9, recorded, measured)
    assert [tuple(r) for r in got.collect()] == [(1, 7, 3, 2.5, 0.5)]


def test_spi_of_sums_that_vary_little(spark):
    """A standard deviation above the mean of years that differ by half a per cent is about 1."""
    base = spark.createDataFrame([("a", 1e6 * (1 + 0.005 * NormalDist().inv_cdf((k + 0.5) / 40))) for k in range(40)], "k string, v double")
    got = {r.v: r.spi for r in spi.spi(spark.createDataFrame([("a", 1e6 * (1 + 0.005 * z)) for z in (-1.0, 0.0, 1.0)], "k string, v double"), base, ["k"], "v").collect()}
    assert [got[v] for v in sorted(got)] == pytest.approx([-1, 0, 1], abs=0.05)


def test_weighted_mean_and_dedupe(spark):
    cells = spark.createDataFrame([(0, 1.0), (1, None), (2, 4.0)], "cell int, v double")
    w = spark.createDataFrame([(0, "d", 1.0), (1, "d", 2.0), (2, "d", 1.0), (1, "e", 1.0)], "cell int, area string, w double")
    assert {r.area: (r["mean"], r.coverage) for r in series.weighted_mean(cells, w, "cell", ["area"], "v", "w").collect()} == {"d": (2.5, 0.5), "e": (None, 0.0)}
    assert [r.v for r in series.only_unambiguous(spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int"), ["k"]).collect()] == [3]


def test_spi_kernel():
    a = np.array([1.0, 2.0, 5.0])
    assert spi.gamma_share(a, np.array([1.0, 5.0, 2.0])) == pytest.approx([1 - math.exp(-1), 1 - 6 * math.exp(-5), 1 - math.exp(-2) * sum(2**k / math.factorial(k) for k in range(5))], abs=1e-12)
    shape = spi.gamma_shape(np.array([math.log(3) - (-0.5772156649015329 + 1 + 1 / 2 - 0.0)]))  # mean 3, mean log of a gamma of shape 3
    assert shape == pytest.approx([3.0], abs=1e-3)


@pytest.mark.parametrize("a", [3, 300, 20_000, 90_000, 120_000])
def test_spi_kernel_of_large_shapes(a):
    """Sums of many rows vary little, so their shape is large; shares against sums of Poisson probabilities."""
    x = np.array([a + z * math.sqrt(a) for z in (-1.5, -0.3, -0.01, 0.01, 0.3, 3.0)])
    want = [1 - math.fsum(math.exp(k * math.log(v) - v - math.lgamma(k + 1)) for k in range(a)) for v in x]
    assert spi.gamma_share(np.full(6, float(a)), x) == pytest.approx(want, abs=1e-9)


def test_spi_on_rows(spark):
    dice = np.random.default_rng(1)
    base = spark.createDataFrame([("a", float(v)) for v in dice.gamma(2, 50, 50)] + [("b", 0.0)] * 50, "k string, v double")
    now = spark.createDataFrame([("a", 0.0), ("a", 2000.0), ("a", None), ("b", 5.0)], "k string, v double")
    got = {(r.k, r.v): r.spi for r in spi.spi(now, base, ["k"], "v").collect()}
    assert got["a", 0.0] == -3.5 and got["a", 2000.0] == 3.5 and got["a", None] is None and got["b", 5.0] is None


def test_sources_and_sinks(spark, tmp_path):
    np.array([1, -999, 3, 4], "<f4").tofile(tmp_path / "grid.bin")
    assert [r.value for r in T.rasters(spark, str(tmp_path / "grid.bin"), 2).orderBy("day", "cell").collect()] == [1.0, None, 3.0, 4.0]
    (tmp_path / "w.csv").write_text("Station,Latitude,Longitude,Data Acquisition Time,Groundwater Level (meter)\nA,1.5,2,05-11-2023 06:00,3.5\nB,x,2,05-11-2023 06:00,1\nC,1,2,bad,1\n")
    assert [(r.station, r.t, r.value) for r in T.readings(spark, str(tmp_path / "w.csv")).collect()] == [("A", datetime(2023, 11, 5, 6), 3.5)]
    (tmp_path / "i_20240105.txt").write_text("1.0 2.0 -0.7\nNaN NaN NaN\n3 4 NaN\n")
    assert sorted(tuple(r) for r in T.index_grids(spark, str(tmp_path / "i_20240105.txt")).collect()) == [(date(2024, 1, 5), 1.0, 2.0, -0.7), (date(2024, 1, 5), 3.0, 4.0, None)]
    T.write_json(spark.createDataFrame([Row(a=math.nan, b="x"), Row(a=1.0, b=None)]), str(tmp_path / "json"))
    assert sorted(x for f in (tmp_path / "json").glob("*.json") for x in f.read_text().split("\n") if x) == ['{"a":1.0,"b":null}', '{"a":null,"b":"x"}']


def test_stream_upserts(spark, tmp_path):
    rows = [(1, datetime(2024, 1, 1), 2.0), (1, datetime(2024, 1, 2), 4.0), (2, datetime(2024, 1, 9), 1.0)]
    spark.createDataFrame(rows, "u int, t timestamp, v double").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("u int, t timestamp, v double").parquet(f"{tmp_path}/in")
    upsert(windowed(stream, "u", "t", "v"), f"{tmp_path}/out", ["start", "unit"], f"{tmp_path}/check").awaitTermination(90)
    last = max((int(p.name) for p in (tmp_path / "out").iterdir()))
    got = {(r.unit, r.n, r.total) for r in spark.read.parquet(f"{tmp_path}/out/{last}").collect()}
    assert got == {(1, 2, 6.0), (2, 1, 1.0)}


def test_spi_between_its_ends(spark):
    """Against a maximum-likelihood fit by bisection and a distribution function by summing the density."""
    dice = np.random.default_rng(8)
    years = [0.0, 0.0] + [float(v) for v in dice.gamma(3, 40, 38)]
    wet = np.array([v for v in years if v > 0])
    slope = lambda a: (math.lgamma(a + 1e-5) - math.lgamma(a - 1e-5)) / 2e-5
    low, high, want = 0.01, 100.0, math.log(wet.mean()) - np.log(wet).mean()
    for _ in range(100):
        a = (low + high) / 2
        low, high = (a, high) if math.log(a) - slope(a) > want else (low, a)
    values = [20.0, 80.0, 120.0, 300.0]
    out = {}
    for v in values:
        x = (np.arange(200_000) + 0.5) * v / 200_000
        density = np.exp((a - 1) * np.log(x) - x * a / wet.mean() - math.lgamma(a) - a * math.log(wet.mean() / a))
        out[v] = NormalDist().inv_cdf(0.05 + 0.95 * density.sum() * v / 200_000)
    base = spark.createDataFrame([("a", v) for v in years], "k string, v double")
    got = {r.v: r.spi for r in spi.spi(spark.createDataFrame([("a", v) for v in values] + [("z", 1.0)], "k string, v double"), base, ["k"], "v").collect()}
    assert got.pop(1.0) is None and got == pytest.approx(out, abs=1e-4)


def test_ties_of_as_of_and_sources(spark, tmp_path):
    left = spark.createDataFrame([("a", 5)], "k string, t int")
    right = spark.createDataFrame([("a", 2, "x"), ("a", 2, "y"), ("a", 2, "w")], "k string, u int, name string")
    assert series.as_of(left, right, "t", "u", ["k"], ["name"]).first().name == "y"
    head = "Station,Latitude,Longitude,Data Acquisition Time,"
    (tmp_path / "m.csv").write_text(head + "Groundwater Level (m)\nA,1,2,05-11-2023 06:00,3.5\n")
    (tmp_path / "t.csv").write_text(head + "Groundwater Level Telemetry\nB,1,2,05-11-2023 06:00,4.5\n")
    assert {(r.station, r.value) for r in T.readings(spark, str(tmp_path / "m.csv"), str(tmp_path / "t.csv")).collect()} == {("A", 3.5), ("B", 4.5)}
    (tmp_path / "n.csv").write_text(head + "Depth\nB,1,2,05-11-2023 06:00,4.5\n")
    with pytest.raises(ValueError, match="no column"):
        T.readings(spark, str(tmp_path / "n.csv"))
    T.write_json(spark.createDataFrame([(1, 2.0), (2, math.nan)], "k int, v double"), f"{tmp_path}/by", ["k"])
    assert next((tmp_path / "by/k=2").glob("*.json")).read_text() == '{"v":null}\n'


def test_stream_upserts_touch_few_parts_and_leave_late_rows(spark, tmp_path):
    kind = "u int, t timestamp, v double"

    def land(k, *rows):
        spark.createDataFrame(list(rows), kind).coalesce(1).write.parquet(f"{tmp_path}/in/{k}")

    def run():
        stream = spark.readStream.schema(kind).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
        days = windowed(stream, "u", "t", "v", "1 day", "2 days").withColumn("day", F.to_date("start"))
        upsert(days, f"{tmp_path}/out", ["start", "unit"], f"{tmp_path}/check", by="day").awaitTermination(90)
        return {(str(r.day), r.unit, r.n, r.total) for r in spark.read.parquet(f"{tmp_path}/out").collect()}

    land("a", (1, datetime(2024, 1, 1, 3), 2.0), (1, datetime(2024, 1, 9), 4.0))
    assert run() == {("2024-01-01", 1, 1, 2.0), ("2024-01-09", 1, 1, 4.0)}
    before = {p.name for p in (tmp_path / "out/day=2024-01-01").iterdir()}
    land("b", (2, datetime(2024, 1, 9, 5), 1.0), (1, datetime(2024, 1, 9, 6), 1.0), (1, datetime(2024, 1, 1, 5), 50.0))  # the last is beyond the watermark
    assert run() == {("2024-01-01", 1, 1, 2.0), ("2024-01-09", 1, 2, 5.0), ("2024-01-09", 2, 1, 1.0)}
    assert {p.name for p in (tmp_path / "out/day=2024-01-01").iterdir()} == before
