import math
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from rainledger.operators import geometry as G
from rainledger.operators import incremental as I
from rainledger.operators import shape as S

RINGS = "area long, rings array<array<struct<x:double,y:double>>>"


def brute(polygons, x, y):
    for area, rings in sorted(polygons):
        odd = False
        for ring in rings:
            for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
                if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                    odd = not odd
        if odd:
            return area
    return None


def test_points_in_polygons_against_brute_force(spark):
    dice = np.random.default_rng(6)
    polygons = []
    for k in range(12):
        cx, cy, n = *dice.uniform(-3, 3, 2), int(dice.integers(3, 40))
        turn, far = np.sort(dice.uniform(0, 2 * math.pi, n)), dice.uniform(0.2, 2, n)
        rings = [[(float(cx + f * math.cos(t)), float(cy + f * math.sin(t))) for t, f in zip(turn, far)]]
        if k % 3 == 0:
            rings.append([(float(cx + 0.1 * a), float(cy + 0.1 * b)) for a, b in ((-1, -1), (-1, 1), (1, 1), (1, -1))])
        polygons.append((k, rings))
    spots = [(i, float(a), float(b)) for i, (a, b) in enumerate(dice.uniform(-5, 5, (600, 2)))] + [(600, None, 1.0)]
    points = spark.createDataFrame(spots, "id int, x double, y double")
    areas = spark.createDataFrame(polygons, RINGS)
    got = {r.id: r.area for r in G.point_in_polygon(points, areas, 0.7).collect()}
    assert got == {i: None if x is None else brute(polygons, x, y) for i, x, y in spots}
    again = points.union(points).withColumn("_i", F.lit(3)).drop("_i")
    for way in (again.repartition(7), again.groupBy("id", "x", "y").count().drop("count").union(points), again.orderBy("y")):  # after shuffles, and repeated rows
        rows = G.point_in_polygon(way, areas, 0.7).collect()
        assert len(rows) == way.count() and all(r.area == got[r.id] for r in rows)
    assert G.point_in_polygon(points.limit(0), areas).count() == 0 and G.point_in_polygon(points, areas.limit(0)).where("area IS NOT NULL").count() == 0


def test_areas_are_true(spark):
    e = math.sqrt(G.ECC2)

    def band(lat):  # area from the equator to a latitude, a degree wide
        s = math.sin(math.radians(lat))
        return G.AXIS_M**2 * (1 - G.ECC2) / 2 * (s / (1 - G.ECC2 * s * s) - math.log((1 - e * s) / (1 + e * s)) / (2 * e)) * math.radians(1) / 1e6

    sides = lambda n: [(75 + k / n, 20.0) for k in range(n)] + [(76.0, 20 + k / n) for k in range(n)] + [(76 - k / n, 21.0) for k in range(n)] + [(75.0, 21 - k / n) for k in range(n)]
    hole = [(75.4, 20.4), (75.4, 20.6), (75.6, 20.6), (75.6, 20.4)]
    df = spark.createDataFrame([(1, [sides(50)]), (2, [sides(50), hole]), (3, [[(75.0, 20.0), (76.0, 20.0), (75.5, 21.0)]])], RINGS)
    whole = {r.area: r.km2 for r in G.polygon_areas(df).collect()}
    assert whole[1] == pytest.approx(band(21) - band(20), rel=1e-6)
    assert whole[1] - whole[2] == pytest.approx((band(20.6) - band(20.4)) * 0.2, rel=1e-4)
    cells = G.cell_areas(df, 0.25).collect()
    for k in whole:
        assert sum(c.km2 for c in cells if c.area == k) == pytest.approx(whole[k], rel=1e-6)
    inner = next(c for c in cells if c.area == 1 and (c.cell_x, c.cell_y) == (75.25, 20.25))
    assert inner.km2 == pytest.approx((band(20.375) - band(20.125)) * 0.25, rel=1e-4)
    assert not [c for c in cells if c.km2 <= 0.01]


def test_shapes(spark):
    rows = spark.createDataFrame([("d", 1, "a", 2.0), ("d", 1, "a", 3.0), ("d", 1, "b", None), ("e", 2, "b", 1.0)], "k string, y int, n string, v double")
    flat = S.wide(rows, ["k"], "n", "v", ["a", "b", "c"])
    assert {tuple(r) for r in flat.collect()} == {("d", 5.0, None, None), ("e", None, 1.0, None)}
    assert {tuple(r) for r in S.long(flat, ["k"], ["a", "b", "c"], "n", "v").collect()} == {("d", "a", 5.0), ("e", "b", 1.0)}
    assert {tuple(r) for r in S.crosstab(rows, "k", "n", ["a", "b"]).collect()} == {("d", 2, 1), ("e", 0, 1)}
    grid = S.full_grid(rows.groupBy("k", "y").agg(F.sum("v").alias("v")), rows.select("k").distinct(), rows.select("y").distinct())
    assert {tuple(r) for r in grid.collect()} == {("d", 1, 5.0), ("d", 2, None), ("e", 1, None), ("e", 2, 1.0)}
    assert rows.where("v IS NOT NULL").groupBy("k").agg(S.by_year(F.col("y"), F.col("v")).alias("m")).where("k = 'e'").first().m == {"2": [1.0]}
    a = spark.createDataFrame([(1, 1.0, "x"), (2, 2.0, None), (None, 3.0, "z")], "k int, v double, t string")
    b = spark.createDataFrame([(1, 1.05, "x"), (2, None, None), (3, 3.0, "z")], "k int, v double, t string")
    assert {tuple(r) for r in S.differences(a, b, ["k"], ["v", "t"], 0.1).collect()} == {(1, 2, 2, True), (2, 1, 2, False), (3, 0, 2, False), (None, 0, 2, False)}
    assert {r.k: r.same for r in S.differences(a, b, ["k"], ["v"], 0.04, relative=True).collect()}[1] is False


def test_what_is_stored_and_what_is_fresh(spark):
    old = spark.createDataFrame([("a", date(2024, 1, 5), 1.0, "east"), ("b", date(2024, 2, 1), 2.0, None)], "k string, t date, v double, side string")
    new = spark.createDataFrame([("a", date(2024, 1, 5), 9.0, "west"), ("b", date(2024, 3, 1), 8.0, "west"), ("c", date(2023, 1, 1), 7.0, None)], "k string, t date, v double, side string")
    rows = lambda df, *c: {tuple(str(r[x]) for x in c) for r in df.collect()}
    assert rows(I.beyond(new, old, "t"), "k") == {("b",)} and I.beyond(new, old.limit(0), "t").count() == 3
    assert rows(I.fetch_from(new, old, "k", "t", 30, "2000-01-01"), "k", "since") == {("a", "2023-12-06"), ("b", "2024-01-02"), ("c", "2000-01-01")}
    assert rows(I.whole_periods_win(old, new, ["k"], "t"), "k", "v") == {("a", "9.0"), ("b", "8.0")}
    assert rows(I.rebuilt_from(old, new, "t", "2024-01-31"), "k", "v") == {("a", "1.0"), ("b", "8.0")}
    assert rows(I.sticky(new, old, "k", ["side"]), "k", "side") == {("a", "east"), ("b", "west"), ("c", "None")}
    assert rows(I.newest(old, new, "k", "t"), "k", "v") == {("a", "1.0"), ("b", "8.0"), ("c", "7.0")}
    year = lambda df: df.withColumn("y", F.year("t")).drop("side")
    assert rows(I.later_years(year(new), year(old).withColumn("y", F.col("y") + F.when(F.col("k") == "b", 1).otherwise(0)), "y"), "k", "v") == {("a", "9.0"), ("b", "8.0"), ("c", "7.0"), ("b", "2.0")}
    assert rows(I.other_years(year(old), year(new), "y"), "k", "v") == {("a", "1.0"), ("b", "2.0"), ("c", "7.0")}
    assert rows(I.complete_months(new, "t"), "k") == {("a",), ("c",)}


def test_years_are_made_once_and_steps_fail_alone(spark, tmp_path):
    made = []

    def rows(y):
        made.append(y)
        return spark.range(2).withColumn("year", F.lit(y)).withColumn("n", F.lit(len(made)))

    first = I.yearly(rows, [2001, 2002], f"{tmp_path}/y")
    assert first.count() == 4
    (tmp_path / "y/year=2002/_SUCCESS").unlink()
    again = {(r.year, r.n) for r in I.yearly(rows, [2001, 2002, 2003], f"{tmp_path}/y").collect()}
    assert again == {(2001, 1), (2002, 4), (2003, 5)}

    def broken():
        raise OSError("source")

    log, ok = I.in_steps({"a": lambda: None, "b": broken, "c": lambda: None}, {"a", "c"})
    assert [(x["step"], x["ok"]) for x in log] == [("a", True), ("b", False), ("c", True)] and ok and log[1]["error"] == "OSError: source"
    assert I.in_steps({"a": broken}, {"a"})[1] is False and I.in_steps({}, {"a"})[1] is False


def test_crosswalk_in_order(spark):
    from rainledger.operators.matching import crosswalk, fuzzy_match, nearest, with_codes

    master = spark.createDataFrame([("Goa", "North Goa", 1), ("Goa", "South Goa", 2), ("Bihar", "Purnia", 3), ("Bihar", "Saran", 4), ("Bihar", "Saran Dist.", 5)], "state string, district string, code long")
    names = spark.createDataFrame([("GOA", "NORTH GOA"), ("GOA", "NORTH GOA"), ("Bihar", "Purnea"), ("Bihar", "Saran"), ("Bihar", "Patna"), ("Kutch", "Bhuj"), ("GOA", "Panaji"), ("GOA", "New Place"), ("GOA", "Elsewhere"), ("GOA", "South-Goa"), (None, "x"), ("Bihar", None)], "state string, name string")
    aliases = spark.createDataFrame([("GOA", "Panaji", "north goa")], "state string, name string, target string")
    relations = spark.createDataFrame([("GOA", "New Place", "child_of", "South Goa"), ("GOA", "Elsewhere", "none", None), ("GOA", "South-Goa", "part_of", None)], "state string, name string, relation string, target string")
    walked = crosswalk(names, master, aliases, relations)
    got = {(r.state, r.name): (r.code, r.method, r.score, r.relation) for r in walked.collect()}
    assert got == {
        ("GOA", "NORTH GOA"): (1, "exact", 1.0, "one"), ("Bihar", "Purnea"): (None, "unmatched", None, "one"), ("Bihar", "Saran"): (None, "unmatched", None, "one"), ("Bihar", "Patna"): (None, "unmatched", None, "one"),
        ("Kutch", "Bhuj"): (None, "unmatched_state", None, "one"), ("GOA", "Panaji"): (1, "alias", None, "one"), ("GOA", "New Place"): (2, "not_on_map", None, "child_of"), ("GOA", "Elsewhere"): (None, "left_out", None, "none"), ("GOA", "South-Goa"): (2, "exact", 1.0, "part_of"),
    }
    assert {r.code: r.score for r in crosswalk(names.where("name = 'Purnea'"), master, aliases, relations, 0.8).collect()} == {3: 0.833}
    placed, lost = with_codes(names.withColumn("v", F.lit(1.0)), walked)
    assert {r.code for r in placed.collect()} == {1} and ("GOA", "South-Goa") in {tuple(r) for r in lost.collect()}
    import difflib

    dice = np.random.default_rng(3)
    words = sorted({"".join(dice.choice(list("abcde"), int(n))) for n in dice.integers(4, 12, 60)})
    others = sorted({w[:k] + w[k + 1 :] for w, k in zip(words, dice.integers(0, 4, len(words)))})
    as_frame = lambda x: spark.createDataFrame([("g", w) for w in x], "group string, name string")
    ratio = {o: [(w, difflib.SequenceMatcher(None, o, w).ratio()) for w in words] for o in others}
    want = {o: good[0] for o in others if len(good := [x for x in ratio[o] if x[1] >= 0.85]) == 1}
    assert {r.name: (r.match, r.ratio) for r in fuzzy_match(as_frame(others), as_frame(words)).collect()} == want and len(want) > 10
    scored = spark.createDataFrame([(1, 7, 0.1), (1, 8, 0.1), (2, 7, 0.05)], "l int, r int, s double")
    assert {tuple(x) for x in nearest(scored, "l", "r", "s").collect()} == {(1, 7, 0.1), (2, 7, 0.05)}
