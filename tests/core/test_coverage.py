import numpy as np
import pytest
from pyspark.sql import functions as F

from rainledger.operators import coverage as C
from rainledger.operators import geometry as G

RINGS = "area int, g string, rings array<array<struct<x:double,y:double>>>"


def square(x, y, s=1.0, back=False):
    ring = [(x, y), (x + s, y), (x + s, y + s), (x, y + s)]
    return ring[::-1] if back else ring


def inside(rings, x, y):
    n = 0
    for ring in rings:
        for (a, b), (c, d) in zip(ring, ring[1:] + ring[:1]):
            n += (b > y) != (d > y) and x < (c - a) * (y - b) / (d - b) + a
    return n % 2 == 1


def plain(rings):
    return [[(p.x, p.y) for p in r] for r in rings]


def area(ring):
    return sum(a * d - c * b for (a, b), (c, d) in zip(ring, ring[1:] + ring[:1])) / 2


def test_unions_against_brute_force(spark):
    dice = np.random.default_rng(3)
    cells = [(k, f"g{dice.integers(0, 3)}", [square(float(k % 12), float(k // 12), back=bool(k % 2))]) for k in range(144) if dice.random() < 0.9]
    cells.append((999, "ring", [square(20.0, 0.0, 5.0), square(21.0, 1.0, 3.0, back=True)]))  # with a hole
    cells.append((998, "ring", [square(22.0, 2.0)]))  # an island in the hole
    cells.append((997, "closed", [square(40.0, 0.0) + [(40.0, 0.0)]]))  # a ring that says its first corner twice
    got = {r.area: plain(r.rings) for r in C.dissolved(spark.createDataFrame(cells, RINGS).repartition(5), "g").collect()}
    assert got.keys() == {c[1] for c in cells}
    for g, rings in got.items():
        own = [c[2] for c in cells if c[1] == g]
        assert sum(map(area, rings)) == pytest.approx(sum(sum(abs(area(r)) * (1 if i == 0 else -1) for i, r in enumerate(p)) for p in own))
        assert area(rings[0]) == max(map(area, rings))
        for ring in rings:
            assert len(set(ring)) == len(ring)  # no ring meets itself here
        for x, y in dice.uniform(-1, 26, (300, 2)):
            assert inside(rings, x, y) == any(inside(p, x, y) for p in own)


def test_touching_corners_stay_apart(spark):
    got = C.dissolved(spark.createDataFrame([(1, "a", [square(0.0, 0.0)]), (2, "a", [square(1.0, 1.0)])], RINGS), "g").first()
    assert sorted(len(r) for r in got.rings) == [4, 4]
    assert C.dissolved(spark.createDataFrame([], RINGS), "g").collect() == []
    assert C.dissolved(spark.createDataFrame([(1, "a", [square(0.0, 0.0)]), (2, "a", [square(1.0, 0.0, 1.0, True)]), (3, None, [square(5.0, 5.0)])], RINGS), "g").where("area = 'a'").first().rings[0].__len__() == 6


def test_long_ring(spark):
    n = 500
    strip = [(k, "s", [square(float(k), 0.0)]) for k in range(n)]
    got = C.dissolved(spark.createDataFrame(strip, RINGS), "g").first()
    assert len(got.rings) == 1 and len(got.rings[0]) == 2 * n + 2


def test_inner_points_are_inside(spark):
    dice = np.random.default_rng(5)
    shapes = []
    for k in range(60):
        n = int(dice.integers(3, 25))
        turn, far = np.sort(dice.uniform(0, 2 * np.pi, n)), dice.uniform(0.05, 2, n)
        ring = [(float(f * np.cos(t)), float(f * np.sin(t))) for t, f in zip(turn, far)]
        shapes.append((k, "x", [ring]))
    shapes.append((100, "x", [square(0.0, 0.0, 4.0), square(0.5, 0.5, 3.0, back=True)]))
    shapes.append((101, "x", [[(0.0, 0.0), (4.0, 0.0), (4.0, 3.0), (3.0, 3.0), (3.0, 1.0), (1.0, 1.0), (1.0, 3.0), (0.0, 3.0)]]))  # a U
    df = spark.createDataFrame(shapes, RINGS)
    points = df.select("area", C.inner_point(F.col("rings")).alias("p")).select(F.col("area").alias("own"), "p.x", "p.y").collect()
    rings = {k: r for k, _, r in shapes}
    ok = [inside(rings[p.own], p.x, p.y) for p in points]
    assert all(ok) and len(ok) == len(shapes)
    alone = df.where("area = 101")
    at = alone.select(C.inner_point(F.col("rings")).alias("p")).select("p.x", "p.y")
    assert G.point_in_polygon(at, alone.select("area", "rings")).first().area == 101
    assert spark.createDataFrame([(1, "x", []), (2, "x", None)], RINGS).select(C.inner_point(F.col("rings")).alias("p")).where("p IS NOT NULL").count() == 0


def test_small_areas_are_chained_without_joins(spark, monkeypatch):
    dice = np.random.default_rng(9)
    cells = [(k, f"g{dice.integers(0, 4)}", [square(float(k % 10), float(k // 10))]) for k in range(100)]
    df = spark.createDataFrame(cells, RINGS).repartition(3)
    turned = lambda r: min(r[k:] + r[:k] for k in range(len(r)))
    found = lambda: {r.area: sorted(turned(ring) for ring in plain(r.rings)) for r in C.dissolved(df, "g").collect()}
    monkeypatch.setattr(C, "IN_A_ROW", 0)
    by_joins = found()
    monkeypatch.setattr(C, "IN_A_ROW", 100)  # some are larger
    assert found() == by_joins
    monkeypatch.undo()
    monkeypatch.setattr(C, "followed", lambda *_: pytest.fail("joined"))
    assert found() == by_joins
