import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rainledger.operators import borders as B
from rainledger.operators import coverage as C
from rainledger.plans import review
from rainledger.sources.shared import settled
from tests.core.test_coverage import area, inside, plain

RINGS = "area int, rings array<array<struct<x:double,y:double>>>"


def crosses(e, f):
    side = lambda a, b, p: (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])
    near = 1e-9
    s = [side(*e, f[0]), side(*e, f[1]), side(*f, e[0]), side(*f, e[1])]
    return s[0] * s[1] < -near and s[2] * s[3] < -near


def edges(rings):
    return [(a, b) for r in rings for a, b in zip(r, r[1:] + r[:1])]


SHAPES = {
    1: [[(0.0, 0.0), (2.0, 2.0), (2.0, 0.0), (0.0, 2.0)]],  # a bow tie
    2: [[(0.0, 0.0), (4.0, 0.0), (4.0, 0.0), (4.0, 4.0), (2.0, 4.0), (2.0, 6.0), (2.0, 4.0), (0.0, 4.0), (0.0, 0.0)]],  # corners said twice, a spike
    3: [[(0.0, 5.0), (3.0, -4.0), (-5.0, 2.0), (5.0, 2.0), (-3.0, -4.0)]],  # a star of five points, empty in the middle
    4: [[(0.0, 0.0), (6.0, 0.0), (6.0, 6.0), (0.0, 6.0)], [(1.0, 1.0), (1.0, 3.0), (3.0, 3.0), (3.0, 1.0)], [(3.0, 3.0), (5.0, 3.0), (5.0, 5.0), (3.0, 5.0)]],  # holes that touch
    5: [[(0.0, 0.0), (4.0, 0.0), (4.0, 2.0), (0.0, 2.0)], [(2.0, 0.0), (6.0, 0.0), (6.0, 2.0), (2.0, 2.0)]],  # parts that overlap, edges on each other
    6: [[(0.0, 0.0), (1.0, 0.0), (2.0, 0.0)]],  # no inside
}


def test_repairs(spark):
    dice = np.random.default_rng(8)
    shapes = dict(SHAPES)
    for k in range(20, 32):
        shapes[k] = [[(float(x), float(y)) for x, y in dice.uniform(-3, 3, (int(dice.integers(4, 14)), 2))]]
    got = {r.area: plain(r.rings) for r in B.repaired(spark.createDataFrame(list(shapes.items()), RINGS).repartition(3), 1.5).collect()}
    assert got.keys() == shapes.keys() - {6}
    assert sorted(len(r) for r in got[1]) == [3, 3] and sum(map(area, got[1])) == 2.0
    assert len(got[2]) == 1 and area(got[2][0]) == 16.0
    assert sum(map(area, got[5])) == 8.0
    for k, rings in got.items():
        for x, y in dice.uniform(-6, 6, (200, 2)):
            assert inside(rings, x, y) == inside(shapes[k], x, y), (k, x, y)
        es = edges(rings)
        assert not any(crosses(e, f) for i, e in enumerate(es) for f in es[:i])
        assert all(len(set(r)) == len(r) > 2 for r in rings)
    points = spark.createDataFrame([(k, v) for k, v in got.items()], RINGS).select("area", C.inner_point(F.col("rings")).alias("p"))
    assert all(inside(shapes[r.area], r.p.x, r.p.y) for r in points.collect())


def test_effective_areas():
    assert B.effective_areas([0, 1, 2], [0, 1, 0]) == [math.inf] * 3
    got = B.effective_areas([0.0, 1.0, 2.0, 3.0, 4.0], [0.0, 0.1, 0.0, 2.0, 0.0])
    assert got[0] == got[4] == got[3] == math.inf and got[1] < got[2] < 3
    dice = np.random.default_rng(1)
    xs, ys = dice.uniform(0, 1, (2, 40)).tolist()
    got = B.effective_areas(xs, ys)
    back = B.effective_areas(xs[::-1], ys[::-1])
    assert got == back[::-1]

    def brute():
        left, out, most = list(range(40)), {}, 0.0
        while len(left) > 3:
            size = {b: abs((xs[a] - xs[b]) * (ys[c] - ys[b]) - (xs[c] - xs[b]) * (ys[a] - ys[b])) / 2 for a, b, c in zip(left, left[1:], left[2:])}
            b = min(size, key=size.get)
            most = out[b] = max(most, size[b])
            left.remove(b)
        return out

    assert {i: w for i, w in enumerate(got) if w < math.inf} == pytest.approx(brute())


def country(n=6, fine=12):
    """A grid of areas with wavy common borders."""
    dice = np.random.default_rng(4)
    corner = {(i, j): (i + dice.uniform(-0.2, 0.2), j + dice.uniform(-0.2, 0.2)) for i in range(n + 1) for j in range(n + 1)}
    lines = {}

    def line(a, b):
        if (b, a) in lines:
            return lines[b, a][::-1]
        if (a, b) not in lines:
            (x, y), (u, v) = corner[a], corner[b]
            t = np.linspace(0, 1, fine)
            w = dice.normal(0, 0.03, (fine, 2)) * (t * (1 - t))[:, None] * 4
            pts = np.stack([x + t * (u - x), y + t * (v - y)], 1) + w
            lines[a, b] = [corner[a], *map(tuple, pts[1:-1].tolist()), corner[b]]
        return lines[a, b]

    out = []
    for i in range(n):
        for j in range(n):
            c = [(i, j), (i + 1, j), (i + 1, j + 1), (i, j + 1)]
            ring = [p for a, b in zip(c, c[1:] + c[:1]) for p in line(a, b)[:-1]]
            out.append((i * n + j, [ring[::-1] if (i + j) % 2 else ring]))
    angle = np.linspace(0, 2 * math.pi, 50, endpoint=False)
    out.append((900, [[(20 + math.cos(t), math.sin(t)) for t in angle.tolist()]]))  # an island
    return out


def borders_of(rows):
    return Counter(tuple(sorted(e)) for _, rings in rows for e in edges(rings))


def test_simplified_maps_have_no_gaps(spark):
    before = country()
    df = spark.createDataFrame(before, RINGS).repartition(4)
    text = lambda rows: sum(len(f"[{round(x, 4)},{round(y, 4)}],") for _, rings in rows for r in rings for x, y in r)
    full = text(before)
    kept = []
    for most in (full + 10_000, full * 2 // 3, full // 3, 10):
        after = [(r.area, plain(r.rings)) for r in B.simplified(df, most).collect()]
        assert {k for k, _ in after} == {k for k, _ in before} and all(len(r) > 2 for _, rings in after for r in rings)
        if most > 10:
            assert text(after) <= most
        kept.append(sum(len(r) for _, rings in after for r in rings))
        # inner borders stand twice, those of the whole once, as before
        once = [e for e, n in borders_of(after).items() if n == 1]
        assert set(borders_of(after).values()) == {1, 2}
        outer = {p for e, n in borders_of(before).items() if n == 1 for p in e}
        assert all(p in outer for e in once for p in e)
    assert kept[0] == sum(len(r) for _, rings in before for r in rings) and kept == sorted(kept, reverse=True) and kept[3] < kept[2]
    assert full * 2 // 3 * 0.9 < text([(r.area, plain(r.rings)) for r in B.simplified(df, full * 2 // 3).collect()])  # and no more goes than must
    assert B.simplified(df.limit(0), 100).collect() == []


def test_unions_are_made_once(spark, monkeypatch, tmp_path):
    """What is asked of the unions before they are simplified doesn't chain their rings again."""
    names = []
    monkeypatch.setattr(review, "settled", lambda df, name: names.append(name) or settled(df, name))
    spark.createDataFrame([(k, k % 3) for k in range(40)], "c_custkey long, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    got = review.simplified_borders(spark, str(tmp_path))
    assert names == ["unions"] and {r.nation for r in got.collect()} == {0, 1, 2}
