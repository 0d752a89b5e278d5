"""Repair of polygons that cross themselves, and simplification that keeps common borders common.

Both work on rows of edges or corners and put rings together again by
`coverage`; a ring's corners are one value and are handled in one task.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rainledger.operators.coverage import chained
from rainledger.operators.geometry import edges_of
from rainledger.sources.shared import settled


def _cells(low: Column, high: Column, cell: float) -> Column:
    return F.explode(F.sequence(F.floor(low / cell), F.floor(high / cell)))


def _split(edges: DataFrame, cell: float) -> DataFrame:
    """(area, k, x1, y1, x2, y2): the parts of edges between the points where others of their polygon meet them. Pairs of edges meet by cells of a grid."""
    low, high = (lambda a, b: F.least(a, b)), (lambda a, b: F.greatest(a, b))
    at = edges.withColumn("i", _cells(low("x1", "x2"), high("x1", "x2"), cell)).withColumn("j", _cells(low("y1", "y2"), high("y1", "y2"), cell))
    other = at.select("area", "i", "j", F.col("k").alias("l"), *[F.col(c).alias(c.replace("x", "u").replace("y", "v")) for c in ("x1", "y1", "x2", "y2")])
    pairs = at.join(other, ["area", "i", "j"]).where("k < l")
    # a pair that shares several cells counts in the first of them
    pairs = pairs.where((F.col("i") == F.floor(high(low("x1", "x2"), low("u1", "u2")) / cell)) & (F.col("j") == F.floor(high(low("y1", "y2"), low("v1", "v2")) / cell)))
    side = lambda a, b, p: (F.col(f"{b[0]}{b[1]}") - F.col(f"{a[0]}{a[1]}")) * (F.col(f"{p[2]}{p[1]}") - F.col(f"{a[2]}{a[1]}")) - (F.col(f"{b[2]}{b[1]}") - F.col(f"{a[2]}{a[1]}")) * (F.col(f"{p[0]}{p[1]}") - F.col(f"{a[0]}{a[1]}"))
    a1, a2, b1, b2 = ("x", 1, "y"), ("x", 2, "y"), ("u", 1, "v"), ("u", 2, "v")
    s = {"b1": side(a1, a2, b1), "b2": side(a1, a2, b2), "a1": side(b1, b2, a1), "a2": side(b1, b2, a2)}
    t = s["a1"] / (s["a1"] - s["a2"])
    point = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    crossing = F.when((s["a1"] * s["a2"] < 0) & (s["b1"] * s["b2"] < 0), point(F.col("x1") + t * (F.col("x2") - F.col("x1")), F.col("y1") + t * (F.col("y2") - F.col("y1"))))
    within = lambda p, q, x: F.col(x).between(F.least(p, q), F.greatest(p, q))
    on_a = [F.when((s[f"b{e}"] == 0) & within("x1", "x2", f"u{e}") & within("y1", "y2", f"v{e}"), point(F.col(f"u{e}"), F.col(f"v{e}"))) for e in (1, 2)]
    on_b = [F.when((s[f"a{e}"] == 0) & within("u1", "u2", f"x{e}") & within("v1", "v2", f"y{e}"), point(F.col(f"x{e}"), F.col(f"y{e}"))) for e in (1, 2)]
    told = F.explode(F.array(F.struct(F.col("k").alias("k"), F.array_compact(F.array(crossing, *on_a)).alias("p")), F.struct(F.col("l").alias("k"), F.array_compact(F.array(crossing, *on_b)).alias("p"))))
    met = pairs.select("area", told.alias("m")).select("area", "m.k", F.explode("m.p").alias("p")).groupBy("area", "k").agg(F.collect_set("p").alias("p"))
    all_ = edges.join(met, ["area", "k"], "left")
    ends = F.array(point(F.col("x1"), F.col("y1")), point(F.col("x2"), F.col("y2")))
    along = lambda p: (p["x"] - F.col("x1")) * (F.col("x2") - F.col("x1")) + (p["y"] - F.col("y1")) * (F.col("y2") - F.col("y1"))
    corners = F.array_sort(F.transform(F.array_union(ends, F.coalesce("p", F.array().cast("array<struct<x:double,y:double>>"))), lambda p: F.struct(along(p).alias("t"), p["x"].alias("x"), p["y"].alias("y"))))
    parts = all_.select("area", "k", corners.alias("c")).select("area", "k", F.explode(F.expr("transform(sequence(0, size(c) - 2), i -> struct(c[i].x AS x1, c[i].y AS y1, c[i + 1].x AS x2, c[i + 1].y AS y2))")).alias("e"))
    return parts.select("area", "k", "e.*").where("x1 <> x2 OR y1 <> y2")


def _faced(parts: DataFrame, edges: DataFrame, cell: float) -> DataFrame:
    """The parts with the inside on their left. What a line from a part's middle crosses on one side, of the edges but its own, tells which side that is; steep parts look to the right, others up."""
    p = parts.withColumn("mx", (F.col("a") + F.col("c")) / 2).withColumn("my", (F.col("b") + F.col("d")) / 2).withColumn("steep", F.abs(F.col("d") - F.col("b")) >= F.abs(F.col("c") - F.col("a")))
    found = []
    for steep in (True, False):
        u, v = ("x", "y") if steep else ("y", "x")
        e = edges.select("area", "k", F.col(f"{u}1").alias("u1"), F.col(f"{v}1").alias("v1"), F.col(f"{u}2").alias("u2"), F.col(f"{v}2").alias("v2")).withColumn("band", _cells(F.least("v1", "v2"), F.greatest("v1", "v2"), cell))
        own = p.where("steep" if steep else "NOT steep").withColumn("u", F.col("mx" if steep else "my")).withColumn("v", F.col("my" if steep else "mx")).withColumn("band", F.floor(F.col("v") / cell))
        j = own.join(e, ["area", "band"], "left")
        at = F.col("u1") + (F.col("v") - F.col("v1")) / F.nullif(F.col("v2") - F.col("v1"), F.lit(0.0)) * (F.col("u2") - F.col("u1"))
        beyond = ((F.col("v1") > F.col("v")) != (F.col("v2") > F.col("v"))) & (at > F.col("u")) & ~F.array_contains("own", F.col("k"))
        odd = j.groupBy("area", "a", "b", "c", "d").agg((F.count_if(beyond) % 2 == 1).alias("odd"))
        # inside to the right: down; inside above: to the right
        down = F.col("odd") == ((F.col("d") > F.col("b")) if steep else (F.col("c") < F.col("a")))
        pick = lambda x, y, down=down: F.when(down, F.col(x)).otherwise(F.col(y))
        found.append(odd.select("area", pick("c", "a").alias("x1"), pick("d", "b").alias("y1"), pick("a", "c").alias("x2"), pick("b", "d").alias("y2")))
    return found[0].unionByName(found[1])


def repaired(polygons: DataFrame, cell: float = 0.5) -> DataFrame:
    """(area, rings): the same insides by the even-odd rule, by rings that don't cross themselves or each other.

    Corners said twice, spikes and edges that stand twice go; a bow tie is two
    rings that touch. Outer rings go against the clock and holes with it.
    Polygons without an inside have no row. cell: side of the grid by which
    edges meet; each area is one row of polygons.
    """
    plain = F.transform("rings", lambda r: F.transform(r, lambda p: F.struct((p["x"] + 0.0).alias("x"), (p["y"] + 0.0).alias("y"))))
    edges = polygons.select("area", F.posexplode(edges_of(plain)).alias("k", "e")).select("area", "k", "e.*").where("x1 <> x2 OR y1 <> y2")
    edges = settled(edges, "edges")
    forth = F.struct("x1", "y1") < F.struct("x2", "y2")
    way = lambda p, q: F.when(forth, F.col(p)).otherwise(F.col(q))
    parts = _split(edges, cell).select("area", "k", way("x1", "x2").alias("a"), way("y1", "y2").alias("b"), way("x2", "x1").alias("c"), way("y2", "y1").alias("d"))
    once = parts.groupBy("area", "a", "b", "c", "d").agg(F.collect_set("k").alias("own"), F.count("*").alias("n")).where("n % 2 = 1")
    return chained(_faced(once, edges, cell), "area")


def effective_areas(xs: list[float], ys: list[float]) -> list[float]:
    """How much area each corner of a line stands for when those that stand for less are gone, rising as they go; the ends, and the last corner between them (two, if the ends are one), stand for all."""
    n = len(xs)
    out = [math.inf] * n
    keep = 2 if (xs[0], ys[0]) == (xs[-1], ys[-1]) else 1
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    size = lambda i: abs((xs[before[i]] - xs[i]) * (ys[after[i]] - ys[i]) - (xs[after[i]] - xs[i]) * (ys[before[i]] - ys[i])) / 2
    now = {i: size(i) for i in range(1, n - 1)}
    heap = [(now[i], xs[i], ys[i], i) for i in now]
    heapq.heapify(heap)
    most = 0.0
    while len(now) > keep:
        s, _, _, i = heapq.heappop(heap)
        if now.get(i) != s:
            continue
        most = out[i] = max(most, s)
        del now[i]
        p, q = before[i], after[i]
        after[p], before[q] = q, p
        for k in (p, q):
            if k in now:
                now[k] = size(k)
                heapq.heappush(heap, (now[k], xs[k], ys[k], k))
    return out


def ring_weights(ring: list[tuple[float, float, bool]]) -> list[tuple[float, float, float]]:
    """(x, y, weight) of a ring's corners (x, y, node). Between nodes a border is weighed in one direction only, so both of its sides weigh it alike; a ring without nodes starts at its lowest corner."""
    nodes = [i for i, c in enumerate(ring) if c[2]]
    start = nodes[0] if nodes else min(range(len(ring)), key=lambda i: ring[i][:2])
    turned = ring[start:] + ring[: start + 1]
    out, first = [], 0
    for i in range(1, len(turned)):
        if turned[i][2] or i == len(turned) - 1:
            line = [c[:2] for c in turned[first : i + 1]]
            back = line[::-1] < line
            line = line[::-1] if back else line
            weights = effective_areas([x for x, _ in line], [y for _, y in line])
            own = [(x, y, w) for (x, y), w in zip(line, weights, strict=True)]
            out += (own[::-1] if back else own)[:-1]
            first = i
    return out


def weighed(polygons: DataFrame) -> DataFrame:
    """(area, turn, at, x, y, weight): each corner of each ring with the area that it stands for. Corners where borders part have an infinite one."""
    rows = polygons.select("area", F.posexplode("rings").alias("turn", "ring"))
    rows = rows.withColumn("ring", F.when((F.size("ring") > 1) & (F.get("ring", F.lit(0)) == F.element_at("ring", -1)), F.expr("slice(ring, 1, size(ring) - 1)")).otherwise(F.col("ring"))).where(F.size("ring") > 2)
    around = F.expr("transform(ring, (p, i) -> struct(p.x AS x, p.y AS y, ring[(i + size(ring) - 1) % size(ring)] AS p, ring[(i + 1) % size(ring)] AS q))")
    corners = rows.select("area", "turn", F.posexplode(around).alias("at", "c")).select("area", "turn", "at", "c.x", "c.y", F.least("c.p", "c.q").alias("p"), F.greatest("c.p", "c.q").alias("q"))
    nodes = corners.groupBy("x", "y").agg((F.countDistinct("p", "q") > 1).alias("node"))
    whole = corners.join(nodes, ["x", "y"]).groupBy("area", "turn").agg(F.array_sort(F.collect_list(F.struct("at", "x", "y", "node"))).alias("ring"))
    kind = polygons.schema["area"].dataType.simpleString()

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rings, rows, ats, own, first = batch.column("ring"), [], [], [], 0
            _, xs, ys, nodes = (c.to_pylist() for c in rings.flatten().flatten())
            for k, n in enumerate(rings.value_lengths().to_pylist()):
                found = ring_weights(list(zip(xs[first : first + n], ys[first : first + n], nodes[first : first + n], strict=True)))
                rows += [k] * len(found)
                ats += range(len(found))
                own += found
                first += n
            if own:
                corners = [pa.array(c, pa.float64()) for c in zip(*own, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("area").take(pa.array(rows)), batch.column("turn").take(pa.array(rows)), pa.array(ats, pa.int32()), *corners], ["area", "turn", "at", "x", "y", "weight"])

    return whole.mapInArrow(weigh, f"area {kind}, turn int, at int, x double, y double, weight double")


def tolerance(corners: DataFrame, most: int, decimals: int = 4, steps: int = 64) -> float:
    """The lowest weight at which the corners' text, as [x,y], with so many decimals, is within `most` bytes; by a histogram of `steps` bins for each factor of two, so a few thousand rows reach the driver. Infinite ones always stay."""
    text = F.concat(F.lit("["), F.round("x", decimals).cast("string"), F.lit(","), F.round("y", decimals).cast("string"), F.lit("],"))
    bin_ = F.when((F.col("weight") > 0) & (F.col("weight") < math.inf), F.ceil(F.log2("weight") * steps))
    fixed = F.col("weight") == math.inf
    rows = corners.groupBy(fixed.alias("fixed"), bin_.alias("bin")).agg(F.sum(F.length(text)).alias("bytes")).collect()
    total, low = sum(r["bytes"] for r in rows if r["fixed"]), math.inf
    for r in sorted((r for r in rows if not r["fixed"]), key=lambda r: -(r["bin"] if r["bin"] is not None else -math.inf)):
        total += r["bytes"]
        if total > most:
            break
        low = 0.0 if r["bin"] is None else math.nextafter(2.0 ** ((r["bin"] - 1) / steps), math.inf)
    return low


def simplified(polygons: DataFrame, most: int, decimals: int = 4) -> DataFrame:
    """(area, rings): the polygons with the corners that stand for the least area left out, until the text of the others is within `most` bytes.

    One tolerance holds for all, and a border that two polygons share loses the
    same corners on both sides, so no gaps open. Each border keeps a corner
    between its ends, so no ring collapses, even if the bound can't be met then.
    Borders of different polygons are shared where their corners are the same.
    """
    corners = settled(weighed(polygons), "corners")
    low = tolerance(corners, most, decimals)
    rings = corners.where((F.col("weight") == math.inf) | (F.col("weight") >= low)).groupBy("area", "turn").agg(F.array_sort(F.collect_list(F.struct("at", "x", "y"))).alias("r"))
    return rings.groupBy("area").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "r"))), lambda t: F.transform(t["r"], lambda c: F.struct(c["x"].alias("x"), c["y"].alias("y")))).alias("rings"))
