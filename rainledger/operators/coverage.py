"""Polygons that share borders: unions by cancelling edges, and points inside.

A polygon is a row (area, rings), as in `geometry`. Borders are rows of directed
edges with the inside on their left, so what two members of a union share stands
there twice, once each way, and cancels. Rings are chained by joins on end
points; only a finished ring, one value of the result, is in one task. The few
edges of a small area are one row.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rainledger.operators.geometry import edges_of
from rainledger.sources.shared import settled

RING = "array<struct<x:double,y:double>>"


def signed_area(ring: Column) -> Column:
    """Area of a ring in the plane, positive where it goes against the clock."""
    after = F.concat(F.slice(ring, F.lit(2), F.size(ring) - 1), F.slice(ring, 1, 1))
    parts = F.zip_with(ring, after, lambda a, b: (a["x"] * b["y"] - b["x"] * a["y"]) / 2)
    return F.aggregate(parts, F.lit(0.0), lambda s, x: s + x)


def facing(rings: Column) -> Column:
    """The rings with the inside on the left: outer ones against the clock, holes with it. The first ring is an outer one; holes go the other way round than it."""
    turned = F.transform(rings, lambda r: F.reverse(r))
    return F.when(signed_area(F.get(rings, F.lit(0))) < 0, turned).otherwise(rings)


def borders(polygons: DataFrame, of: str) -> DataFrame:
    """(of, x1, y1, x2, y2): the edges of the union of each value's polygons, the inside on their left. Members may touch but not overlap, and share their corners along common borders."""
    plain = F.transform("rings", lambda r: F.transform(r, lambda p: F.struct((p["x"] + 0.0).alias("x"), (p["y"] + 0.0).alias("y"))))  # no -0.0
    e = polygons.select(of, F.explode(edges_of(facing(plain))).alias("e")).select(of, "e.*").where("x1 <> x2 OR y1 <> y2")
    forth = F.struct("x1", "y1") < F.struct("x2", "y2")
    low = lambda a, b: F.when(forth, F.col(a)).otherwise(F.col(b))
    both = e.select(of, low("x1", "x2").alias("a"), low("y1", "y2").alias("b"), low("x2", "x1").alias("c"), low("y2", "y1").alias("d"), F.when(forth, 1).otherwise(-1).alias("way"))
    left = both.groupBy(of, "a", "b", "c", "d").agg(F.sum("way").alias("way")).where("way <> 0")
    end = lambda p, q: F.when(F.col("way") > 0, F.col(p)).otherwise(F.col(q))
    return left.select(of, end("a", "c").alias("x1"), end("b", "d").alias("y1"), end("c", "a").alias("x2"), end("d", "b").alias("y2"))


def followed(edges: DataFrame, of: str) -> DataFrame:
    """Adds next: the edge that goes on from each one's end; where rings touch, the leftmost, which keeps them apart. edges: with id."""
    n = edges.select(of, F.col("id").alias("next"), F.col("x1").alias("x2"), F.col("y1").alias("y2"), F.col("x2").alias("x3"), F.col("y2").alias("y3"))
    ax, ay = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    bx, by = F.col("x3") - F.col("x2"), F.col("y3") - F.col("y2")
    turn = F.atan2(ax * by - ay * bx, ax * bx + ay * by)
    own = edges.join(n, [of, "x2", "y2"])
    best = own.groupBy("id").agg(F.max_by("next", F.struct(turn, F.col("next"))).alias("next"))
    return edges.join(best, "id")


def cycles_of(links: DataFrame) -> DataFrame:
    """(id, ring): the smallest id of the cycle that each id is in, by next; each round doubles how far an id has seen, so there are as many as the logarithm of the longest cycle."""
    state = settled(links.select("id", "next", F.col("id").alias("ring")), "cycles")
    while True:
        far = state.select(F.col("id").alias("next"), F.col("next").alias("next2"), F.col("ring").alias("ring2"))
        state = settled(state.join(far, "next").select("id", F.col("next2").alias("next"), F.least("ring", "ring2").alias("ring"), (F.col("ring2") < F.col("ring")).alias("moved")), "cycles")
        if not state.where("moved").head(1):
            return state.select("id", "ring")
        state = state.drop("moved")


#: Areas of at most so many edges are chained in their own rows, larger ones by joins.
IN_A_ROW = 256


def simple_rings(at: int, by: dict[int, tuple[int, tuple[float, float]]]) -> list[list[tuple[float, float]]]:
    """The rings on a closed walk over edges (id: next, corner), from one of them; where the walk meets itself in a corner, a part ends."""
    out, line, seen = [], [], {}
    for _ in range(len(by) + 1):
        to, here = by[at]
        if here in seen:  # a loop is closed: the whole ring, or a part that touches it in this corner
            first = seen[here]
            out.append(line[first:])
            for corner in line[first + 1 :]:
                del seen[corner]
            line = line[: first + 1]
        else:
            seen[here] = len(line)
            line.append(here)
        at = to
    return out


def ring_column(lines: list[list[tuple[float, float]]]) -> pa.Array:
    """Rings as a column of lists of corners."""
    points = [[p[k] for line in lines for p in line] for k in (0, 1)]
    corners = pa.StructArray.from_arrays([pa.array(v, pa.float64()) for v in points], ["x", "y"])
    return pa.ListArray.from_arrays(pa.array([0, *accumulate(map(len, lines))], pa.int32()), corners)


def rings_of(edges: list[tuple[float, float, float, float]]) -> list[list[tuple[float, float]]]:
    """The rings of one area's edges: `followed` and the walks along it."""
    leaving: dict[tuple[float, float], list[int]] = {}
    for k, e in enumerate(edges):
        leaving.setdefault(e[:2], []).append(k)

    def turn(k: int, to: int) -> tuple[float, int]:
        ax, ay = edges[k][2] - edges[k][0], edges[k][3] - edges[k][1]
        bx, by = edges[to][2] - edges[to][0], edges[to][3] - edges[to][1]
        return math.atan2(ax * by - ay * bx, ax * bx + ay * by), to

    out, left = [], {k: (max(leaving[e[2:]], key=lambda to: turn(k, to)), e[:2]) for k, e in enumerate(edges)}
    while left:
        at = start = next(iter(left))
        ring = {}
        while at not in ring:
            ring[at] = left.pop(at)
            at = ring[at][0]
        out += simple_rings(start, ring)
    return out


def chained(edges: DataFrame, of: str) -> DataFrame:
    """(area, rings) of directed edges (of, x1, y1, x2, y2) that close: outer rings first, the largest before others. Small areas meet their edges once, in rows of their own."""
    edges = settled(edges.where(F.col(of).isNotNull()), "borders")
    large = settled(edges.groupBy(of).count().where(F.col("count") > IN_A_ROW).select(of), "large")
    if not large.head(1):
        return _chained_in_rows(edges, of)
    return _chained_in_rows(edges.join(large, of, "left_anti"), of).unionByName(_chained_by_joins(edges.join(large, of, "left_semi"), of))


def _chained_in_rows(edges: DataFrame, of: str) -> DataFrame:
    kind = edges.schema[of].dataType.simpleString()

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = [rings_of(sorted(tuple(e.values()) for e in parts.as_py())) for parts in batch.column("parts")]
            rings = pa.ListArray.from_arrays(pa.array([0, *accumulate(map(len, lines))], pa.int32()), ring_column([line for own in lines for line in own]))
            yield pa.RecordBatch.from_arrays([batch.column("area"), rings], ["area", "lines"])

    whole = edges.groupBy(F.col(of).alias("area")).agg(F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("parts")).mapInArrow(chain, f"area {kind}, lines array<{RING}>")
    sized = F.transform("lines", lambda line: F.struct((-signed_area(line)).alias("s"), line.alias("line")))
    return whole.select("area", F.transform(F.sort_array(sized), lambda r: r["line"]).alias("rings"))


def _chained_by_joins(edges: DataFrame, of: str) -> DataFrame:
    ided = settled(edges.withColumn("id", F.monotonically_increasing_id()), "edges")
    links = settled(followed(ided, of), "links")
    whole = links.join(cycles_of(links), "id").select(of, "ring", "id", "next", "x1", "y1")
    kind = edges.schema[of].dataType.simpleString()

    def ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, whose, first = [], [], 0
            parts = batch.column("parts")
            ids, after, xs, ys = (c.to_pylist() for c in parts.flatten().flatten())
            for row, (ring, n) in enumerate(zip(batch.column("ring").to_pylist(), parts.value_lengths().to_pylist(), strict=True)):
                own = slice(first, first + n)
                found = simple_rings(ring, dict(zip(ids[own], zip(after[own], zip(xs[own], ys[own])), strict=True)))
                out += found
                whose += [row] * len(found)
                first += n
            yield pa.RecordBatch.from_arrays([batch.column(of).take(pa.array(whose, pa.int64())), ring_column(out)], [of, "line"])

    rings = whole.groupBy(of, "ring").agg(F.collect_list(F.struct("id", "next", "x1", "y1")).alias("parts")).mapInArrow(ordered, f"{of} {kind}, line {RING}")
    sized = rings.select(of, F.struct((-signed_area(F.col("line"))).alias("s"), "line").alias("r"))
    return sized.groupBy(F.col(of).alias("area")).agg(F.transform(F.sort_array(F.collect_list("r")), lambda r: r["line"]).alias("rings"))


def dissolved(polygons: DataFrame, of: str) -> DataFrame:
    """(area, rings) of the union of each value's polygons; holes stay, and rings that touch in a corner, each other or themselves, are apart. polygons: (of, rings). Without polygons there are no rows."""
    return chained(borders(polygons, of), of)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is worked out once, however often body has it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def inner_point(rings: Column) -> Column:
    """A point inside: the middle of the widest part that the polygon has on a line halfway up, between two heights of corners; null for an empty one."""

    def height(heights: Column) -> Column:
        middle = (F.array_min(heights) + F.array_max(heights)) / 2
        return (F.array_max(F.filter(heights, lambda h: h <= middle)) + F.array_min(F.filter(heights, lambda h: h > middle))) / 2

    def across(edges: Column, y: Column) -> Column:
        crossed = F.filter(edges, lambda e: (e["y1"] > y) != (e["y2"] > y))
        return F.array_sort(F.transform(crossed, lambda e: e["x1"] + (y - e["y1"]) / (e["y2"] - e["y1"]) * (e["x2"] - e["x1"])))

    def widest(xs: Column, y: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(0), F.floor(F.size(xs) / 2).cast("int") - 1), lambda i: F.struct((F.get(xs, 2 * i + 1) - F.get(xs, 2 * i)).alias("w"), (-F.get(xs, 2 * i)).alias("a"), ((F.get(xs, 2 * i + 1) + F.get(xs, 2 * i)) / 2).alias("x")))
        return F.when(F.size(xs) > 1, F.struct(F.array_max(parts)["x"].alias("x"), y.alias("y")))

    heights = F.array_sort(F.array_distinct(F.flatten(F.transform(rings, lambda r: F.transform(r, lambda p: p["y"])))))
    return _let(edges_of(rings), lambda edges: _let(_let(heights, height), lambda y: _let(across(edges, y), lambda xs: widest(xs, y))))
