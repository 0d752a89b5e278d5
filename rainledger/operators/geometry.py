"""Points in polygons and polygons over grids, without a geometry library.

A polygon is a row (area, rings): arrays of (x, y) points, closed or not; a ring
inside another is a hole. Joins go by cells of a regular grid, so no point
meets all polygons, and a large polygon is dealt over many rows of the grid.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The ellipsoid's half axis in metres and its eccentricity squared; the projection's two standard parallels, origin and central meridian.
AXIS_M, ECC2 = 6_378_137.0, 0.00669437999014
PARALLELS, ORIGIN = (12.0, 28.0), (20.0, 78.0)


def edges_of(rings: Column) -> Column:
    """The edges (x1, y1, x2, y2) of all rings, each ring closed."""

    def of(ring: Column) -> Column:
        after = F.concat(F.slice(ring, F.lit(2), F.size(ring) - 1), F.slice(ring, 1, 1))
        return F.zip_with(ring, after, lambda a, b: F.struct(a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")))

    return F.flatten(F.transform(F.filter(rings, lambda r: F.size(r) > 2), of))


def crossings(edges: Column, x: Column, y: Column) -> Column:
    """How many edges a ray from a point to the right crosses."""
    return F.size(F.filter(edges, lambda e: ((e["y1"] > y) != (e["y2"] > y)) & (x < (e["x2"] - e["x1"]) * (y - e["y1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0)) + e["x1"])))


def _cell(v: Column, size: float) -> Column:
    return F.floor(v / size)


def in_cells(polygons: DataFrame, cell: float) -> DataFrame:
    """(area, i, j, edges): the cells of each polygon's box, each with the edges that a ray from it may cross."""
    e = polygons.select("area", edges_of(F.col("rings")).alias("edges")).where(F.size("edges") > 0)
    low = lambda a, b: F.array_min(F.transform("edges", lambda e: F.least(e[a], e[b])))
    high = lambda a, b: F.array_max(F.transform("edges", lambda e: F.greatest(e[a], e[b])))
    rows = e.select("area", "edges", _cell(low("x1", "x2"), cell).alias("i0"), _cell(high("x1", "x2"), cell).alias("i1"), F.explode(F.sequence(_cell(low("y1", "y2"), cell), _cell(high("y1", "y2"), cell))).alias("j"))
    band = F.filter("edges", lambda e: (F.greatest(e["y1"], e["y2"]) >= F.col("j") * cell) & (F.least(e["y1"], e["y2"]) <= (F.col("j") + 1) * cell))
    rows = rows.select("area", "i0", "i1", "j", band.alias("edges")).where(F.size("edges") > 0)
    cells = rows.select("area", "j", "edges", F.explode(F.sequence("i0", "i1")).alias("i"))
    right = F.filter("edges", lambda e: F.greatest(e["x1"], e["x2"]) >= F.col("i") * cell)
    return cells.select("area", "i", "j", right.alias("edges")).where(F.size("edges") > 0)


def point_in_polygon(points: DataFrame, polygons: DataFrame, cell: float = 0.5) -> DataFrame:
    """points (x, y and other columns) with area: the smallest area whose polygon holds them, null where none does.

    A point on an edge to the right or above counts as outside, as ray casting
    has it. Points without a place have no area. Each point meets one row, what
    all polygons have in its cell, so rows of points stay as they are, repeated
    ones too, and nothing depends on an id that a lost task would make anew.
    """
    held = in_cells(polygons, cell).groupBy(F.col("i").alias("_i"), F.col("j").alias("_j")).agg(F.collect_list(F.struct("area", "edges")).alias("_held"))
    at = points.withColumn("_i", _cell(F.col("x"), cell)).withColumn("_j", _cell(F.col("y"), cell))
    around = F.filter("_held", lambda p: crossings(p["edges"], F.col("x"), F.col("y")) % 2 == 1)
    return at.join(held, ["_i", "_j"], "left").withColumn("area", F.array_min(F.transform(around, lambda p: p["area"]))).drop("_i", "_j", "_held")


def equal_area(lon: np.ndarray, lat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Albers' conic projection of degrees, in metres; areas are true."""
    e = math.sqrt(ECC2)

    def q(phi):
        s = np.sin(phi)
        return (1 - ECC2) * (s / (1 - ECC2 * s * s) - np.log((1 - e * s) / (1 + e * s)) / (2 * e))

    m = lambda phi: np.cos(phi) / np.sqrt(1 - ECC2 * np.sin(phi) ** 2)
    one, two = (math.radians(p) for p in PARALLELS)
    phi0, lam0 = (math.radians(v) for v in ORIGIN)
    n = (m(one) ** 2 - m(two) ** 2) / (q(two) - q(one))
    c = m(one) ** 2 + n * q(one)
    rho = AXIS_M * np.sqrt(c - n * q(np.radians(lat))) / n
    theta = n * (np.radians(lon) - lam0)
    return rho * np.sin(theta), AXIS_M * math.sqrt(c - n * q(phi0)) / n - rho * np.cos(theta)


def shoelace(x: np.ndarray, y: np.ndarray) -> float:
    """Area of a ring, positive where it goes against the clock."""
    return float((x * np.roll(y, -1) - np.roll(x, -1) * y).sum() / 2)


def clipped(points: np.ndarray, box: np.ndarray) -> np.ndarray:
    """A ring cut to a convex one that goes against the clock, side by side; what is joined along a side has no area."""
    for a, b in zip(box, np.roll(box, -1, axis=0)):
        if not len(points):
            return points
        left = (b[0] - a[0]) * (points[:, 1] - a[1]) - (b[1] - a[1]) * (points[:, 0] - a[0])
        after, beyond = np.roll(points, -1, axis=0), np.roll(left, -1)
        share = np.divide(left, left - beyond, out=np.zeros_like(left), where=left != beyond)[:, None]
        cut = points + share * (after - points)
        both = np.stack([points, cut], axis=1).reshape(-1, 2)
        points = both[np.stack([left >= 0, (left >= 0) != (beyond >= 0)], axis=1).reshape(-1)]
    return points


def cell_areas(polygons: DataFrame, step: float, least_km2: float = 0.01) -> DataFrame:
    """(cell_x, cell_y, area, km2): how much of each grid cell (of `step` degrees, around multiples of it) each polygon covers; slivers go.

    Corners are projected, sides are straight there. A ring's sign is that of
    its nesting: the first one counts, later ones that go the other way are
    holes.
    """
    ring = F.posexplode("rings")
    rows = polygons.select("area", ring.alias("turn", "ring")).where(F.size("ring") > 2)
    of = lambda v, f: F.expr(f"{f}(transform(ring, p -> p.{v}))")
    side = lambda v: F.sequence(F.floor(of(v, "array_min") / step + 0.5), F.floor(of(v, "array_max") / step + 0.5))
    rows = rows.select("area", "ring", F.explode(side("x")).alias("i")).select("area", "ring", "i", F.explode(side("y")).alias("j"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for ring_, i, j in zip(batch["ring"], batch["i"], batch["j"]):
                corner = np.array([(-0.5, -0.5), (0.5, -0.5), (0.5, 0.5), (-0.5, 0.5)]) * step + np.array([i * step, j * step])
                box = np.stack(equal_area(corner[:, 0], corner[:, 1]), axis=1)
                line = np.array([(p["x"], p["y"]) for p in ring_])
                part = clipped(np.stack(equal_area(line[:, 0], line[:, 1]), axis=1), box)
                found.append(shoelace(part[:, 0], part[:, 1]) / 1e6 if len(part) > 2 else 0.0)
            yield pd.DataFrame({"area": batch["area"], "i": batch["i"], "j": batch["j"], "signed": found})

    kind = polygons.schema["area"].dataType.simpleString()
    parts = rows.mapInPandas(cut, f"area {kind}, i long, j long, signed double")
    return parts.groupBy("area", "i", "j").agg(F.abs(F.sum("signed")).alias("km2")).where(F.col("km2") > least_km2).select((F.col("i") * step).alias("cell_x"), (F.col("j") * step).alias("cell_y"), "area", "km2")


def polygon_areas(polygons: DataFrame) -> DataFrame:
    """(area, km2) of whole polygons; holes go the other way round."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lines = [np.array([(p["x"], p["y"]) for p in r]) for r in batch["ring"]]
            yield pd.DataFrame({"area": batch["area"], "signed": [shoelace(*equal_area(x[:, 0], x[:, 1])) / 1e6 for x in lines]})

    kind = polygons.schema["area"].dataType.simpleString()
    rings = polygons.select("area", F.explode("rings").alias("ring")).where(F.size("ring") > 2)
    return rings.mapInPandas(of, f"area {kind}, signed double").groupBy("area").agg(F.abs(F.sum("signed")).alias("km2"))
