"""Distances, cells and shapes, as columns."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from postmill.schema import EARTH_RADIUS_M

#: Cells of a geohash of 5 characters: 13 bits of longitude and 12 of latitude.
COLUMNS, ROWS = 8192, 4096


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Metres between two points on a sphere."""
    dlat, dlon = F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon / 2), 2)
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def cell_x(lon: Column) -> Column:
    return F.pmod(F.floor((lon + 180) / 360 * COLUMNS), F.lit(COLUMNS)).cast("int")


def cell_y(lat: Column) -> Column:
    return F.greatest(F.lit(0), F.least(F.lit(ROWS - 1), F.floor((lat + 90) / 180 * ROWS))).cast("int")


def around(x: Column, y: Column, steps: int = 1) -> Column:
    """The cell and its eight neighbours (with more steps to the east and west, more), as structs (cx, cy); columns wrap at the antimeridian, rows end at the poles."""
    cells = [F.struct(F.pmod(x + i, F.lit(COLUMNS)).cast("int").alias("cx"), (y + j).cast("int").alias("cy")) for i in range(-steps, steps + 1) for j in (-1, 0, 1)]
    return F.filter(F.array(*cells), lambda c: (c["cy"] >= 0) & (c["cy"] < ROWS))


EDGE = "struct<k:int,x1:double,y1:double,x2:double,y2:double>"


def latitude_bands(polygons: list[list[list[tuple[float, float]]]], in_band: int = 8) -> tuple[float, float, list[list[dict]]]:
    """The lowest latitude, the height of a band, and by band the edges that reach into it, with the number `k` of their polygon."""
    edges = []
    for k, rings in enumerate(polygons):
        for ring in rings:
            closed = ring if ring[0] == ring[-1] else [*ring, ring[0]]
            edges += [{"k": k, "x1": float(x1), "y1": float(y1), "x2": float(x2), "y2": float(y2)} for (x1, y1), (x2, y2) in zip(closed, closed[1:])]
    low, high = min(min(e["y1"], e["y2"]) for e in edges), max(max(e["y1"], e["y2"]) for e in edges)
    bands: list[list[dict]] = [[] for _ in range(max(1, min(4096, len(edges) // in_band)))]
    height = (high - low) / len(bands) or 1.0
    place = lambda y: min(len(bands) - 1, int((y - low) / height))
    for e in edges:
        for band in range(max(0, place(min(e["y1"], e["y2"])) - 1), min(len(bands), place(max(e["y1"], e["y2"])) + 2)):
            bands[band].append(e)
    return low, height, bands


def in_polygons(lat: Column, lon: Column, polygons: list[list[list[tuple[float, float]]]]) -> Column:
    """Whether a point is inside any polygon (rings of (lon, lat), the first the shell, others holes); the border is outside.

    All edges are one constant of the plan, sorted into bands of latitude; a point looks at those of its own band.
    """
    if not polygons:
        return F.lit(False)
    low, height, bands = latitude_bands(polygons)
    xs = [x for rings in polygons for ring in rings for x, _ in ring]
    near = (lon > min(xs)) & (lon < max(xs)) & (lat > low) & (lat < low + height * len(bands))
    own = F.get(F.from_json(F.lit(json.dumps(bands)), f"array<array<{EDGE}>>"), F.least(F.lit(len(bands) - 1), F.floor((lat - low) / height).cast("int")))
    at = lambda e: (e["x2"] - e["x1"]) * (lat - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]
    crossed = lambda e: F.when((e["y1"] > lat) != (e["y2"] > lat), lon < at(e)).otherwise(False)
    turn = lambda e: (e["x2"] - e["x1"]) * (lat - e["y1"]) - (e["y2"] - e["y1"]) * (lon - e["x1"])
    between = lambda e: lon.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"])) & lat.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))
    numbers = lambda keep: F.transform(F.filter(own, keep), lambda e: e["k"])
    # An odd number of a polygon's edges lies east of what it holds.
    hits, borders = numbers(crossed), numbers(lambda e: (turn(e) == 0) & between(e))
    odd = F.struct(hits.alias("hits"), borders.alias("borders"))
    found = F.transform(F.array(odd), lambda s: F.exists(s["hits"], lambda k: (F.size(F.filter(s["hits"], lambda other: other == k)) % 2 == 1) & ~F.array_contains(s["borders"], k)))
    return F.coalesce(F.when(near, F.get(found, F.lit(0))), F.lit(False))


def centroid(points: Column) -> Column:
    """(lat, lon) of an ordered array of structs (lat, lon).

    One point stands for itself. Otherwise the points must form a closed ring of four or more and
    the area's centroid is taken, by sums relative to the first point; a ring without area has the
    centroid of its edges by length. Anything else gives null.
    """
    n, first = F.size(points), F.get(points, F.lit(0))
    last = F.element_at(points, -1)
    closed = (n >= 4) & (first["lat"] == last["lat"]) & (first["lon"] == last["lon"])
    edges = F.transform(
        F.sequence(F.lit(0), n - 2),
        lambda i: F.struct(
            (F.get(points, i)["lon"] - first["lon"]).alias("x1"), (F.get(points, i)["lat"] - first["lat"]).alias("y1"),
            (F.get(points, i + 1)["lon"] - first["lon"]).alias("x2"), (F.get(points, i + 1)["lat"] - first["lat"]).alias("y2"),
        ),
    )
    zero = F.struct(*(F.lit(0.0).alias(k) for k in ("a", "x", "y", "l", "lx", "ly")))

    def add(s: Column, e: Column) -> Column:
        cross = e["x1"] * e["y2"] - e["x2"] * e["y1"]
        length = F.sqrt(F.pow(e["x2"] - e["x1"], 2) + F.pow(e["y2"] - e["y1"], 2))
        return F.struct(
            (s["a"] + cross).alias("a"), (s["x"] + (e["x1"] + e["x2"]) * cross).alias("x"), (s["y"] + (e["y1"] + e["y2"]) * cross).alias("y"),
            (s["l"] + length).alias("l"), (s["lx"] + (e["x1"] + e["x2"]) / 2 * length).alias("lx"), (s["ly"] + (e["y1"] + e["y2"]) / 2 * length).alias("ly"),
        )

    def result(s: Column) -> Column:
        x = F.when(s["a"] != 0, F.try_divide(s["x"], 3 * s["a"])).when(s["l"] != 0, F.try_divide(s["lx"], s["l"])).otherwise(F.lit(0.0))
        y = F.when(s["a"] != 0, F.try_divide(s["y"], 3 * s["a"])).when(s["l"] != 0, F.try_divide(s["ly"], s["l"])).otherwise(F.lit(0.0))
        return F.struct((first["lat"] + y).alias("lat"), (first["lon"] + x).alias("lon"))

    ring = F.when(closed, F.aggregate(edges, zero, add, result))
    return F.when(n == 1, F.struct(first["lat"].alias("lat"), first["lon"].alias("lon"))).otherwise(ring)
