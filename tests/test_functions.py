from datetime import timedelta

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postmill.functions import compare, geo, ranking, text
from postmill.functions.helpers import parse_duration, partition


def values(spark, *columns):
    return list(spark.range(1).select(*(c.alias(f"c{i}") for i, c in enumerate(columns))).first())


def test_partition_examples():
    assert partition(0, 99, 2) == [(0, 49), (50, 99)]


@settings(deadline=None)
@given(st.integers(-500, 500), st.integers(0, 300), st.integers(1, 12))
def test_partition_is_complete_and_disjoint(low, size, parts):
    found = partition(low, low + size, parts)
    assert len(found) == parts
    assert [x for a, b in found for x in range(a, b + 1)] == list(range(low, low + size + 1))


def test_partition_of_all_longs():
    found = partition(-(1 << 63), (1 << 63) - 1, 3)
    assert found[0][0] == -(1 << 63) and found[-1][1] == (1 << 63) - 1


def test_parse_duration():
    assert parse_duration("1500") == timedelta(seconds=1.5)


def test_text_forms(spark):
    s = F.lit
    got = values(spark, text.fold(s(" Bd. de l'Étoile-Œuvre ")), text.expand(text.fold(s("av. du Dr. Jean"))), text.core(text.expand(text.fold(s("Rue de la")))), text.core(text.expand(text.fold(s("Rue de la Paix")))), text.number_key(s("4 Bis")), text.postcode_key(s(" 75 001a")), text.trimmed(s(" \tx ")))
    assert got == ["bd de l etoile oeuvre", "avenue du docteur jean", "rue de la", "paix", "4bis", "75001A", "x"]


def test_statuses(spark):
    s, street = F.lit, lambda a, b: compare.street_status(F.lit(a), F.lit(b))
    got = values(spark, street("Avenue de l'Europe", "av. de l europe"), street("Avenue De La République", "av. république"), street("Avenue de l'Europe", "Route de l'Europe"), street("Rue A1", "Rue B2"), compare.number_status(s("2D"), s("2E")), compare.number_status(s("4 bis"), s("4bis")))
    assert got == [9, 6, 3, 0, 0, 9]


def test_null_comparison(spark):
    null, x = F.lit(None).cast("string"), F.lit("x")
    got = values(spark, compare.field_compare(null, null, compare.name_status), compare.opt_field_compare(null, null, compare.name_status), compare.opt_field_compare(null, x, compare.name_status), compare.field_compare(x, x, compare.name_status))
    assert got == [0, 9, 0, 9]


def test_distance_and_cells(spark):
    d = F.lit
    metres, x, y = values(spark, geo.haversine(d(48.85504), d(2.22249), d(48.85497), d(2.22255)), geo.cell_x(d(180.0)), geo.cell_y(d(90.0)))
    assert abs(metres - 8.94) < 0.01 and x == 0 and y == 4095
    assert len(values(spark, geo.around(d(0), d(0)))[0]) == 6


def test_polygon_border_is_outside(spark):
    box = [[[(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)], [(0.5, 0.5), (1.0, 0.5), (1.0, 1.0), (0.5, 1.0)]]]
    inside = lambda lat, lon: geo.in_polygons(F.lit(lat), F.lit(lon), box)
    assert values(spark, inside(1.5, 1.5), inside(0.0, 1.0), inside(0.7, 0.7), inside(3.0, 1.0), geo.in_polygons(F.lit(None).cast("double"), F.lit(1.0), box)) == [True, False, False, False, False]


def test_centroid(spark):
    ring = lambda *ps: F.array(*(F.struct(F.lit(float(a)).alias("lat"), F.lit(float(b)).alias("lon")) for a, b in ps))
    square, line, opened, one = values(spark, geo.centroid(ring((0, 0), (0, 2), (2, 2), (2, 0), (0, 0))), geo.centroid(ring((0, 0), (0, 2), (0, 2), (0, 0))), geo.centroid(ring((0, 0), (0, 2), (2, 2))), geo.centroid(ring((5, 6))))
    assert tuple(square) == (1.0, 1.0) and tuple(line) == (0.0, 1.0) and opened is None and tuple(one) == (5.0, 6.0)


def test_rank_source_decides(spark):
    rows = spark.createDataFrame([("bano", None), ("openaddress", "x")], "source string, city string")
    for f in ("number", "street", "unit", "district", "region", "postcode"):
        rows = rows.withColumn(f, F.when(F.col("source") == "openaddress", F.lit("x")))
    got = {r.source: r.rank for r in rows.select("source", ranking.rank(F.col("source")).alias("rank")).collect()}
    assert got == {"bano": 3.2, "openaddress": 1.9}


def test_points_in_large_and_overlapping_polygons(spark):
    import math
    import random

    rng = random.Random(3)
    star = lambda x, y, n, wide: [(x + (1 + 0.5 * rng.random()) * wide * math.cos(2 * math.pi * i / n), y + (1 + 0.5 * rng.random()) * wide * math.sin(2 * math.pi * i / n)) for i in range(n)]
    polygons = [[star(2, 48, 5000, 3), star(2, 48, 40, 0.5)], [star(4, 49, 60, 2)], [[(10, 10), (12, 10), (12, 12), (10, 12), (10, 10)]]]

    def inside(x, y):
        for rings in polygons:
            hits = 0
            for ring in rings:
                for (x1, y1), (x2, y2) in zip(ring, [*ring[1:], ring[0]]):
                    hits += (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1
            if hits % 2:
                return True
        return False

    points = [(rng.uniform(-4, 9), rng.uniform(42, 54)) for _ in range(300)] + [(2.0, 48.0), (11.0, 11.0), (9.9, 11.0)]
    border = [(10.0, 11.0), (12.0, 10.5), (11.0, 10.0), (11.0, 12.0), (10.0, 10.0)]
    frame = spark.createDataFrame([(float(x), float(y)) for x, y in points + border] + [(None, 1.0)], "lon double, lat double")
    got = [r.i for r in frame.select(geo.in_polygons(F.col("lat"), F.col("lon"), polygons).alias("i")).collect()]
    assert got == [inside(x, y) for x, y in points] + [False] * 6 and 50 < sum(got) < 250
