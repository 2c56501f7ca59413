import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from daymosaic.fixed_values import INDICATORS
from daymosaic.functions.geometry import edges_of, rings_from_wkt, wkt_from_rings
from daymosaic.functions.projection import to_metres
from daymosaic.functions.sizing import materialise
from daymosaic.operators import regions as rg
from daymosaic.plans.regional import regional_series

DAY = dt.date(2025, 1, 1)
SIZES = ("municipio", "comarca", "provincia")
COLUMNS = "admin_level string, polygon_id int, name string, `ine.prov.name` string, cpro string, wkt string"


def ring(*vertices):
    return "(" + ", ".join(f"{x} {y}" for x, y in [*vertices, vertices[0]]) + ")"


def box(x0, y0, x1, y1):
    return ring((x0, y0), (x1, y0), (x1, y1), (x0, y1))


def polygon(*rings):
    return "POLYGON (" + ", ".join(rings) + ")"


def rows_of(level, *shapes):
    return [(level, i, f"n{i}", f"p{i}", f"{i:02d}", s) for i, s in enumerate(shapes)]


def locate(spark, points, polygons, max_bytes=10**9, **options):
    pts = spark.createDataFrame(points, "point_id long, x double, y double")
    clean = rg.admin_polygons_clean(spark.createDataFrame(polygons, COLUMNS))
    found = rg.locate_points(pts, clean, max_bytes, **options)
    rows = [(r["point_id"], r["admin_level"], r["polygon_id"]) for r in found.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("max_bytes", [10**9, 0])
def test_missing_and_infinite_coordinates_are_nowhere(spark, max_bytes):
    nan, inf = float("nan"), float("inf")
    shapes = rows_of("comarca", polygon(box(-50, -50, 50, 50), box(-2, -2, 2, 2)))
    points = [(1, nan, 5.0), (2, nan, nan), (3, None, 5.0), (4, 5.0, inf), (5, -inf, nan), (6, 5.0, 5.0), (7, 0.0, 0.0)]
    assert locate(spark, points, shapes, max_bytes) == {(6, "comarca", 0)}


def test_borders_count_in_every_polygon_they_touch(spark):
    shapes = rows_of("comarca", polygon(box(0, 0, 50, 50)), polygon(box(50, 0, 100, 50)), polygon(box(0, 50, 50, 100)))
    points = [(1, 25.0, 25.0), (2, 50.0, 25.0), (3, 50.0, 50.0), (4, 0.0, 0.0), (5, 100.0, 50.0), (6, 100.5, 10.0),
              (7, 25.0, 50.0), (8, 50.0, 100.0)]
    got = locate(spark, points, shapes)
    assert {(p, i) for p, _, i in got} == {
        (1, 0), (2, 0), (2, 1), (3, 0), (3, 1), (3, 2), (4, 0), (5, 1), (7, 0), (7, 2), (8, 2)}


def test_holes_and_multipolygons(spark):
    shapes = rows_of(
        "provincia",
        polygon(box(0, 0, 100, 100), box(40, 40, 60, 60)),
        "MULTIPOLYGON ((" + box(200, 0, 210, 10) + "), (" + box(300, 0, 310, 10) + "))",
    )
    points = [(1, 10.0, 10.0), (2, 50.0, 50.0), (3, 40.0, 50.0), (4, 205.0, 5.0), (5, 305.0, 5.0), (6, 250.0, 5.0)]
    assert {(p, i) for p, _, i in locate(spark, points, shapes)} == {(1, 0), (3, 0), (4, 1), (5, 1)}


def inside(x, y, vertices):
    """Even-odd test with borders, written for one point."""
    edges = list(zip(vertices, vertices[1:] + vertices[:1]))
    for (ax, ay), (bx, by) in edges:
        turn = (bx - ax) * (y - ay) - (by - ay) * (x - ax)
        if turn == 0 and min(ax, bx) <= x <= max(ax, bx) and min(ay, by) <= y <= max(ay, by):
            return True
    hits = [x < (bx - ax) * (y - ay) / (by - ay) + ax for (ax, ay), (bx, by) in edges if (ay > y) != (by > y)]
    return sum(hits) % 2 == 1


@pytest.mark.parametrize("max_bytes,max_edges,max_depth", [(10**9, 24, 14), (0, 2, 14), (10**9, 1, 5), (10**9, 3, 0)])
def test_cover_join_equals_testing_every_pair(spark, max_bytes, max_edges, max_depth):
    rng = random.Random(11)
    shapes = [[(rng.randrange(-50, 150), rng.randrange(-50, 150)) for _ in range(rng.randrange(3, 8))] for _ in range(30)]
    points = [(i, float(rng.randrange(-60, 160)), float(rng.randrange(-60, 160))) for i in range(400)]
    polygons = []
    for level in SIZES:
        polygons += rows_of(level, *[polygon(ring(*s)) for s in shapes])
    want = {(p, level, i) for p, x, y in points for i, s in enumerate(shapes) if inside(x, y, s) for level in SIZES}
    assert locate(spark, points, polygons, max_bytes, max_edges=max_edges, max_depth=max_depth) == want


def test_a_border_of_a_hundred_thousand_vertices(spark):
    """A wavy ring with a wavy hole: no cell has more edges than asked for, and points are where their radius says."""
    n, rng = 100_000, random.Random(7)

    def wavy(radius, count):
        angles = [2 * math.pi * i / count for i in range(count)]
        return ring(*[(5000 + radius(a) * math.cos(a), 5000 + radius(a) * math.sin(a)) for a in angles])

    outer, inner = (lambda a: 4000 + 300 * math.sin(40 * a)), (lambda a: 1500 + 200 * math.cos(25 * a))
    shape = rows_of("provincia", polygon(wavy(outer, n), wavy(inner, n // 4)))
    clean = rg.admin_polygons_clean(spark.createDataFrame(shape, COLUMNS))
    cover, cells = materialise(rg.polygon_cover(clean), "cover")
    seen = cover.agg(F.max(F.size("edges")).alias("most"), F.sum(F.col("whole").cast("int")).alias("inner"), F.countDistinct("e").alias("sizes")).first()
    assert seen["most"] < 300 and seen["inner"] > 1000 and seen["sizes"] > 5 and cells < 200_000
    points, want = [], set()
    for i in range(3000):
        a, r = rng.uniform(0, 2 * math.pi), rng.uniform(0, 5000)
        if abs(r - outer(a)) < 0.01 or abs(r - inner(a)) < 0.01:
            continue
        points.append((i, 5000 + r * math.cos(a), 5000 + r * math.sin(a)))
        if inner(a) < r < outer(a):
            want.add((i, "provincia", 0))
    assert locate(spark, points, shape) == want


def test_cells_inside_are_large_and_decided_once(spark):
    corners = [(0, 0), (700, 0), (700, 700), (0, 700)]
    fine = [(x0 + (x1 - x0) * k / 50, y0 + (y1 - y0) * k / 50) for (x0, y0), (x1, y1) in zip(corners, corners[1:] + corners[:1]) for k in range(50)]
    clean = rg.admin_polygons_clean(spark.createDataFrame(rows_of("municipio", polygon(ring(*fine))), COLUMNS))
    rows = rg.polygon_cover(clean).groupBy("whole").agg(
        F.count(F.lit(1)).alias("n"), F.max("e").alias("largest"), F.max(F.size("edges")).alias("edges"), F.sum(F.pow(F.lit(4.0), "e")).alias("area")).collect()
    got = {r["whole"]: r for r in rows}
    assert got[True]["largest"] >= 7 and got[True]["edges"] in (None, -1) and got[False]["edges"] <= 4 * rg.MAX_EDGES
    assert got[True]["area"] <= 700 * 700 <= got[True]["area"] + got[False]["area"]
    assert rg.locate_points(spark.createDataFrame([(1, 1.0, 1.0)], "point_id long, x double, y double"), clean.limit(0)).count() == 0


def test_empty_and_odd_boundaries_hold_nothing(spark):
    shapes = rows_of("comarca", "POLYGON EMPTY", "POLYGON ((1 1, 1 1, 1 1))", "", polygon(box(0, 0, 2, 2))) + [("comarca", 9, "n", "p", "01", None)]
    assert locate(spark, [(1, 1.0, 1.5), (2, 5.0, 5.0)], shapes) == {(1, "comarca", 3)}


def test_polygon_cleaning(spark):
    rows = [
        ("municipio", 1, "a", "Ceuta", "01", "w"), ("municipio", 2, "b", None, "02", "w"),
        ("municipio", 3, None, "x", "03", "w"), ("municipio", 4, "d", "x", None, "w"),
        ("comarca", 5, None, "x", "05", "w"), ("comarca", 6, "f", "Palmas, Las", "06", "w"),
        ("provincia", 7, "ignored", "Teruel", "07", "w"),
    ]
    got = {r["polygon_id"]: r["name"] for r in rg.admin_polygons_clean(spark.createDataFrame(rows, COLUMNS)).collect()}
    assert got == {2: "b", 5: None, 7: "Teruel"}


def test_wkt_round_trip(spark):
    text = polygon(box(0, 0, 10, 10), box(2, 2, 4, 4))
    df = spark.createDataFrame([(text,)], "wkt string").selectExpr(f"{rings_from_wkt('wkt')} AS r")
    row = df.selectExpr("size(r) AS rings", f"size({edges_of('r')}) AS edges", f"{wkt_from_rings('r')} AS wkt").first()
    assert (row["rings"], row["edges"]) == (2, 8)
    assert row["wkt"] == "POLYGON ((0.0 0.0, 10.0 0.0, 10.0 10.0, 0.0 10.0, 0.0 0.0), (2.0 2.0, 4.0 2.0, 4.0 4.0, 2.0 4.0, 2.0 2.0))"


def test_projection_keeps_the_shape_of_the_text(spark):
    text = "MULTIPOLYGON (((-3 0, -2 0, -2 1, -3 0), (-2.5 0.2, -2.4 0.2, -2.4 0.3, -2.5 0.2)), ((-1 0, 0 0, 0 1, -1 0)))"
    df = spark.createDataFrame([("provincia", text)], "admin_level string, wkt string")
    got = rg.project_polygons(df).first()["wkt"]
    assert got.startswith("MULTIPOLYGON (((500000.0 0.0, ") and got.endswith(")))")
    assert [c for c in got if c in "()"] == [c for c in text if c in "()"]
    assert spark.createDataFrame([(got,)], "wkt string").selectExpr(f"size({rings_from_wkt('wkt')})").first()[0] == 3


def snyder(lon, lat):
    """Transverse Mercator by another expansion: powers of the longitude difference (good to a millimetre near the zone)."""
    a, f, k0 = 6378137.0, 1 / 298.257222101, 0.9996
    e2 = f * (2 - f)
    ep2, phi, lam = e2 / (1 - e2), math.radians(lat), math.radians(lon + 3)
    n, t, c, big_a = a / math.sqrt(1 - e2 * math.sin(phi) ** 2), math.tan(phi) ** 2, ep2 * math.cos(phi) ** 2, lam * math.cos(phi)
    m = a * ((1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256) * phi - (3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024) * math.sin(2 * phi)
             + (15 * e2**2 / 256 + 45 * e2**3 / 1024) * math.sin(4 * phi) - 35 * e2**3 / 3072 * math.sin(6 * phi))
    x = 500000 + k0 * n * (big_a + (1 - t + c) * big_a**3 / 6 + (5 - 18 * t + t * t + 72 * c - 58 * ep2) * big_a**5 / 120)
    y = k0 * (m + n * math.tan(phi) * (big_a**2 / 2 + (5 - t + 9 * c + 4 * c * c) * big_a**4 / 24
                                       + (61 - 58 * t + t * t + 600 * c - 330 * ep2) * big_a**6 / 720))
    return x, y


def test_points_off_the_central_meridian(spark):
    places = [(-3.7, 40.4), (-1.0, 37.9), (-5.9, 43.5), (-0.1, 42.0), (-4.4, 36.7)]
    df = spark.createDataFrame(places, "lon double, lat double")
    x, y = to_metres(F.col("lon"), F.col("lat"))
    for r in df.select("lon", "lat", x.alias("x"), y.alias("y")).collect():
        want = snyder(r["lon"], r["lat"])
        assert abs(r["x"] - want[0]) < 0.01 and abs(r["y"] - want[1]) < 0.01


def test_edges_are_cut_until_they_bend_less(spark):
    text = "POLYGON ((-6 40, 0 40, 0 42, -6 42, -6 40))"
    df = spark.createDataFrame([("provincia", text)], "admin_level string, wkt string")
    for tolerance in (100.0, 1.0):
        rings = rg.project_polygons(df, tolerance).selectExpr(f"{rings_from_wkt('wkt')} AS r").first()["r"]
        vertices = [(p["x"], p["y"]) for p in rings[0]]
        assert vertices[0] == vertices[-1] and (len(vertices) > 100) == (tolerance == 1.0)
        for k in range(200):                       # points of the straight border in degrees lie near the projected one
            lon, lat = -6 + 6 * (k + 0.5) / 200, 40.0
            x, y = to_metres(lon, lat, math)
            off = min(abs((bx - ax) * (ay - y) - (ax - x) * (by - ay)) / math.hypot(bx - ax, by - ay)
                      for (ax, ay), (bx, by) in zip(vertices, vertices[1:]) if min(ax, bx) - 1 <= x <= max(ax, bx) + 1 and abs(ay - y) < 5000)
            assert off <= tolerance * 1.01
    assert rg.project_polygons(df).selectExpr(f"size({rings_from_wkt('wkt')}[0])").first()[0] == 5


def test_regions_in_degrees(spark):
    """A parallel bends by hundreds of metres: a point between its chord and itself is in the northern region."""
    polygons = spark.createDataFrame(rows_of("provincia", "POLYGON ((-6 38, 0 38, 0 40, -6 40, -6 38))", "POLYGON ((-6 40, 0 40, 0 42, -6 42, -6 40))"), COLUMNS)
    rows = [(i, *to_metres(lon, lat, math)) for i, (lon, lat) in enumerate([(-3.0, 40.0005), (-3.0, 39.9995), (-5.9, 40.0005), (-3.0, 45.0)])]
    points = spark.createDataFrame(rows, "point_id long, x double, y double")
    means = regional_series(observations(spark, [(i, DAY, float(i)) for i in range(4)]), points, polygons, clean=False, degrees=True)
    assert {r["polygon_id"]: r["Theta"] for r in means.collect()} == {0: 1.0, 1: 1.0}


def observations(spark, rows):
    df = spark.createDataFrame(rows, "point_id long, date date, v double")
    return df.withColumns({c: F.col("v") for c in INDICATORS}).drop("v")


def test_means_by_polygon_not_by_name(spark):
    polygons = [("municipio", 1, "same", "p", "01", polygon(box(0, 0, 10, 10))),
                ("municipio", 2, "same", "p", "02", polygon(box(10, 0, 20, 10)))]
    pts = spark.createDataFrame([(1, 5.0, 5.0), (2, 15.0, 5.0), (3, 10.0, 5.0), (4, 99.0, 5.0)], "point_id long, x double, y double")
    nan = float("nan")
    obs = observations(spark, [(1, DAY, 1.0), (2, DAY, 3.0), (3, DAY, 5.0), (3, DAY, nan), (2, DAY, None), (4, DAY, 100.0)])
    frame = spark.createDataFrame(polygons, COLUMNS)
    got = {r["polygon_id"]: r for r in regional_series(obs, pts, frame, clean=False).collect()}
    assert (got[1]["Theta"], got[2]["CFP"]) == (3.0, 4.0)
    assert got[1]["name"] == got[2]["name"] == "same" and got[1]["province_code"] == "01"
    assert got[1]["geom"] == polygon(box(0, 0, 10, 10)) and got[1]["admin_level"] == "municipio"


def test_empty_mean_is_null_and_empty_polygon_has_no_row(spark):
    polygons = rows_of("municipio", polygon(box(0, 0, 10, 10)), polygon(box(50, 0, 60, 10)))
    pts = spark.createDataFrame([(1, 5.0, 5.0)], "point_id long, x double, y double")
    obs = observations(spark, [(1, DAY, float("nan")), (1, DAY, None)])
    rows = regional_series(obs, pts, spark.createDataFrame(polygons, COLUMNS), clean=False).collect()
    assert len(rows) == 1 and all(rows[0][v] is None for v in INDICATORS)


def test_shuffled_path_equals_broadcast_path(spark, plan):
    rng = random.Random(2)
    polygons = []
    for level in SIZES:
        polygons += rows_of(level, *[polygon(box(i * 20, 0, i * 20 + 25, 100)) for i in range(5)])
    pts = spark.createDataFrame([(i, rng.random() * 100, rng.random() * 100) for i in range(50)], "point_id long, x double, y double")
    # one point holds a third of all rows
    obs = observations(spark, [(0 if i % 3 == 0 else i % 50, DAY, rng.choice([None, float("nan"), float(i % 16)])) for i in range(900)])
    clean = rg.admin_polygons_clean(spark.createDataFrame(polygons, COLUMNS))
    located = rg.locate_points(pts, clean)
    small, large = rg.poly_daily_means(obs, located, clean), rg.poly_daily_means(obs, located, clean, max_bytes=0)
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))
    assert "SortMergeJoin" in plan(large) and "CartesianProduct" not in plan(large)


def test_plan_is_an_equality_join_with_partial_means(spark, plan):
    polygons = spark.createDataFrame(rows_of("municipio", polygon(box(0, 0, 10, 10))), COLUMNS)
    pts = spark.createDataFrame([(1, 5.0, 5.0)], "point_id long, x double, y double")
    text = plan(regional_series(observations(spark, [(1, DAY, 1.0)]), pts, polygons))
    assert "BroadcastHashJoin" in text and "partial_sum" in text
    assert "NestedLoop" not in text and "CartesianProduct" not in text


def test_points_of_one_split_are_located_by_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(rg, "POINTS_PER_TASK", 100)
    pts = spark.range(1000).coalesce(1).selectExpr("id AS point_id", "CAST(id % 40 AS DOUBLE) + 0.5 AS x", "CAST(id % 30 AS DOUBLE) AS y")
    clean = rg.admin_polygons_clean(spark.createDataFrame(rows_of("comarca", polygon(box(0, 0, 50, 50))), COLUMNS))
    found = rg.locate_points(pts, clean).select("point_id", F.spark_partition_id().alias("task")).collect()
    assert sorted(r["point_id"] for r in found) == list(range(1000)) and len({r["task"] for r in found}) == 10
