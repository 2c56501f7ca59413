import base64
import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from daymosaic.fixed_values import INDICATORS, RAMP_COLOURS
from daymosaic.functions import projection as tm
from daymosaic.functions.colour import channel, with_colour
from daymosaic.operators import raster as ra
from daymosaic.operators.imaging import decode_png, image_legend, image_pixels, image_table
from daymosaic.plans.maps import daily_images
from daymosaic.schemas import GridSpec

D1, D2 = dt.date(2025, 3, 7), dt.date(2025, 3, 8)
GRID = GridSpec(0.0, 10.0, 0.0, 10.0, 1.0)
UTM = GridSpec(400000.0, 440000.0, 4400000.0, 4440000.0, 1000.0)
NAN = float("nan")


def wide(spark, rows, columns):
    """Rows of keys and one value; every indicator holds the value."""
    df = spark.createDataFrame(rows, columns + ", v double")
    return df.withColumns({n: F.col("v") for n in INDICATORS}).drop("v")


def test_last_observation_wins_even_when_it_is_null(spark, plan):
    df = wide(spark, [(D1, 5, 1, 1.0), (D1, 5, 2, None), (D1, 6, 9, 3.0), (D1, 6, 2, 4.0), (D1, None, 3, 7.0), (D2, 5, 1, 2.0)],
              "date date, cell long, obs_id long")
    out = ra.grid_scatter(df, "obs_id")
    assert {(r["date"], r["cell"]): r["PET"] for r in out.collect()} == {(D1, 5): None, (D1, 6): 3.0, (D2, 5): 2.0}
    assert "SortAggregate" not in plan(out)


def test_block_mean_skips_missing_and_keeps_partial_blocks(spark):
    df = wide(spark, [(D1, 1, 1.0), (D1, 2, 3.0), (D1, 12, NAN), (D1, 11, None), (D1, 100, 8.0), (D1, 45, None)], "date date, cell long")
    got = {(r["row"], r["col"]): r["LAI"] for r in ra.block_mean(df, GRID, 4).collect()}
    assert got == {(0, 0): 2.0, (2, 2): 8.0, (1, 1): None}
    assert (GRID.coarse(4).ncol, GRID.coarse(4).nrow) == (3, 3)


def test_block_of_one_is_the_layer_itself(spark):
    df = wide(spark, [(D1, c, float(c)) for c in (1, 10, 11, 55, 100)], "date date, cell long")
    got = {r["row"] * 10 + r["col"] + 1: r["REW"] for r in ra.block_mean(df, GRID, 1).collect()}
    assert got == {c: float(c) for c in (1, 10, 11, 55, 100)}


def test_scaled_round_half_away_from_zero(spark):
    df = spark.createDataFrame([(0.0005,), (-0.0005,), (1.2344,), (None,)], "x double")
    assert [r[0] for r in df.select(ra.scaled_round(F.col("x"))).collect()] == [1.0, -1.0, 1234.0, None]


def test_ranges_skip_missing(spark):
    df = wide(spark, [(D1, 1.0), (D1, NAN), (D1, None), (D1, -2.0), (D2, None)], "date date")
    got = {(r["date"], r["var"]): (r["min_value"], r["max_value"]) for r in ra.var_ranges(df).collect()}
    assert len(got) == 26 and got[D1, "Psi"] == (-2.0, 1.0) and got[D2, "CFP"] == (None, None)


def ramp(spark, var, values, low=0.0, high=16.0):
    df = spark.createDataFrame([(i, var, v, low, high) for i, v in enumerate(values)],
                               "i int, var string, v double, lo double, hi double")
    return [r["c"] for r in with_colour(df, "v", "lo", "hi", "var", "c").orderBy("i").collect()]


# The even ramp at 0, 1/16, ... 1.
SIXTEENTHS = (
    "FF0D50 FE5668 FB7C82 FD9497 FEABAC FFC1C1 FFD7D7 F9E3E4 F2EFF2 C6CCD6 9AAABA 759AAD 4B8AA1 317F98 007490 006C8A 006584"
).split()


def test_even_ramp(spark):
    assert ramp(spark, "Theta", [float(i) for i in range(17)]) == ["#" + c for c in SIXTEENTHS]


def test_reversed_ramp_runs_the_other_way(spark):
    for var in ("DDS", "SFP", "CFP"):
        assert ramp(spark, var, [float(16 - i) for i in range(17)]) == ["#" + c for c in SIXTEENTHS]


def test_psi_ramp_hits_the_anchors_at_its_breaks(spark):
    breaks = (0.0, 0.45, 0.65, 0.75, 0.8, 0.85, 0.9, 0.95, 1.0)
    assert ramp(spark, "Psi", list(breaks), 0.0, 1.0) == list(RAMP_COLOURS)


def test_missing_values_of_a_flat_layer_stay_missing(spark):
    df = wide(spark, [(D1, 0, 0, 2.0), (D1, 0, 1, None), (D1, 0, 2, float("nan"))], "date date, row long, col long")
    colours = [r["colour"] for r in ra.coloured(df).collect() if r["var"] == "PET"]
    assert sorted(colours) == ["#F2EFF2", "#FFFFFF00", "#FFFFFF00"]


def test_missing_and_flat_layers(spark):
    assert ramp(spark, "PET", [None, NAN]) == ["#FFFFFF00"] * 2
    assert ramp(spark, "PET", [4.0], 4.0, 4.0) == [RAMP_COLOURS[4]]
    assert ramp(spark, "PET", [None], None, None) == ["#FFFFFF00"]


def test_channels(spark):
    df = spark.createDataFrame([("#FF0D50",), ("#FFFFFF00",)], "c string")
    assert [tuple(r) for r in df.select(*[channel(F.col("c"), i) for i in range(3)]).collect()] == [(255, 13, 80), (255, 255, 255)]


def test_colour_lookup_has_each_value_once(spark):
    df = wide(spark, [(D1, 1.0), (D1, 1.0), (D1, 3.0), (D1, None), (D2, 1.0)], "date date")
    rows = ra.colour_lookup(df).collect()
    assert len(rows) == 13 * 4
    got = {(r["date"], r["var"], r["value"]): r["colour"] for r in rows}
    assert got[D1, "Theta", 1.0] == RAMP_COLOURS[0] and got[D1, "DDS", 1.0] == RAMP_COLOURS[8]
    assert got[D2, "Theta", 1.0] == RAMP_COLOURS[4] and got[D1, "Theta", None] == "#FFFFFF00"


def test_projection_round_trip_and_known_points(spark):
    rng = random.Random(1)
    pts = [(rng.uniform(-9, 3), rng.uniform(36, 44)) for _ in range(200)]
    df = spark.createDataFrame(pts, "lon double, lat double")
    x, y = tm.to_metres(F.col("lon"), F.col("lat"))
    there = df.select("lon", "lat", x.alias("x"), y.alias("y"))
    lon, lat = tm.to_degrees(F.col("x"), F.col("y"))
    for r in there.select("*", lon.alias("lon2"), lat.alias("lat2")).collect():
        assert abs(r["lon"] - r["lon2"]) < 1e-8 and abs(r["lat"] - r["lat2"]) < 1e-8
        mx, my = tm.to_metres(r["lon"], r["lat"], math)
        assert abs(mx - r["x"]) < 1e-6 and abs(my - r["y"]) < 1e-6
    # on the central meridian the easting is the false easting and the northing the scaled arc
    assert tm.to_metres(-3.0, 0.0, math) == (500000.0, 0.0)
    assert abs(tm.to_metres(-3.0, 45.0, math)[1] - 0.9996 * 4984944.378) < 0.01


def test_resampling_keeps_a_constant_field_and_interpolates_a_plane(spark):
    target = ra.lonlat_grid(UTM, 20, 20)
    cells = [(D1, r, c, 5.0) for r in range(UTM.nrow) for c in range(UTM.ncol)]
    flat = ra.grid_resample_bilinear(wide(spark, cells, "date date, row long, col long"), UTM, target).collect()
    assert len(flat) > 300 and all(abs(r["Theta"] - 5.0) < 1e-12 for r in flat)
    slope = [(D1, r, c, float(c)) for _, r, c, _ in cells]
    plane = ra.grid_resample_bilinear(wide(spark, slope, "date date, row long, col long"), UTM, target).collect()
    for r in plane:
        lon = target.xmin + (r["col"] + 0.5) * target.resolution
        lat = target.ymax - (r["row"] + 0.5) * target.resolution
        x, _ = tm.to_metres(lon, lat, math)
        place = (x - UTM.xmin) / UTM.resolution - 0.5
        assert abs(r["PET"] - min(max(place, 0), UTM.ncol - 1)) < 1e-6


@pytest.mark.parametrize("max_bytes", [10**9, 0])
def test_resampling_renormalises_over_known_cells(spark, max_bytes):
    target = ra.lonlat_grid(UTM, 20, 20)
    rows = [(D1, r, c, 3.0 if (r + c) % 3 else None) for r in range(UTM.nrow) for c in range(UTM.ncol)]
    got = ra.grid_resample_bilinear(wide(spark, rows, "date date, row long, col long"), UTM, target, max_bytes=max_bytes).collect()
    assert all(r["LAI"] is None or abs(r["LAI"] - 3.0) < 1e-12 for r in got)
    assert sum(r["LAI"] is not None for r in got) > 0.9 * len(got)


def test_cell_centres_in_degrees(spark):
    df = spark.createDataFrame([(0, 0), (39, 39)], "row long, col long")
    for r in ra.cell_lonlat(df, UTM).collect():
        x, y = tm.to_metres(r["lon"], r["lat"], math)
        assert abs(x - (UTM.xmin + (r["col"] + 0.5) * 1000)) < 1e-3 and abs(y - (UTM.ymax - (r["row"] + 0.5) * 1000)) < 1e-3


def decode(uri):
    """Pixels of a PNG data URI as rows of (r, g, b)."""
    data = base64.b64decode(uri.removeprefix("data:image/png;base64,"))
    assert b"tRNS" + b"\x00\xff" * 3 in data
    return [[tuple(p) for p in line] for line in decode_png(data).tolist()]


def test_a_damaged_image_is_not_decoded(spark):
    df = wide(spark, [(D1, 0, 0, 1.0)], "date date, row long, col long")
    data = base64.b64decode(image_table(df, GridSpec(0.0, 2.0, 0.0, 2.0, 1.0)).first()["base64_string"].removeprefix("data:image/png;base64,"))
    for broken in (data[1:], data[:45] + bytes([data[45] ^ 1]) + data[46:]):
        with pytest.raises(ValueError):
            decode_png(broken)


def test_images_hold_the_colours_of_their_layer(spark):
    target = GridSpec(0.0, 4.0, 0.0, 3.0, 1.0)
    df = wide(spark, [(D1, 0, 0, 1.0), (D1, 2, 3, 3.0), (D1, 1, 1, None), (D2, 0, 1, 2.0)], "date date, row long, col long")
    rows = {(r["date"], r["var"]): r for r in image_table(df, target).collect()}
    assert len(rows) == 26
    r = rows["20250307", "Theta"]
    assert (r["left_ext"], r["down_ext"], r["right_ext"], r["up_ext"]) == (0.0, 0.0, 4.0, 3.0)
    assert (r["min_value"], r["max_value"], r["palette_selected"]) == (1.0, 3.0, "ag_GrnYl")
    white, red, blue = (255,) * 3, (255, 13, 80), (0, 101, 132)
    pixels = decode(r["base64_string"])
    assert len(pixels) == 3 and len(pixels[0]) == 4
    assert pixels[0][0] == red and pixels[2][3] == blue and pixels[1][1] == white and pixels[0][1] == white
    assert decode(rows["20250307", "DDS"]["base64_string"])[0][0] == blue
    legend = {(x["date"], x["var"]): (x["min_value"], x["max_value"]) for x in image_legend(df, target).collect()}
    assert legend == {k: (v["min_value"], v["max_value"]) for k, v in rows.items()}


@pytest.mark.parametrize("nrow", [1, 2, 3, 4, 7, 9])
def test_an_image_of_strips_is_the_image_of_its_pixels(spark, nrow):
    target = GridSpec(0.0, 4.0, 0.0, float(nrow), 1.0)
    values = {(r, c): float(r * 4 + c) for r in range(nrow) for c in range(4) if r < 3 or r > 5}   # the second strip may be empty
    df = wide(spark, [(D1, r, c, v) for (r, c), v in values.items()], "date date, row long, col long")
    one = next(r for r in image_table(df, target, strip_rows=3).collect() if r["var"] == "Theta")
    pixels = decode(one["base64_string"])
    shades = {(r["row"], r["col"]): r["colour"] for r in ra.coloured(ra.scaled_layers(df)).where("var = 'Theta'").collect()}
    want = [[tuple(bytes.fromhex(shades[r, c][1:7])) if (r, c) in shades else (255,) * 3 for c in range(4)] for r in range(nrow)]
    assert pixels == want
    back = {(r["row"], r["col"]): r["colour"] for r in image_pixels(image_table(df, target, strip_rows=3)).where("var = 'Theta'").collect()}
    assert back == shades


def test_images_of_many_days_in_small_batches(spark):
    """Days and strips that begin and end anywhere in a batch."""
    rng, target = random.Random(3), GridSpec(0.0, 5.0, 0.0, 6.0, 1.0)
    cells = [(D1 + dt.timedelta(d), r, c, rng.random()) for d in range(40) for r in range(6) for c in range(5) if rng.random() < 0.6]
    df = wide(spark, cells, "date date, row long, col long")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        got = {(r["date"], r["var"], r["row"], r["col"]): r["colour"] for r in image_pixels(image_table(df, target, strip_rows=4)).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    want = {(f"{r['date']:%Y%m%d}", r["var"], r["row"], r["col"]): r["colour"] for r in ra.coloured(ra.scaled_layers(df)).collect()}
    assert got == want


def test_images_from_observations(spark):
    obs = wide(spark, [(1, 1, D1, 1.0), (2, 2, D1, 2.0), (3, 2, D1, 3.0)], "obs_id long, point_id long, date date")
    pts = spark.createDataFrame([(1, 1, 405000.0, 4405000.0), (1, 2, 425000.0, 4425000.0)], "province int, point_id long, x double, y double")
    rows = daily_images(obs, pts, UTM, "obs_id", 20, 20).collect()
    assert len(rows) == 13 and all(-5 < r["left_ext"] < r["right_ext"] < -3 for r in rows)
    assert {(r["min_value"], r["max_value"]) for r in rows} == {(1.0, 3.0)}


def test_a_day_moves_twice_until_its_images_are_encoded(spark, plan):
    obs = wide(spark, [(1, 1, D1, 1.0)], "obs_id long, point_id long, date date")
    pts = spark.createDataFrame([(1, 1, 405000.0, 4405000.0)], "province int, point_id long, x double, y double")
    text = plan(daily_images(obs, pts, UTM, "obs_id", 20, 20))
    before = text[text.index("MapInArrow"):]
    assert before.count("Exchange hashpartitioning") == 2 and "MapInArrow" not in text[:text.index("MapInArrow")]
