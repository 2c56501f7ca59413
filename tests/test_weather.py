import datetime as dt
import random
from collections import Counter
from itertools import groupby

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymosaic.fixed_values import WEATHER_UNUSED, WEATHER_VARS
from daymosaic.functions.curve import morton
from daymosaic.functions.grid import cell_number, col_of_cell, row_of_cell
from daymosaic.functions.sizing import materialise
from daymosaic.operators import state as st
from daymosaic.operators import weather as w
from daymosaic.plans.forcing import day_forcing, simulation_input
from daymosaic.schemas import GridSpec
from daymosaic.sources.readers import read_weather
from daymosaic.sources.writers import write_state_history, write_weather

GRID = GridSpec(0.0, 10.0, 0.0, 10.0, 1.0)
D1, D2 = dt.date(2025, 1, 1), dt.date(2025, 1, 2)


def days():
    return F.array(F.lit(D1), F.lit(D2))


def weather(spark, rows):
    """Rows of (obs_id, x, y, dates, value); all variables hold the value."""
    df = spark.createDataFrame(rows, "obs_id long, x double, y double, dates date, v double")
    return df.withColumns({n: F.col("v") for n in WEATHER_VARS}).drop("v")


def points(spark, rows):
    return spark.createDataFrame(rows, "province int, point_id long, x double, y double")


@pytest.mark.parametrize("x,y,want", [
    (0.0, 10.0, 1), (0.5, 9.5, 1), (1.0, 9.5, 2), (10.0, 10.0, 10), (0.0, 0.0, 91), (10.0, 0.0, 100),
    (10.1, 5.0, None), (-0.1, 5.0, None), (5.0, 10.1, None), (None, 5.0, None), (float("nan"), 5.0, None),
])
def test_cell_of_point(spark, x, y, want):
    df = spark.createDataFrame([(x, y)], "x double, y double")
    assert df.select(cell_number(F.col("x"), F.col("y"), GRID)).first()[0] == want


def test_row_and_column_of_cell(spark):
    got = spark.range(1, 101).select(
        "id", row_of_cell(F.col("id"), GRID).alias("r"), col_of_cell(F.col("id"), GRID).alias("c")).collect()
    assert all((r["r"], r["c"]) == divmod(r["id"] - 1, 10) for r in got)


def test_unused_columns_and_rows_outside_are_dropped(spark):
    df = weather(spark, [(1, 0.5, 0.5, D1, 1.0), (2, 50.0, 0.5, D1, 1.0)]).withColumns(
        {c: F.lit(1) for c in WEATHER_UNUSED})
    got = w.weather_on_grid(df, GRID)
    assert got.count() == 1 and not set(WEATHER_UNUSED) & set(got.columns)


def fill(pts, gridded):
    return w.weather_gap_fill(w.cells_of(pts), gridded, days(), "obs_id")


def test_points_outside_the_grid_match_nothing_but_get_a_filler(spark):
    pts = w.with_cell(points(spark, [(1, 1, 0.5, 0.5), (1, 2, 99.0, 0.5), (1, 3, 98.0, 0.5)]), GRID)
    gridded = w.weather_on_grid(weather(spark, [(1, 0.6, 0.6, D1, 4.0), (2, 77.0, 0.5, D1, 9.0)]), GRID)
    reduced = w.weather_semi(gridded, pts, GRID)
    assert reduced.count() == 1
    filled = fill(pts, reduced)
    assert filled.count() == 4          # two cells, one of them NULL, two days
    rows = w.weather_to_points(pts, filled, filled=True).collect()
    assert len(rows) == 6 and {r["dates"] for r in rows} == {D1, D2}
    assert [(r["point_id"], r["dates"], r["obs_id"]) for r in rows if r["PET"] is not None] == [(1, D1, 1)]


@pytest.mark.parametrize("max_bytes", [10**9, 0])
def test_points_sharing_a_cell_share_one_filler(spark, max_bytes):
    pts = w.with_cell(points(spark, [(1, 1, 0.5, 0.5), (1, 2, 0.6, 0.6)]), GRID)
    empty = w.weather_on_grid(weather(spark, []), GRID)
    cells = w.cells_of(pts)
    assert w.cells_without_weather(cells, empty, days(), 200, max_bytes).count() == 2
    assert w.weather_to_points(pts, fill(pts, empty), max_bytes=max_bytes).count() == 4


@pytest.mark.parametrize("max_bytes", [10**9, 0])
def test_every_point_is_kept_on_both_join_paths(spark, max_bytes):
    pts = w.with_cell(points(spark, [(1, i, float(i % 12), 0.5) for i in range(40)]), GRID)
    rows = [(i, float(i % 7) + 0.2, 0.4, D1 if i % 2 else D2, float(i)) for i in range(60)]
    gridded = w.weather_on_grid(weather(spark, rows), GRID)
    got = w.weather_to_points(pts, gridded.select("cell", "dates", "obs_id"), max_bytes=max_bytes).collect()
    want = set()
    for i in range(40):
        cell = (i % 12) if i % 12 < 10 else 9 if i % 12 == 10 else None
        want |= {(i, r[3], r[0]) for r in rows if int(r[1]) == cell} or {(i, None, None)}
    assert {(r["point_id"], r["dates"], r["obs_id"]) for r in got} == want and len(got) == len(want)


HOT = [(i, 0.5, 0.5, D1, float(i)) for i in range(4000)] + [(4000 + i, 0.5 + i % 9, 0.5 + i % 7, D1 if i % 2 else D2, 1.0) for i in range(8000)]


@pytest.mark.parametrize("max_bytes", [10**9, 0])
def test_a_cell_and_day_with_a_third_of_all_weather_is_spread(spark, max_bytes):
    """No task has more than twice the rows of the median, and every row comes out as it went in."""
    settings = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "24k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "24k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        data = weather(spark, HOT).repartition(16, "obs_id")
        data, _ = materialise(data, "hot")
        pts = points(spark, [(1, i, 0.6 + i % 9, 0.6 + i % 7) for i in range(63)])
        out, _ = materialise(day_forcing(pts, data, GRID, [D1, D2], "obs_id", max_bytes).withColumn("task", F.spark_partition_id()), "forced")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    wanted = {(int(p["point_id"]), r[0], r[3], r[4]) for p in pts.collect() for r in HOT
              if (int(p["x"]), int(p["y"])) == (int(r[1]), int(r[2]))}
    assert {(r["point_id"], r["obs_id"], r["dates"], r["PET"]) for r in out.where("obs_id IS NOT NULL").collect()} == wanted
    sizes = sorted(r["count"] for r in out.where("obs_id IS NOT NULL").groupBy("task").count().collect())
    if max_bytes:
        assert len(sizes) >= 4 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    else:  # both sides move, and the hot cell's partition is split
        assert sizes[-1] < 4000


def test_tasks_follow_the_pairs_and_not_the_bytes_of_the_weather(spark):
    """Few weather rows with many points each: more tasks, none with much more than its share of the result."""
    pts = w.with_cell(points(spark, [(1, i % 190, 0.5, 0.5) for i in range(200)] + [(2, 900, 99.0, 0.5), (2, 901, 3.5, 0.5)]), GRID)
    rows, _ = materialise(spark.createDataFrame(
        [(91, D1, i // 2) for i in range(400)] + [(None, D1, 7000), (94, D2, None)], "cell long, dates date, obs_id long").coalesce(1), "rows")
    got = w.weather_to_points(pts, rows, filled=True, pairs_per_task=5000).withColumn("task", F.spark_partition_id()).collect()
    want = Counter((i % 190, D1, k // 2) for i in range(200) for k in range(400)) + Counter([(900, D1, 7000), (901, D2, None)])
    assert Counter((r["point_id"], r["dates"], r["obs_id"]) for r in got) == want
    sizes = Counter(r["task"] for r in got).values()
    assert len(sizes) >= 16 and max(sizes) <= 2 * 5000


def many_pairs(spark, points_a_cell):
    """60 cells with 40 records and a filler each, in turn; one cell has 3000 records more."""
    pts = w.with_cell(points(spark, [(1, 7919 * i % 100003, i % 10 + 0.5, i // 10 % 6 + 0.5) for i in range(60 * points_a_cell)]), GRID)
    cells = [r["cell"] for r in w.cells_of(pts).orderBy("cell").collect()]
    assert len(cells) == 60
    records = [(cells[k % 60], D1, k) for k in range(2400)] + [(c, D2, None) for c in cells] + [(cells[7], D1, 5000 + k) for k in range(3000)]
    rows, _ = materialise(spark.createDataFrame(records, "cell long, dates date, obs_id long").coalesce(1), "rows")
    return pts, rows, records


def test_a_task_has_the_rows_of_few_cells_one_cell_after_the_other(spark):
    pts, rows, records = many_pairs(spark, 30)
    out = w.weather_to_points(pts, rows, filled=True, pairs_per_task=6000)
    got = out.withColumn("task", F.spark_partition_id()).collect()
    of_cell = {c: [p["point_id"] for p in pts.collect() if p["cell"] == c] for c in {r[0] for r in records}}
    assert Counter((r["point_id"], r["dates"], r["obs_id"]) for r in got) == Counter((p, d, k) for c, d, k in records for p in of_cell[c])
    tasks = {t: [r for r in got if r["task"] == t] for t in {r["task"] for r in got}}
    assert len(tasks) >= 20 and max(len(rs) for rs in tasks.values()) <= 1.5 * 6000
    for rs in tasks.values():
        assert len({r["cell"] for r in rs}) <= 8
        places = [(r["obs_id"] is None, r["cell"]) for r in rs]
        assert [k for k, _ in groupby(places)] == sorted(set(places))       # fillers last
    other = w.weather_to_points(pts, rows, filled=True, pairs_per_task=5000)
    assert out.unionByName(other).count() == 2 * len(got) and out.join(other, out.columns, "left").count() == len(got)


def test_what_is_written_follows_the_weather_and_not_the_pairs(spark, tmp_path):
    """Eight times the points a cell make eight times the rows, but nothing near eight times the bytes."""
    sizes = []
    for n in (30, 240):
        pts, rows, records = many_pairs(spark, n)
        w.weather_to_points(pts, rows, filled=True, pairs_per_task=6000 * n // 30).write.parquet(str(tmp_path / str(n)))
        assert spark.read.parquet(str(tmp_path / str(n))).count() == n * len(records)
        sizes.append(sum(f.stat().st_size for f in (tmp_path / str(n)).glob("*.parquet")))
    assert sizes[1] < 4 * sizes[0]


@pytest.mark.parametrize("max_bytes", [10**9, 0])
def test_points_of_a_full_cell_come_in_several_lists(spark, max_bytes):
    many = 3 * w.POINTS_PER_LIST
    pts = w.with_cell(points(spark, [(1, i, 0.5, 0.5) for i in range(many)] + [(1, many, 1.5, 0.5), (1, many + 1, 99.0, 0.5)]), GRID)
    per_cell = pts.groupBy(F.col("cell").alias("_cell")).agg(F.count(F.lit(1)).alias("partners"))
    lists = [(r["cell"], [p["point_id"] for p in r["_points"]]) for r in w.points_of_cells(pts, per_cell).collect()]
    assert sorted(i for _, some in lists for i in some) == list(range(many + 2))
    assert sorted((c for c, _ in lists if c != 91), key=str) == [92, None] and sum(c == 91 for c, _ in lists) == 3
    assert max(len(some) for _, some in lists) < 1.3 * w.POINTS_PER_LIST
    rows = spark.createDataFrame([(91, D1, 1), (91, D1, 2), (93, D1, 3)], "cell long, dates date, obs_id long")
    got = w.weather_to_points(pts, rows, max_bytes=max_bytes).collect()
    assert sorted((r["point_id"], r["obs_id"] or 0) for r in got) == sorted(
        [(i, k) for i in range(many) for k in (1, 2)] + [(many, 0), (many + 1, 0)])


def test_lists_are_made_at_the_edge_by_the_callers_number(spark):
    rows = [(i, 0.5, 0.5, D1, float(i)) for i in range(1000)] + [(5000, 1.5, 0.5, D1, 7.0)]
    gridded = w.weather_on_grid(weather(spark, rows), GRID)
    got = w.weather_nest(gridded, ["cell"], "obs_id", parts=10).collect()
    hot = [r for r in got if r["cell"] == 91]
    assert len(hot) == 10 and sorted(m["PET"] for r in hot for m in r["meteo"]) == [float(i) for i in range(1000)]
    pts = points(spark, [(1, 1, 0.5, 0.5), (1, 2, 1.6, 0.5)])
    forced = day_forcing(pts, weather(spark, rows + [(6000, 9.5, 9.5, D2, 1.0)]), GRID, [D1, D2], "obs_id")
    lists = w.weather_nest(forced, ["point_id"], "obs_id").collect()
    assert {(r["point_id"], r["dates"]): len(r["meteo"]) for r in lists} == {(1, D1): 1000, (1, D2): 1, (2, D1): 1, (2, D2): 1}
    one = next(r["meteo"] for r in lists if (r["point_id"], r["dates"]) == (1, D1))
    assert [m["PET"] for m in one] == [float(i) for i in range(1000)]


def test_a_day_without_any_weather_stops_the_plan(spark):
    pts, data = points(spark, [(1, 1, 0.5, 0.5)]), weather(spark, [(1, 5.5, 0.5, D1, 1.0)])
    assert day_forcing(pts, data, GRID, [D1], "obs_id").count() == 1        # weather elsewhere is enough
    with pytest.raises(Exception, match="no data for 2025-01-02"):
        day_forcing(pts, data, GRID, [D1, D2], "obs_id")


def test_bbox_scan_pushes_ranges_into_the_reader(spark, plan, tmp_path):
    weather(spark, [(1, 0.5, 0.5, D1, 1.0), (2, 5000.0, 0.5, D1, 1.0), (3, 0.5, 0.5, D2, 1.0)]).write.parquet(str(tmp_path / "w"))
    source = spark.read.parquet(str(tmp_path / "w"))
    boxes = w.province_bbox(points(spark, [(1, 1, 0.0, 0.0), (1, 2, 10.0, 10.0)]))
    assert tuple(boxes.first()) == (1, -1000.0, 1010.0, -1000.0, 1010.0)
    got = w.weather_bbox_scan(source, boxes, D1, D1)
    assert [r["obs_id"] for r in got.collect()] == [1]
    pushed = plan(got)
    assert "GreaterThanOrEqual(x,-1000.0)" in pushed and "LessThanOrEqual(y,1010.0)" in pushed
    many = points(spark, [(i, i, i * 1000.0, -i * 500.0) for i in range(30)] * 2)
    grid = weather(spark, [(x * 100 + y, x * 700.0, -y * 400.0, D1, 1.0) for x in range(50) for y in range(50)])
    boxes = w.province_bbox(many, margin=800.0)
    every = [tuple(b) for b in boxes.collect()]
    inside = [r["obs_id"] for r in grid.collect() if any(a <= r["x"] <= b and c <= r["y"] <= d for _, a, b, c, d in every)]
    joined = [r["obs_id"] for r in w.weather_bbox_scan(grid, boxes, D1, D1).collect()]
    assert 0 < len(inside) < 2500 and sorted(joined) == sorted(inside)
    assert w.weather_bbox_scan(grid, boxes.limit(0), D1, D1).count() == 0


def test_coverage(spark):
    pts = w.with_cell(points(spark, [(1, 1, 0.5, 0.5), (1, 2, 0.6, 0.5), (2, 3, 1.5, 0.5), (2, 4, 99.0, 0.5)]), GRID)
    gridded = w.weather_on_grid(weather(spark, [(1, 0.5, 0.5, D1, 1.0), (2, 0.5, 0.5, D2, 1.0)]), GRID)
    got = {r["province"]: tuple(r)[1:] for r in w.weather_coverage(pts, gridded).collect()}
    assert got == {1: (2, 1, 1, True), 2: (2, 1, 0, False)}


STATE = "struct<swc: bigint, soil: array<struct<W: double>>>"


def test_simulation_input_has_the_asked_days_only(spark):
    pts = points(spark, [(1, 1, 0.5, 0.5), (1, 2, 5.5, 0.5)]).withColumn(
        "state", F.expr(f"CAST(named_struct('swc', -point_id, 'soil', array(named_struct('W', 0.5D))) AS {STATE})")
    ).withColumn("height", F.lit(7))
    other = D1 - dt.timedelta(1)
    data = weather(spark, [(1, 0.5, 0.5, other, 1.0), (2, 0.5, 0.5, D1, 3.0), (3, 5.5, 0.5, D2 + dt.timedelta(5), 2.0), (4, 9.5, 9.5, D2, 1.0)])
    history = spark.createDataFrame(
        [(1, 1, dt.date(2024, 12, 30), (8, [(0.25,)]))], f"province int, point_id long, state_date date, state {STATE}")
    for max_bytes in (10**9, 0):
        got = simulation_input(pts, data, history, GRID, [D1, D2], dt.date(2025, 1, 7), "obs_id", max_bytes=max_bytes).collect()
        rows = {(r["point_id"], r["date"]): (r["PET"], r["state"]["swc"], r["soil"][0]["W"], r["height"]) for r in got}
        assert len(got) == 4 and rows == {
            (1, D1): (3.0, 8, 0.25, 7), (1, D2): (None, 8, 0.25, 7), (2, D1): (None, -2, 0.5, 7), (2, D2): (None, -2, 0.5, 7)}


def test_forcing_reads_the_values_of_the_weather_once(spark, plan, tmp_path):
    weather(spark, [(1, 0.5, 0.5, D1, 3.0), (2, 0.5, 0.5, D2, 3.0)]).write.parquet(str(tmp_path / "weather"))
    points(spark, [(1, 1, 0.5, 0.5)]).write.parquet(str(tmp_path / "points"))
    read = lambda name: spark.read.parquet(str(tmp_path / name))
    text = plan(day_forcing(read("points"), read("weather"), GRID, [D1, D2], "obs_id"))
    scans = [line for line in text.splitlines() if "/weather]" in line]
    assert sorted("PET" in line for line in scans) == [False, True]      # once for the values, once for cells and days
    assert all("GreaterThanOrEqual(dates" in line and "LessThanOrEqual(x" in line for line in scans)


def test_only_points_move_to_a_bucketed_history(spark, plan, tmp_path):
    pts = points(spark, [(1, i, 0.5, 0.5) for i in range(20)]).withColumn("state", F.expr(
        f"CAST(named_struct('swc', -point_id, 'soil', array(named_struct('W', 0.5D))) AS {STATE})"))
    run, asked = dt.date(2025, 1, 7), [D1, D2]
    history = spark.createDataFrame([(1, i, D1 - dt.timedelta(k * i % 9), (k, [(0.25,)])) for i in range(1, 15) for k in range(3)],
                                    f"province int, point_id long, state_date date, state {STATE}")
    daily, _ = materialise(st.latest_per_day(history, ["province", "point_id"], "state.swc"), "daily")
    write_state_history(daily.select("province", "point_id", "state_date", "state"), "bucketed_states", str(tmp_path / "s"), 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keys = ["province", "point_id"]
        moved = st.states_of_days(pts, spark.table("bucketed_states"), keys, asked, run, "state", one_a_day=True)
        text = plan(moved)
        assert text.count("Exchange hashpartitioning") == 1 and "SortAggregate" not in text
        requests = pts.select(*keys, F.col("state").alias("init"), F.explode(F.array(*[F.lit(d) for d in asked])).alias("date"))
        want = st.state_asof_window(requests, history, keys, run, F.col("init"), "state.swc", asked)
        key = lambda df: sorted((r["point_id"], r["date"], str(r["state_date"]), str(r["state"])) for r in df.collect())
        assert key(moved) == key(want)
        data = weather(spark, [(1, 0.5, 0.5, D1, 3.0), (2, 0.5, 0.5, D2, 3.0)])
        whole = plan(simulation_input(pts, data, spark.table("bucketed_states"), GRID, asked, run, "obs_id", one_a_day=True))
        assert whole.count("Exchange hashpartitioning") <= 3 and "SortAggregate" not in whole
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE bucketed_states")


def scanned_rows(df):
    """Rows the file scan handed on, from its metrics."""
    execution = df._jdf.queryExecution()
    execution.executedPlan().executeCollect()
    stack = [execution.executedPlan()]
    while stack:
        node = stack.pop()
        if node.getClass().getSimpleName() == "FileSourceScanExec":
            return node.metrics().apply("numOutputRows").value()
        children = node.children()
        stack.extend(children.apply(i) for i in range(children.size()))
    raise AssertionError("no scan")


def test_a_small_box_reads_few_row_groups(spark, tmp_path):
    rng = random.Random(9)
    rows = [(i, rng.uniform(0, 10000), rng.uniform(0, 10000), D1 if i % 4 else D2, 1.0) for i in range(24000)]
    area = GridSpec(0.0, 10000.0, 0.0, 10000.0, 100.0)
    write_weather(weather(spark, rows).coalesce(2), str(tmp_path / "w"), area, rows_per_group=500)
    source = read_weather(spark, str(tmp_path / "w"), T.StructType([T.StructField("obs_id", T.LongType())]))
    boxes = spark.createDataFrame([(1, 2000.0, 3500.0, 6000.0, 7500.0)], "province int, xmin double, xmax double, ymin double, ymax double")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = w.weather_bbox_scan(source, boxes, D1, D1)
        read = scanned_rows(found)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    want = sorted(i for i, x, y, d, _ in rows if d == D1 and 2000 <= x <= 3500 and 6000 <= y <= 7500)
    assert sorted(r["obs_id"] for r in found.collect()) == want
    assert len(want) <= read < 18000 / 4           # under a quarter of the day's rows leave the reader
    groups = [g for f in (tmp_path / "w" / f"dates={D1}").glob("*.parquet") for g in boxes_of_groups(f)]
    met = [g for g in groups if g[0] <= 3500 and g[1] >= 2000 and g[2] <= 7500 and g[3] >= 6000]
    assert len(groups) >= 36 and len(met) < len(groups) / 4


def boxes_of_groups(path):
    """(least x, largest x, least y, largest y) of each row group, from the footer."""
    footer = pq.ParquetFile(path).metadata
    for k in range(footer.num_row_groups):
        stats = {footer.row_group(k).column(c).path_in_schema: footer.row_group(k).column(c).statistics for c in range(footer.num_columns)}
        yield stats["x"].min, stats["x"].max, stats["y"].min, stats["y"].max


def test_places_along_the_curve(spark):
    area = GridSpec(0.0, 4.0, 0.0, 4.0, 1.0)
    df = spark.createDataFrame([(0.0, 0.0), (4.0, 0.0), (0.0, 4.0), (4.0, 4.0), (9.0, -9.0), (None, 1.0), (1.5, 2.5)], "x double, y double")
    got = [r[0] for r in df.select(morton(F.col("x"), F.col("y"), area)).collect()]
    assert got[:6] == [0, 0x55555555, 0xAAAAAAAA, 0xFFFFFFFF, 0x55555555, None] and 0xAAAAAAAA > got[6] > 0x55555555


@pytest.mark.parametrize("max_bytes", [10**9, 0])
def test_filled_rows_carry_the_figures_of_their_cell_and_day(spark, max_bytes):
    pts = w.with_cell(points(spark, [(1, 10, 0.5, 9.5), (1, 11, 1.5, 9.5), (1, 12, 50.0, 0.5)]), GRID)
    gridded = w.weather_on_grid(weather(spark, [(1, 0.5, 9.5, D1, 1.5), (2, 0.5, 9.5, D1, 2.0), (3, 0.5, 9.5, D1, None)]), GRID)
    rows = w.with_day_totals(fill(pts, gridded), max_bytes).collect()
    assert {(r["obs_id"], r["n_rows"], r["n_known"], r["sum_Precipitation"]) for r in rows if (r["cell"], r["dates"]) == (1, D1)} == {
        (1, 3, 2, 3.5), (2, 3, 2, 3.5), (3, 3, 2, 3.5)}
    fillers = [r for r in rows if r["obs_id"] is None]                       # two days of a cell and of no cell, one of the other
    assert len(rows) == 8 and len(fillers) == 5 and {(r["n_rows"], r["n_known"], r["sum_PET"]) for r in fillers} == {(1, 0, 0.0)}
