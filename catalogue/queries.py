"""The registered queries: each binds an operator or a plan to the input views."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogue.views import GRID, UTM_GRID, nested_results, polygons, view
from daymosaic.fixed_values import BLOCK_FACTOR, EXTRA_OUTPUTS, INDICATORS, WEATHER_VARS
from daymosaic.functions.colour import channel
from daymosaic.functions.geometry import rings_from_wkt, wkt_from_rings
from daymosaic.functions.grid import cell_number, column_index, row_index
from daymosaic.functions.projection import to_degrees, to_metres
from daymosaic.functions.sizing import materialise, shared_folder
from daymosaic.functions.text import (
    compact_date, date_in_name, last_part, partition_digits, state_path,
)
from daymosaic.operators import calendar, flatten, imaging, quality, raster, regions, runlog, state, weather
from daymosaic.plans import daily, forcing, maps, regional
from daymosaic.sources import ledger, readers, writers
from daymosaic.streaming import incremental

RUN_DATE = dt.date(2001, 8, 6)
FEW_DATES = [dt.date(2001, 7, 1), dt.date(2001, 8, 1)]
WEATHER_DAYS = (dt.date(2024, 1, 1), dt.date(2024, 1, 30))
BUCKET_CAPACITY = 20.0
BUCKET_START = 5.0
TARGET_COLS, TARGET_ROWS = 30, 30

QUERIES: dict = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def _whole(c: str, missing: int = -1) -> Column:
    return F.coalesce(F.col(c), F.lit(missing).cast("bigint")).alias(c)


def _clean_obs(spark, sf) -> DataFrame:
    return quality.qc_clean(view(spark, sf, "points_obs"))


def _days() -> Column:
    return F.sequence(*[F.lit(d) for d in WEATHER_DAYS])


def _day_list() -> list[dt.date]:
    return [WEATHER_DAYS[0] + dt.timedelta(i) for i in range((WEATHER_DAYS[1] - WEATHER_DAYS[0]).days + 1)]


def _runs(spark, sf) -> DataFrame:
    """The run five days after the last observation."""
    return view(spark, sf, "points_obs").agg(F.date_add(F.max("date"), 5).alias("run_date"))


def _window(spark, sf) -> DataFrame:
    return calendar.days_of_runs(_runs(spark, sf))


# --- sources and sinks ------------------------------------------------------------------------

def _write_days(spark, sf) -> str:
    """Indicator dataset in a new folder, one folder a day."""
    root = shared_folder(spark, "indicators")
    points = view(spark, sf, "points").select("point_id", "x", "y")
    rows = view(spark, sf, "points_obs").join(points, "point_id")
    rows = rows.withColumn("geometry", F.struct("x", "y")).drop("x", "y")
    writers.write_partitioned_day(rows, root, sort=["geometry.x", "geometry.y"])
    return root


@query
def scan_day_partition(spark: SparkSession, sf: str) -> DataFrame:
    day = readers.scan_day_partition(spark, _write_days(spark, sf), dt.date(2001, 7, 26))
    return day.select("geometry.x", "geometry.y", *INDICATORS)


@query
def write_partitioned_day(spark, sf):
    data = readers.read_indicators(spark, _write_days(spark, sf))
    return data.select("obs_id", "date", "year", "month", "day", *INDICATORS)


@query
def file_name_filter(spark, sf):
    return readers.file_name_filter(view(spark, sf, "input_files"))


@query
def file_discovery(spark, sf):
    """Result files by province and month, as the query writes them: all that are not left out, and those of one date."""
    root = shared_folder(spark, "files")
    name = F.concat(F.lit("province_"), (F.col("point_id") % 5 + 34).cast("string"), F.lit("_"), F.date_format("date", "yyyyMM01"))
    writers.write_folders(view(spark, sf, "points_obs").select("obs_id", name.alias("name")), root, ["name"])
    files = readers.file_name_filter(readers.list_files(spark, root, "*.parquet").where("size > 0"))
    found = readers.union_by_name(
        files.withColumn("asked", F.lit("all")), readers.files_of_date(files, compact_day(FEW_DATES[0])).withColumn("asked", F.lit("day")))
    return found.select("asked", F.regexp_extract("path", "name=([^/]*)/", 1).alias("name"), date_in_name(F.col("path")).alias("date")).distinct()


def compact_day(day: dt.date) -> str:
    return f"{day:%Y%m%d}"


@query
def partition_path(spark, sf):
    return writers.partition_paths(view(spark, sf, "points_obs"), "s3://bucket/")


@query
def point_layer_export(spark, sf):
    root = shared_folder(spark, "points")
    points = view(spark, sf, "points").select("point_id", "x", "y")
    rows = _clean_obs(spark, sf).join(points, "point_id").withColumn("internalWater", F.lit(1.0))
    writers.write_point_layer(writers.point_layer(rows, F.col("x"), F.col("y")), root)
    return spark.read.parquet(root).drop("year", "month", "day")


@query
def timeseries_publish(spark, sf):
    root = shared_folder(spark, "timeseries")
    means = regional.regional_series(
        view(spark, sf, "points_obs"), view(spark, sf, "points"), polygons(spark, sf)
    )
    writers.timeseries_publish(means, root)
    return spark.read.parquet(root)


@query
def state_checkpoint(spark, sf):
    root = shared_folder(spark, "state")
    daily = state.latest_per_day(view(spark, sf, "history"), ["point_id"], "state").withColumnRenamed("state_date", "date")
    provinces = view(spark, sf, "points").select("point_id", "province")
    writers.state_checkpoint(daily.join(provinces, "point_id"), root)
    return spark.read.parquet(root).select("province", "point_id", "date", "state")


@query
def regex_projection(spark, sf):
    obs = view(spark, sf, "points_obs")
    return readers.indicator_columns(obs)


@query
def union_by_name(spark, sf):
    return readers.union_by_name(
        view(spark, sf, "points_obs").select("obs_id", "Theta", "PET"),
        None,
        view(spark, sf, "water").select("PET", "Rain", "obs_id", "error"),
    )


# --- publishing -------------------------------------------------------------------------------

#: months whose files are delivered again, and a day that then fails as a whole
REPAIRED_MONTH, FAILED_MONTH, FAILED_DAY = "2001-04", "2001-05", dt.date(2001, 5, 10)
EARLIER_RUN = RUN_DATE - dt.timedelta(7)
FAILURE = "failed"


def _result_files(spark, sf) -> DataFrame:
    """Nested results with their point's place, as result files have it."""
    points = view(spark, sf, "points").selectExpr("point_id", "CAST(province AS INT) AS province", "x", "y")
    return nested_results(spark, sf).join(points, "point_id").withColumn("month", F.date_format("date", "yyyy-MM"))


def _published(spark, indicators, rejects) -> DataFrame:
    """What a reader of the datasets and of the ledger sees, in one table."""
    rows = ledger.read_published(spark, indicators).select(F.lit("row").alias("kind"), "obs_id", "date", *INDICATORS)
    failed = spark.read.parquet(rejects.root).select(F.lit("reject").alias("kind"), "obs_id", "date", "error")
    days = ledger.current_days(spark, indicators).select(
        F.lit("day").alias("kind"), F.col("day").alias("date"), "state", "accepted", "rejected", "seq")
    return readers.union_by_name(rows, failed, days)


@query
def publish_days(spark, sf):
    """Two runs a week apart, with a month repaired and a day failing as a whole in between, and a third that finds nothing to do."""
    source = shared_folder(spark, "results")
    indicators, rejects = daily.indicator_days(shared_folder(spark, "published")), daily.reject_days(shared_folder(spark, "rejects"))
    results = _result_files(spark, sf)

    def deliver(rows: DataFrame, failed: Column) -> None:
        flagged = rows.withColumn("error", F.when(failed, FAILURE).otherwise(F.col("error")))
        flagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(source)

    def run(date) -> None:
        delivered = spark.read.schema(results.schema).parquet(source).drop("month")
        daily.publish_days(spark, delivered, indicators, rejects, date)

    deliver(results, (F.col("month") == REPAIRED_MONTH) & (F.col("obs_id") % 5 == 0))
    run(EARLIER_RUN)
    deliver(results.where(F.col("month").isin(REPAIRED_MONTH, FAILED_MONTH)), F.col("date") == F.lit(FAILED_DAY))
    run(RUN_DATE)
    run(RUN_DATE)
    return _published(spark, indicators, rejects)


#: before it, a first delivery holds three of four results, and some of them as failures
SECOND_DELIVERY = dt.date(2001, 3, 1)


@query
def stream_days(spark, sf):
    """Two deliveries with a restart between: late rows, rows delivered again, and new days in the second."""
    source, log = shared_folder(spark, "arriving"), shared_folder(spark, "log")
    indicators, rejects = daily.indicator_days(shared_folder(spark, "published")), daily.reject_days(shared_folder(spark, "rejects"))
    results = _result_files(spark, sf).drop("month")
    early, late, again = F.col("date") < F.lit(SECOND_DELIVERY), F.col("obs_id") % 4 == 0, F.col("obs_id") % 10 == 3
    first = results.where(early & ~late).withColumn("error", F.when(again, FAILURE).otherwise(F.col("error")))
    for delivery in (first, results.where(~early | late | again)):
        delivery.write.mode("append").parquet(source)
        incremental.stream_days(spark, source, indicators, rejects, log, RUN_DATE, schema=results.schema, keys=("obs_id",))
    return _published(spark, indicators, rejects).drop("seq")


# --- dates, paths and names -------------------------------------------------------------------

@query
def date_window(spark, sf):
    counts = view(spark, sf, "points_obs").groupBy("date").agg(F.count(F.lit(1)).alias("n"))
    return _window(spark, sf).join(counts, "date", "left").select(
        "date", F.coalesce("n", F.lit(0)).alias("n_obs")
    )


@query
def pending_dates(spark, sf):
    processed = view(spark, sf, "points_obs").where(F.dayofmonth("date") % 3 != 0)
    return calendar.pending_dates(_window(spark, sf), processed)


@query
def missing_dates(spark, sf):
    points = view(spark, sf, "points").select("point_id", "province")
    observed = view(spark, sf, "points_obs").join(points, "point_id")
    return calendar.missing_dates(points, observed, RUN_DATE)


@query
def window_retention(spark, sf):
    return calendar.window_retention(view(spark, sf, "points_obs"), RUN_DATE).select("obs_id", "point_id", "date")


@query
def path_to_date(spark, sf):
    return view(spark, sf, "day_paths").select(
        "obs_id",
        partition_digits(F.col("uri")).alias("digits"),
        F.coalesce(date_in_name(F.col("file")).cast("string"), F.lit("none")).alias("file_date"),
    )


@query
def derive_state_path(spark, sf):
    path = state_path(F.col("init_file"), F.date_sub("date", 1), "outputs")
    return view(spark, sf, "day_paths").select("obs_id", path.alias("path"), last_part(path).alias("name"))


@query
def date_parts(spark, sf):
    day = F.date_sub("date", 1)
    return view(spark, sf, "points_obs").select(
        "obs_id", F.year("date").alias("year"), F.month("date").alias("month"), F.dayofmonth("date").alias("day"),
        day.alias("state_date"), compact_date(day).alias("state_text"),
        (F.col("date") < F.lit(RUN_DATE - dt.timedelta(385))).alias("too_old"),
    )


@query
def run_summary(spark, sf):
    return runlog.run_summary(view(spark, sf, "run_log"))


# --- flattening and cleaning ------------------------------------------------------------------

@query
def water_balance_columns(spark, sf):
    return flatten.water_balance_columns(view(spark, sf, "water")).select(
        "obs_id", "Precipitation", "PET", "AET", "ELW", *EXTRA_OUTPUTS
    )


@query
def soil_profile(spark, sf):
    # one number that sorts like (l_linenumber, l_partkey, l_suppkey)
    order = F.expr(
        "CAST(l_linenumber AS DECIMAL(2, 0)) * CAST(1e30 AS DECIMAL(31, 0))"
        " + CAST(l_partkey AS DECIMAL(15, 0)) * CAST(1e15 AS DECIMAL(16, 0)) + l_suppkey"
    )
    return flatten.soil_profile(view(spark, sf, "soil_layers"), ["obs_id"], order)


@query
def plant_weighted_means(spark, sf):
    observations = view(spark, sf, "points_obs").select("obs_id")
    return flatten.plant_weighted_means(view(spark, sf, "cohorts"), ["obs_id"], observations)


@query
def flatten_results(spark, sf):
    return flatten.flatten_results(nested_results(spark, sf))


@query
def qc_clean(spark, sf):
    return _clean_obs(spark, sf)


@query
def quarantine_split(spark, sf):
    good, bad = quality.quarantine_split(view(spark, sf, "water"))
    return readers.union_by_name(
        good.select(F.lit("indicators").alias("target"), "obs_id"),
        bad.select(F.lit("rejects").alias("target"), "obs_id", "error"),
    )


# --- weather ----------------------------------------------------------------------------------

def _placed(spark, sf) -> DataFrame:
    return weather.with_cell(view(spark, sf, "points"), GRID)


def _gridded(spark, sf) -> DataFrame:
    return weather.weather_on_grid(view(spark, sf, "weather"), GRID)


@query
def point_to_cell(spark, sf):
    x, y = F.col("x"), F.col("y")
    return view(spark, sf, "points").select(
        "point_id", row_index(y, GRID).alias("row"), column_index(x, GRID).alias("col"),
        cell_number(x, y, GRID).alias("cell"),
    ).select("point_id", _whole("row"), _whole("col"), _whole("cell"))


@query
def province_bbox(spark, sf):
    return weather.province_bbox(view(spark, sf, "points"))


@query
def weather_bbox_scan(spark, sf):
    """Over the weather as the library writes it."""
    root, boxes = shared_folder(spark, "weather"), weather.province_bbox(view(spark, sf, "points"))
    writers.write_weather(view(spark, sf, "weather").drop("station"), root, GRID)
    written = readers.read_weather(spark, root, T.StructType([T.StructField("obs_id", T.LongType())]))
    rows = weather.weather_bbox_scan(written, boxes, *WEATHER_DAYS)
    return rows.select("obs_id", "dates", "x", "y", *WEATHER_VARS)


@query
def weather_semi(spark, sf):
    rows = weather.weather_semi(_gridded(spark, sf), _placed(spark, sf), GRID)
    return rows.select("cell", "obs_id", "dates", *WEATHER_VARS)


@query
def cells_without_weather(spark, sf):
    lacking = weather.cells_without_weather(weather.cells_of(_placed(spark, sf)), _gridded(spark, sf), _days())
    return lacking.select(_whole("cell"), "dates")


@query
def weather_nest(spark, sf):
    """The lists, record by record."""
    nested = weather.weather_nest(weather.weather_semi(_gridded(spark, sf), _placed(spark, sf), GRID), ["cell"], "obs_id")
    return nested.select("cell", F.posexplode("meteo").alias("place", "m")).select(
        "cell", "place", "m.dates", *[F.col(f"m.{v}").alias(v) for v in WEATHER_VARS])


@query
def weather_gap_fill(spark, sf):
    cells = weather.cells_of(_placed(spark, sf))
    reduced = weather.weather_in_cells(_gridded(spark, sf), cells, GRID)
    filled = weather.weather_gap_fill(cells, reduced, _days(), "obs_id")
    return weather.with_day_totals(filled).withColumn("cell", _whole("cell"))


@query
def weather_to_points(spark, sf):
    found = forcing.day_forcing(view(spark, sf, "points"), view(spark, sf, "weather"), GRID, _day_list(), "obs_id")
    return found.select("point_id", "province", "dates", "obs_id", *WEATHER_VARS)


@query
def weather_coverage(spark, sf):
    return weather.weather_coverage(_placed(spark, sf), _gridded(spark, sf))


# --- state ------------------------------------------------------------------------------------

def _requests(spark, sf, dates) -> DataFrame:
    days = F.explode(F.array(*[F.lit(d) for d in dates]))
    return view(spark, sf, "points").select("point_id", days.alias("date"))


def _state_row(df: DataFrame) -> DataFrame:
    return df.select(
        "point_id", "date", F.coalesce(F.col("state_date").cast("string"), F.lit("initial")).alias("state_date"),
        "state",
    )


@query
def state_asof(spark, sf):
    found = state.state_asof(
        _requests(spark, sf, FEW_DATES), view(spark, sf, "history"), ["point_id"], FEW_DATES, RUN_DATE,
        F.lit(-1).cast("bigint"), order="state",
    )
    return _state_row(found)


#: twelve month starts, and one day so old that only the day before it may serve
MANY_DATES = [dt.date(2000, 7, 10)] + [dt.date(2000 + (m + 7) // 12, (m + 7) % 12 + 1, 1) for m in range(13)]


@query
def state_asof_window(spark, sf):
    found = state.state_asof_window(
        _requests(spark, sf, MANY_DATES), view(spark, sf, "history"), ["point_id"], RUN_DATE,
        F.lit(-1).cast("bigint"), order="state", dates=MANY_DATES,
    )
    return _state_row(found)


#: days asked for; the weather holds many others
SIMULATED = [dt.date(2024, 1, 5), dt.date(2024, 1, 12), dt.date(2024, 1, 13)]
SIMULATION_RUN = dt.date(2024, 1, 20)
#: puts the stored states before and between the simulated days
STATE_SHIFT = 8200
STATE_BUCKETS = 8


@query
def simulation_input(spark, sf):
    def with_soil(number: Column) -> Column:
        soil = F.array(*[F.struct(((number + k) % 64 / 64.0).alias("W")) for k in range(2)])
        return F.struct(number.alias("swc"), soil.alias("soil"))

    points = view(spark, sf, "points")
    initial = points.withColumn("state", with_soil(-F.col("point_id")))
    stored = state.latest_per_day(view(spark, sf, "history"), ["point_id"], "state").join(points.select("point_id", "province"), "point_id")
    table = f"state_history_{uuid.uuid4().hex[:12]}"
    writers.write_state_history(stored.select(
        "province", "point_id", F.date_add("state_date", STATE_SHIFT).alias("state_date"), with_soil(F.col("state")).alias("state"),
    ).where(F.col("state_date") >= F.lit(SIMULATION_RUN - dt.timedelta(400))), table, shared_folder(spark, "state-history"), STATE_BUCKETS)
    found = forcing.simulation_input(
        initial, view(spark, sf, "weather"), spark.table(table), GRID, SIMULATED, SIMULATION_RUN, "obs_id", one_a_day=True)
    return found.select(
        "point_id", "province", "date", F.coalesce(F.col("state_date").cast("string"), F.lit("initial")).alias("stored"),
        F.col("state.swc").alias("swc"), F.size("soil").cast("bigint").alias("layers"), F.col("soil")[0]["W"].alias("first_w"),
        F.col("soil")[1]["W"].alias("second_w"), "obs_id", *WEATHER_VARS)


def _bucket(f, spark, sf) -> DataFrame:
    daily = view(spark, sf, "points_obs").select("point_id", "date", "Precipitation", "AET", "PET")
    return f(daily, ["point_id"], F.col("Precipitation") / 8, F.col("AET") + F.col("PET") * 2, BUCKET_CAPACITY, BUCKET_START)


@query
def state_fold(spark, sf):
    return _bucket(state.state_fold, spark, sf)


@query
def state_trajectory(spark, sf):
    return _bucket(state.state_trajectory, spark, sf)


# --- regions ----------------------------------------------------------------------------------

@query
def admin_polygons_clean(spark, sf):
    return regions.admin_polygons_clean(polygons(spark, sf))


@query
def poly_daily_means(spark, sf):
    return regional.regional_series(
        view(spark, sf, "points_obs"), view(spark, sf, "points"), polygons(spark, sf)
    )


@query
def daily_means_filter(spark, sf):
    located, rows = materialise(regions.locate_points(view(spark, sf, "points"), regions.admin_polygons_clean(polygons(spark, sf))), "located")
    return regions.daily_means_filter(view(spark, sf, "points_obs"), located, located_rows=rows)


#: moves points off all borders, by more than DEGREE_TOLERANCE metres, so that projecting borders changes no point's polygon
OFF_BORDER = (0.3, 0.0137)
DEGREE_TOLERANCE = 1e-5


@query
def regional_degrees(spark, sf):
    """Means by polygons in degrees and points in metres: both are the usual ones as if in 1/100000 degree."""
    dx, dy = OFF_BORDER
    x, y = to_metres((F.col("x") + dx) / 100000 - 4, (F.col("y") + dy) / 100000 + 40)
    points = view(spark, sf, "points").select("province", "point_id", x.alias("x"), y.alias("y"))
    shapes = polygons(spark, sf).drop("wkt").join(_degree_polygons(spark, sf), ["admin_level", "polygon_id"])
    means = regional.regional_series(view(spark, sf, "points_obs"), points, shapes, degrees=True, tolerance=DEGREE_TOLERANCE)
    return means.drop("geom")


@query
def wkt_rings(spark, sf):
    shaped = polygons(spark, sf).selectExpr("*", f"{rings_from_wkt('wkt')} AS rings")
    return shaped.selectExpr(
        "admin_level", "polygon_id", f"{wkt_from_rings('rings')} AS wkt", "posexplode(rings)"
    ).select(
        "admin_level", "polygon_id", "wkt", F.col("pos").alias("ring"), F.size("col").alias("n_vertices"),
        F.aggregate("col", F.lit(0.0), lambda s, p: s + p["x"]).alias("sum_x"),
        F.aggregate("col", F.lit(0.0), lambda s, p: s + p["y"]).alias("sum_y"),
    )


def _degree_polygons(spark, sf) -> DataFrame:
    """The polygons as if their units were 1/100000 degree from (-4, 40)."""
    vertex = "concat_ws(' ', CAST(p.x / 100000D - 4D AS STRING), CAST(p.y / 100000D + 40D AS STRING))"
    rings = f"transform({rings_from_wkt('wkt')}, ring -> concat('(', array_join(transform(ring, p -> {vertex}), ', '), ')'))"
    return polygons(spark, sf).selectExpr(
        "admin_level", "polygon_id", f"concat('POLYGON (', array_join({rings}, ', '), ')') AS wkt"
    )


@query
def project_polygons(spark, sf):
    projected = regions.project_polygons(_degree_polygons(spark, sf))
    rings = projected.selectExpr("admin_level", "polygon_id", f"posexplode({rings_from_wkt('wkt')}) AS (ring, vertices)")
    return rings.selectExpr("admin_level", "polygon_id", "ring", "posexplode(vertices) AS (vertex, p)").selectExpr(
        "admin_level", "polygon_id", "ring", "vertex", "round(p.x, 3) AS x", "round(p.y, 3) AS y"
    )


# --- grid, colours and images -----------------------------------------------------------------

def _coarse(spark, sf) -> DataFrame:
    return maps.coarse_layers(_clean_obs(spark, sf), view(spark, sf, "points"), GRID, "obs_id")


def _pixels(spark, sf) -> DataFrame:
    return raster.coloured(raster.scaled_layers(_coarse(spark, sf)))


@query
def grid_scatter(spark, sf):
    return maps.point_layers(_clean_obs(spark, sf), view(spark, sf, "points"), GRID, "obs_id")


@query
def block_mean(spark, sf):
    return _coarse(spark, sf)


@query
def scaled_round(spark, sf):
    layers = view(spark, sf, "points_obs")
    thirds = [(F.col(v) / 3).alias(v) for v in ("Theta", "REW", "PET", "LAI")]
    scaled = raster.scaled_layers(layers.select("obs_id", *thirds), ("Theta", "REW", "PET", "LAI"))
    return scaled.withColumn("theta_back", F.col("Theta") / 1000)


@query
def unpivot_vars(spark, sf):
    return raster.unpivot_vars(view(spark, sf, "points_obs"), ["obs_id"])


@query
def var_ranges(spark, sf):
    return raster.var_ranges(raster.scaled_layers(_coarse(spark, sf)))


@query
def colour_ramp(spark, sf):
    return _pixels(spark, sf).where(F.col("var") != "Psi").select("date", "var", "row", "col", "value", "colour")


@query
def colour_ramp_psi(spark, sf):
    return _pixels(spark, sf).where(F.col("var") == "Psi").select("date", "row", "col", "value", "colour")


@query
def colour_lookup(spark, sf):
    return raster.colour_lookup(raster.scaled_layers(_coarse(spark, sf)))


@query
def colour_rgb(spark, sf):
    colours = _pixels(spark, sf).groupBy("colour").agg(F.count(F.lit(1)).alias("n_pixels"))
    return colours.select(
        "colour", "n_pixels", *[channel(F.col("colour"), i).alias(c) for i, c in enumerate(("red", "green", "blue"))]
    )


def _utm_points(spark, sf) -> DataFrame:
    points = view(spark, sf, "points")
    return points.withColumns({"x": F.col("x") + UTM_GRID.xmin, "y": F.col("y") + UTM_GRID.ymin})


@query
def project_tm(spark, sf):
    lon, lat = to_degrees(F.col("x"), F.col("y"))
    degrees = _utm_points(spark, sf).select("point_id", lon.alias("lon"), lat.alias("lat"))
    x, y = to_metres(F.col("lon"), F.col("lat"))
    return degrees.select(
        "point_id", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"),
        F.round(x, 3).alias("x"), F.round(y, 3).alias("y"),
    )


@query
def cell_lonlat(spark, sf):
    blocks = _coarse(spark, sf).groupBy("row", "col").agg(F.count(F.lit(1)).alias("n_days"))
    placed = raster.cell_lonlat(blocks, UTM_GRID.coarse(BLOCK_FACTOR))
    return placed.select("row", "col", "n_days", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"))


def _utm_layers(spark, sf):
    source = UTM_GRID.coarse(BLOCK_FACTOR)
    target = raster.lonlat_grid(source, TARGET_COLS, TARGET_ROWS)
    blocks = maps.coarse_layers(_clean_obs(spark, sf), _utm_points(spark, sf), UTM_GRID, "obs_id")
    return raster.grid_resample_bilinear(blocks, source, target), target


@query
def grid_resample_bilinear(spark, sf):
    layers, _ = _utm_layers(spark, sf)
    return layers.select("date", "row", "col", *[F.round(v, 4).alias(v) for v in INDICATORS])


@query
def image_legend(spark, sf):
    scaled = imaging.image_legend(_coarse(spark, sf), GRID.coarse(BLOCK_FACTOR))
    return scaled


@query
def image_table(spark, sf):
    layers, target = _utm_layers(spark, sf)
    return imaging.image_table(layers, target)


@query
def image_pixels(spark, sf):
    """Images of the coarse layers, encoded and decoded again."""
    return imaging.image_pixels(imaging.image_table(_coarse(spark, sf), GRID.coarse(BLOCK_FACTOR)))
