"""Input of a day's simulation: every point with its weather and its carried state."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymosaic.functions.sizing import MAX_BROADCAST_BYTES, materialise, small_side
from daymosaic.operators.calendar import assert_dates_present
from daymosaic.operators.state import states_of_days
from daymosaic.operators.weather import (
    cells_of, province_bbox, weather_bbox_scan, weather_gap_fill, weather_in_cells, weather_on_grid, weather_to_points, with_cell,
)
from daymosaic.schemas import GridSpec


def filled_weather(placed: DataFrame, weather: DataFrame, spec: GridSpec, dates: list[dt.date], row_id: str) -> DataFrame:
    """Weather rows of the cells of ``placed`` points on each of ``dates``, gaps filled: (cell, dates, ``row_id``, variables).

    Weather is cut to the days and the province boxes in the reader, and to cells with a point before anything moves. A
    day for which there is no weather at all stops the plan. Boxes and cells are few; they are written
    once, as several steps use them.
    """
    spark, days = placed.sparkSession, sorted(set(dates))
    asked = spark.range(1).select(F.explode(F.array(*[F.lit(d) for d in days])).alias("date"))
    observed = weather.where(F.col("dates").between(F.lit(days[0]), F.lit(days[-1]))).select(F.col("dates").alias("date"))
    materialise(assert_dates_present(asked, observed), "days")
    boxes, _ = materialise(province_bbox(placed), "boxes")
    cells, _ = materialise(cells_of(placed), "cells")
    near = weather_bbox_scan(weather, boxes, days[0], days[-1]).where(F.col("dates").isin(days))
    reduced = weather_in_cells(weather_on_grid(near, spec), cells, spec)
    return weather_gap_fill(cells, reduced, F.array(*[F.lit(d) for d in days]), row_id, spec.ncell * len(days))


def day_forcing(
    points: DataFrame, weather: DataFrame, spec: GridSpec, dates: list[dt.date], row_id: str, max_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """The weather rows of each point's cell on each of ``dates``; one row without values where there are none.

    ``operators.weather.weather_nest`` makes lists of them for a caller who wants lists.
    """
    placed = with_cell(points, spec)
    return weather_to_points(placed, filled_weather(placed, weather, spec, dates, row_id), filled=True, max_bytes=max_bytes)


def simulation_input(
    points: DataFrame, weather: DataFrame, history: DataFrame, spec: GridSpec, dates: list[dt.date], run_date: dt.date, row_id: str,
    order: str | None = None, one_a_day: bool = False, max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """``day_forcing`` with the state each point has at the start of the day, and that state's soil.

    ``points`` brings each point's initial ``state``, a struct with the field ``soil``; it is used where
    ``history`` has none. All its other columns stay. Points are joined to their states first, while there is one row a point
    and day: with a history bucketed by province and point (``writers.write_state_history``, which is ``one_a_day``)
    only the points move for that.
    """
    keys = ["province", "point_id"]
    placed = with_cell(points, spec)
    # one row a point and day; written, so that its size is known where it is joined to the weather
    stated, _ = materialise(states_of_days(placed, history, keys, dates, run_date, "state", order, one_a_day), "states")
    rows = filled_weather(placed.drop("state"), weather, spec, dates, row_id).withColumnsRenamed({"cell": "_cell", "dates": "_date"})
    same = F.col("cell").eqNullSafe(F.col("_cell")) & (F.col("date") == F.col("_date"))
    return rows.join(small_side(stated, max_bytes), same).withColumn("soil", F.col("state.soil")).drop("_cell", "_date")
