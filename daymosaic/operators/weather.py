"""Gridded weather joined to points.

Weather is the large side. It is reduced to cells that hold a point before anything else and stays flat, one row a
record, up to the edge: a cell and day with a third of all weather is many rows, never one list in one task.
Cells and days without weather come in as filler rows. Points come to them as lists of a cell, broadcast when they are
small; then weather moves only to be spread over as many tasks as the result needs, few cells to a task. Lists of weather
are made last, by who wants them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymosaic.fixed_values import HULL_MARGIN, WEATHER_UNUSED, WEATHER_VARS
from daymosaic.functions.grid import cell_number
from daymosaic.functions.sizing import (
    MAX_BROADCAST_BYTES, PAIRS_PER_TASK, materialise, row_bytes, side_by_side, small_side, spread_by_pairs, written,
)
from daymosaic.schemas import GridSpec

#: blocks per side of the area when there are more
BOX_BLOCKS = 64

#: points a list of a cell's points has about at most
POINTS_PER_LIST = 512

#: lists that are cut from points gathered at once
LISTS_AT_ONCE = 16


def with_cell(points: DataFrame, spec: GridSpec) -> DataFrame:
    """Add the cell of (x, y); NULL outside the grid."""
    return points.withColumn("cell", cell_number(F.col("x"), F.col("y"), spec))


def weather_on_grid(weather: DataFrame, spec: GridSpec) -> DataFrame:
    """Weather rows with their cell, without unused columns and rows outside the grid.

    A NULL cell never matches a point, so those rows are dropped up front.
    """
    return with_cell(weather.drop(*WEATHER_UNUSED), spec).where(F.col("cell").isNotNull())


def province_bbox(points: DataFrame, margin: float = HULL_MARGIN) -> DataFrame:
    """Bounding box of every province's points, widened by ``margin``."""
    return points.groupBy("province").agg(
        (F.min("x") - margin).alias("xmin"), (F.max("x") + margin).alias("xmax"),
        (F.min("y") - margin).alias("ymin"), (F.max("y") + margin).alias("ymax"),
    )


def weather_bbox_scan(weather: DataFrame, boxes: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Weather of [first, last] inside a province box.

    The days and the box around all provinces are range predicates the reader can
    push; the single boxes are tested through an equality join on coarse blocks.
    """
    days = weather.where(F.col("dates").between(F.lit(first), F.lit(last)))
    around = boxes.agg(
        F.min("xmin").alias("xmin"), F.max("xmax").alias("xmax"), F.min("ymin").alias("ymin"), F.max("ymax").alias("ymax")
    ).first()
    if around["xmin"] is None:
        return days.where(F.lit(False))
    size = max(around["xmax"] - around["xmin"], around["ymax"] - around["ymin"]) / BOX_BLOCKS
    blocks = boxes.selectExpr(
        "xmin", "xmax", "ymin", "ymax",
        f"explode(sequence(floor(xmin / {size!r}D), floor(xmax / {size!r}D))) AS _gx",
    ).selectExpr("*", f"explode(sequence(floor(ymin / {size!r}D), floor(ymax / {size!r}D))) AS _gy")
    placed = days.where(_in_box(around)).withColumns({
        "_bx": F.floor(F.col("x") / F.lit(size)), "_by": F.floor(F.col("y") / F.lit(size)),
    })
    in_one = (
        (F.col("_bx") == F.col("_gx")) & (F.col("_by") == F.col("_gy"))
        & F.col("x").between(F.col("xmin"), F.col("xmax")) & F.col("y").between(F.col("ymin"), F.col("ymax"))
    )
    return placed.join(small_side(blocks), in_one, "left_semi").drop("_bx", "_by")


def _in_box(b) -> Column:
    return F.col("x").between(b["xmin"], b["xmax"]) & F.col("y").between(b["ymin"], b["ymax"])


def cells_of(points: DataFrame) -> DataFrame:
    """The cells that hold a point, once each; points outside the grid share the NULL cell."""
    return points.select("cell").distinct()


def weather_in_cells(weather: DataFrame, cells: DataFrame, spec: GridSpec) -> DataFrame:
    """Weather rows of ``cells``, which has each cell once and so at most as many as the grid."""
    return weather.join(small_side(cells.where(F.col("cell").isNotNull()), at_most_rows=spec.ncell), "cell", "left_semi")


def weather_semi(weather: DataFrame, points: DataFrame, spec: GridSpec) -> DataFrame:
    """Weather rows whose cell holds a point."""
    return weather_in_cells(weather, cells_of(points), spec)


def wanted_days(cells: DataFrame, dates: Column) -> DataFrame:
    """(cell, dates) for which points need weather."""
    return cells.withColumn("dates", F.explode(dates))


def cells_without_weather(
    cells: DataFrame, weather: DataFrame, dates: Column, at_most_rows: int | None = None, max_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """(cell, day) of ``cells`` without weather on one of ``dates`` (an array); the NULL cell never has any.

    Only the keys of the weather are read, and made distinct before they move. ``at_most_rows`` bounds how many there can be.
    """
    seen = weather.select("cell", "dates").distinct()
    if at_most_rows is not None:
        seen = small_side(seen, max_bytes, at_most_rows)
    return wanted_days(cells, dates).join(seen, ["cell", "dates"], "left_anti")


def weather_gap_fill(
    cells: DataFrame, weather: DataFrame, dates: Column, row_id: str, at_most_rows: int | None = None, max_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """Weather rows (cell, dates, ``row_id``, variables), and a row that is NULL but for cell and day where there are none."""
    rows = weather.select("cell", "dates", row_id, *WEATHER_VARS)
    return rows.unionByName(cells_without_weather(cells, weather, dates, at_most_rows, max_bytes), allowMissingColumns=True)


def with_day_totals(rows: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Each of ``rows`` with the figures of the list its cell and day make: ``n_rows``, ``n_known`` and a sum per variable.

    Rows are counted and summed where they lie and before anything moves, so a cell and day with very many of them is a
    row a task, never a list. A filler counts as one row of which nothing is known.
    """
    totals, count = materialise(rows.groupBy(F.col("cell").alias("_cell"), F.col("dates").alias("_dates")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("Precipitation").alias("n_known"),
        *[F.coalesce(F.sum(v), F.lit(0.0)).alias(f"sum_{v}") for v in WEATHER_VARS]), "day-totals")
    same = F.col("cell").eqNullSafe(F.col("_cell")) & F.col("dates").eqNullSafe(F.col("_dates"))
    return rows.join(small_side(totals, max_bytes, count), same).drop("_cell", "_dates")


def points_of_cells(points: DataFrame, per_cell: DataFrame) -> DataFrame:
    """Points as lists (cell, _list, _points), as many of a cell as keep each at about ``POINTS_PER_LIST``.

    ``per_cell`` has each cell (``_cell``) once with its number of points, ``partners``. Points are gathered by a hash of
    their values, which makes a retried task gather the same points again; copies of a point meet. Lists cut from them have
    equal lengths but for the last one, multiples of 8: Parquet packs values by eights, and a list that fills them repeats to the byte.
    """
    same_cell = F.col("cell").eqNullSafe(F.col("_cell"))
    groups = F.ceil(F.col("partners") / F.lit(POINTS_PER_LIST * LISTS_AT_ONCE))
    gathered = (
        points.join(per_cell, same_cell)
        .groupBy("cell", F.pmod(F.xxhash64(*points.columns), groups).alias("_group"))
        .agg(F.collect_list(F.struct(*[c for c in points.columns if c != "cell"])).alias("_all"))
    )
    lists = F.ceil(F.size("_all") / F.lit(POINTS_PER_LIST))
    length = (F.ceil(F.size("_all") / lists / F.lit(8)) * F.lit(8)).cast("int")
    cut = F.transform(F.sequence(F.lit(1), F.size("_all"), length), lambda first: F.slice("_all", first, length))
    return gathered.select("cell", "_group", F.posexplode(cut).alias("_place", "_points")).select(
        "cell", F.concat_ws("/", "_group", "_place").alias("_list"), "_points")


def weather_to_points(
    points: DataFrame, rows: DataFrame, filled: bool = False, max_bytes: int = MAX_BROADCAST_BYTES, pairs_per_task: int = PAIRS_PER_TASK
) -> DataFrame:
    """Every point with the weather rows of its cell; NULL where there is none.

    An inner join with the points of a cell as lists. Its result is all their pairs, so its work is counted in pairs: the
    weather stays where it is while they are few, and is spread over tasks of about ``pairs_per_task`` otherwise. A task
    takes list after list, and with each all its weather: the result has a row for each pair, but written in columns it
    is runs of weather and repeats of a list, and takes little more room for more points. With more than ``max_bytes`` of
    points both sides are shuffled, and a cell with much of the data can be split on either side. Points that found
    nothing are added, unless the rows are ``filled`` and every point finds some.
    """
    columns = [*points.columns, *[c for c in rows.columns if c != "cell"]]
    rows = rows.withColumnRenamed("cell", "_cell")
    same_cell = F.col("cell").eqNullSafe(F.col("_cell"))
    counted, cells = materialise(
        points.groupBy(F.col("cell").alias("_cell")).agg(F.count(F.lit(1)).alias("partners")), "points-per-cell")
    lists = points_of_cells(points, small_side(counted, max_bytes, cells))
    lists, seen = written(lists, "points-of-cells", bytes=F.sum(row_bytes(lists)))
    if (seen["bytes"] or 0) <= max_bytes:
        moved = spread_by_pairs(rows, small_side(counted, max_bytes, cells), "_cell", pairs_per_task)
        numbers = lists.select("cell", F.col("_list").alias("_number"))
        meetings = side_by_side(moved.join(numbers.hint("broadcast"), same_cell).drop("cell"), "_cell", "_number")
        met = meetings.join(lists.hint("broadcast"), same_cell & (F.col("_number") == F.col("_list")))
    else:
        met = rows.join(lists.hint("merge"), same_cell)
    matched = met.select(F.inline("_points"), "cell", *columns[len(points.columns):]).select(*columns)
    if filled:
        return matched
    lonely = points.join(rows.select("_cell").distinct(), same_cell, "left_anti")
    return matched.unionByName(lonely, allowMissingColumns=True)


def weather_nest(rows: DataFrame, keys, row_id: str, parts: int = 1) -> DataFrame:
    """Weather rows of each key and day as lists of records in order, numbered by ``part`` from 0 to ``parts - 1``.

    For the edge: what reads the result wants lists. Their number is the caller's and the same for all keys and days,
    whatever their size. A row's part comes from its own identifier, which makes a retried task assign
    the same rows again. Every task first gathers its own rows of a list, so a list meets as one run a task.
    """
    record = F.struct("dates", *WEATHER_VARS)
    part = F.pmod(F.xxhash64(row_id), F.lit(parts).cast("bigint"))
    return rows.groupBy(*keys, "dates", part.alias("part")).agg(F.sort_array(F.collect_list(record)).alias("meteo"))


def weather_coverage(points: DataFrame, weather: DataFrame) -> DataFrame:
    """Per province: points, distinct cells, cells with weather, and whether all have it."""
    with_weather = weather.select("cell").distinct().withColumn("_w", F.lit(1))
    return (
        points.groupBy("province", "cell").agg(F.count(F.lit(1)).alias("_points"))
        .join(with_weather, "cell", "left")
        .groupBy("province").agg(
            F.sum("_points").alias("n_points"),
            F.count("cell").alias("n_cells"),
            F.count("_w").alias("n_cells_with_weather"),
        )
        .withColumn("complete", F.col("n_cells") == F.col("n_cells_with_weather"))
    )
