"""Map layers as sparse tables: (date, cell) rows, never a dense array."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daymosaic.fixed_values import BLOCK_FACTOR, INDICATORS, ROUNDING_FACTOR
from daymosaic.functions.colour import with_colour
from daymosaic.functions.grid import centre_x, centre_y, col_of_cell, row_of_cell
from daymosaic.functions.missing import mean_skip_missing, nan_to_null
from daymosaic.functions.projection import to_degrees, to_metres
from daymosaic.functions.sizing import MAX_BROADCAST_BYTES, small_side
from daymosaic.schemas import GridSpec


def grid_scatter(observations: DataFrame, order: str, variables=INDICATORS) -> DataFrame:
    """One row per (date, cell): of several observations the one with the highest ``order``.

    A missing value of that observation wins too. One ``max_by`` per variable
    keeps the aggregation buffers flat, so it runs as a hash aggregation.
    """
    return (
        observations.where(F.col("cell").isNotNull())
        .groupBy("date", "cell")
        .agg(*[F.max_by(v, order).alias(v) for v in variables])
    )


def by_day(layers: DataFrame) -> DataFrame:
    """``layers`` with each day in one partition, as blocks, pixels, ranges and images of a day are then made without moving again.

    A day has at most as many rows as the grid has cells, however many observations it had.
    """
    return layers.repartition("date")


def block_mean(
    layers: DataFrame, spec: GridSpec, factor: int = BLOCK_FACTOR, variables=INDICATORS
) -> DataFrame:
    """Mean of ``factor`` x ``factor`` cells, missing values skipped; only non-empty blocks."""
    row, col = row_of_cell(F.col("cell"), spec), col_of_cell(F.col("cell"), spec)
    return (
        layers.groupBy("date", F.floor(row / factor).alias("row"), F.floor(col / factor).alias("col"))
        .agg(*[mean_skip_missing(F.col(v)).alias(v) for v in variables])
    )


def scaled_round(c: Column, factor: int = ROUNDING_FACTOR) -> Column:
    """Value as a whole number of ``1 / factor``; half goes away from zero."""
    return F.round(c * F.lit(float(factor)))


def scaled_layers(layers: DataFrame, variables=INDICATORS) -> DataFrame:
    return layers.withColumns({v: scaled_round(F.col(v)) for v in variables})


def unpivot_vars(layers: DataFrame, ids, variables=INDICATORS) -> DataFrame:
    return layers.unpivot(list(ids), list(variables), "var", "value")


def var_ranges(layers: DataFrame, variables=INDICATORS) -> DataFrame:
    """Smallest and largest value per (date, variable), missing values skipped.

    Aggregated wide, one row per date, and turned long afterwards: the input is
    not multiplied by the number of variables.
    """
    present = [nan_to_null(F.col(v)) for v in variables]
    wide = layers.groupBy("date").agg(
        *[F.min(c).alias(f"_min_{v}") for v, c in zip(variables, present)],
        *[F.max(c).alias(f"_max_{v}") for v, c in zip(variables, present)],
    )
    rows = F.array(*[
        F.struct(
            F.lit(v).alias("var"),
            F.col(f"_min_{v}").alias("min_value"), F.col(f"_max_{v}").alias("max_value"),
        ) for v in variables
    ])
    return wide.select("date", F.inline(rows))


def with_ranges(layers: DataFrame, variables=INDICATORS) -> DataFrame:
    """Add the range of each variable's layer as ``_min_<variable>`` and ``_max_<variable>``.

    A window over the day, whose rows are limited by the grid: no second pass over what the
    layers were made from, and no exchange where they come partitioned by day.
    """
    day = Window.partitionBy("date")
    present = {v: nan_to_null(F.col(v)) for v in variables}
    return layers.withColumns({
        **{f"_min_{v}": F.min(c).over(day) for v, c in present.items()},
        **{f"_max_{v}": F.max(c).over(day) for v, c in present.items()},
    })


def _long_with_ranges(layers: DataFrame, ids, variables) -> DataFrame:
    """Rows (ids, var, value, min_value, max_value)."""
    each = F.array(*[F.struct(
        F.lit(v).alias("var"), F.col(v).alias("value"), F.col(f"_min_{v}").alias("min_value"), F.col(f"_max_{v}").alias("max_value"),
    ) for v in variables])
    return with_ranges(layers, variables).select(*ids, F.inline(each))


def coloured(layers: DataFrame, ids=("date", "row", "col"), variables=INDICATORS) -> DataFrame:
    """Rows (ids, var, value, colour, min_value, max_value) of wide layers."""
    return with_colour(_long_with_ranges(layers, ids, variables), "value", "min_value", "max_value", "var", "colour")


def colour_lookup(layers: DataFrame, variables=INDICATORS) -> DataFrame:
    """Colour table: the distinct values of each layer and their colours."""
    values = _long_with_ranges(layers, ["date"], variables).distinct()
    return with_colour(values, "value", "min_value", "max_value", "var", "colour").select("date", "var", "value", "colour")


def cell_lonlat(cells: DataFrame, spec: GridSpec) -> DataFrame:
    """Add longitude and latitude of the centre of (row, col)."""
    placed = cells.withColumns({
        "_x": centre_x(F.col("col"), spec), "_y": centre_y(F.col("row"), spec),
    })
    lon, lat = to_degrees(F.col("_x"), F.col("_y"))
    return placed.withColumns({"lon": lon, "lat": lat}).drop("_x", "_y")


def lonlat_grid(spec: GridSpec, ncol: int, nrow: int, samples: int = 64) -> GridSpec:
    """Square-celled longitude/latitude grid that covers ``spec``, at most ``ncol`` x ``nrow``.

    Its corner is given to nine decimals of a degree and its cells to twelve, so it does not hang on the last bits of a projection.
    """
    steps = [i / samples for i in range(samples + 1)]
    xs = [spec.xmin + s * (spec.xmax - spec.xmin) for s in steps]
    ys = [spec.ymin + s * (spec.ymax - spec.ymin) for s in steps]
    border = [(x, y) for x in xs for y in (spec.ymin, spec.ymax)]
    border += [(x, y) for y in ys for x in (spec.xmin, spec.xmax)]
    lons, lats = zip(*[to_degrees(x, y, math) for x, y in border])
    res = round(max((max(lons) - min(lons)) / ncol, (max(lats) - min(lats)) / nrow), 12)
    west, north = round(min(lons), 9), round(max(lats), 9)
    return GridSpec(west, west + ncol * res, north - nrow * res, north, res, "EPSG:4326")


def resample_weights(spark: SparkSession, source: GridSpec, target: GridSpec) -> DataFrame:
    """For each target pixel its up to four source cells and their bilinear weights.

    Depends on the two grids only; the same rows serve every date.
    """
    pixel = spark.range(1, target.ncell + 1).withColumnRenamed("id", "_pixel")
    placed = pixel.select(
        row_of_cell(F.col("_pixel"), target).alias("trow"),
        col_of_cell(F.col("_pixel"), target).alias("tcol"),
    ).withColumns({
        "_lon": centre_x(F.col("tcol"), target), "_lat": centre_y(F.col("trow"), target),
    })
    x, y = to_metres(F.col("_lon"), F.col("_lat"))
    placed = placed.withColumns({
        "_fx": (x - source.xmin) / source.resolution - 0.5,
        "_fy": (source.ymax - y) / source.resolution - 0.5,
    })
    placed = placed.withColumns({"_c": F.floor("_fx"), "_r": F.floor("_fy")})
    placed = placed.withColumns({"_wx": F.col("_fx") - F.col("_c"), "_wy": F.col("_fy") - F.col("_r")})
    corners = F.array(*[
        F.struct(
            (F.col("_r") + dr).alias("row"), (F.col("_c") + dc).alias("col"),
            ((F.col("_wy") if dr else 1 - F.col("_wy")) * (F.col("_wx") if dc else 1 - F.col("_wx"))).alias("weight"),
        ) for dr in (0, 1) for dc in (0, 1)
    ])
    return placed.select("trow", "tcol", F.inline(corners)).where(
        (F.col("weight") > 0)
        & F.col("row").between(0, source.nrow - 1) & F.col("col").between(0, source.ncol - 1)
    )


def grid_resample_bilinear(
    blocks: DataFrame, source: GridSpec, target: GridSpec, variables=INDICATORS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Layers on ``source`` (date, row, col) resampled to pixels of ``target``.

    Weights are renormalised over the source cells that hold a value. The
    weights table has four rows per pixel of the target grid.
    """
    weights = resample_weights(blocks.sparkSession, source, target)
    joined = blocks.join(small_side(weights, max_bytes, at_most_rows=4 * target.ncell), ["row", "col"])
    w = F.col("weight")

    def weighted(v: str) -> Column:
        value = nan_to_null(F.col(v))
        return F.try_divide(F.sum(w * value), F.sum(F.when(value.isNotNull(), w)))

    return (
        joined.groupBy("date", "trow", "tcol").agg(*[weighted(v).alias(v) for v in variables])
        .withColumnsRenamed({"trow": "row", "tcol": "col"})
    )
