"""From observations to map layers and images."""

from __future__ import annotations

from pyspark.sql import DataFrame

from daymosaic.fixed_values import BLOCK_FACTOR, INDICATORS
from daymosaic.functions.sizing import small_side
from daymosaic.operators.imaging import image_table
from daymosaic.operators.raster import block_mean, by_day, grid_resample_bilinear, grid_scatter, lonlat_grid
from daymosaic.operators.weather import with_cell
from daymosaic.schemas import GridSpec


def point_layers(observations: DataFrame, points: DataFrame, spec: GridSpec, order: str) -> DataFrame:
    """One row per (date, cell); the cell is computed per point and joined by its id."""
    cells = with_cell(points, spec).select("point_id", "cell")
    placed = observations.join(small_side(cells), "point_id")
    return grid_scatter(placed, order)


def coarse_layers(
    observations: DataFrame, points: DataFrame, spec: GridSpec, order: str, factor: int = BLOCK_FACTOR
) -> DataFrame:
    """Blocks of ``factor`` x ``factor`` cells, each day in one partition.

    Two exchanges: observations meet by cell, aggregated before they move; cells then meet by day.
    """
    return block_mean(by_day(point_layers(observations, points, spec, order)), spec, factor)


def daily_images(
    observations: DataFrame, points: DataFrame, spec: GridSpec, order: str,
    ncol: int, nrow: int, factor: int = BLOCK_FACTOR,
) -> DataFrame:
    """Image rows of every (date, variable), on a longitude/latitude grid of ``ncol`` x ``nrow``."""
    coarse = spec.coarse(factor)
    target = lonlat_grid(coarse, ncol, nrow)
    layers = grid_resample_bilinear(
        coarse_layers(observations, points, spec, order, factor), coarse, target, INDICATORS
    )
    return image_table(layers, target)
