"""Grid arithmetic: the cell of a point is computed, never looked up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from daymosaic.schemas import GridSpec


def column_index(x: Column, spec: GridSpec) -> Column:
    """0-based column; the right border belongs to the last column; NULL outside."""
    inside = (x >= spec.xmin) & (x <= spec.xmax)
    at = F.floor((x - F.lit(float(spec.xmin))) / F.lit(float(spec.resolution)))
    return F.when(inside, F.least(at, F.lit(spec.ncol - 1).cast("bigint")))


def row_index(y: Column, spec: GridSpec) -> Column:
    """0-based row from the top; the lower border belongs to the last row; NULL outside."""
    inside = (y >= spec.ymin) & (y <= spec.ymax)
    at = F.floor((F.lit(float(spec.ymax)) - y) / F.lit(float(spec.resolution)))
    return F.when(inside, F.least(at, F.lit(spec.nrow - 1).cast("bigint")))


def cell_number(x: Column, y: Column, spec: GridSpec) -> Column:
    """1-based cell; NULL outside the grid and for missing coordinates."""
    return row_index(y, spec) * F.lit(spec.ncol).cast("bigint") + column_index(x, spec) + 1


def row_of_cell(cell: Column, spec: GridSpec) -> Column:
    return F.floor((cell - 1) / spec.ncol)


def col_of_cell(cell: Column, spec: GridSpec) -> Column:
    return (cell - 1) % spec.ncol


def centre_x(col: Column, spec: GridSpec) -> Column:
    return F.lit(float(spec.xmin)) + (col + F.lit(0.5).cast("double")) * F.lit(float(spec.resolution))


def centre_y(row: Column, spec: GridSpec) -> Column:
    return F.lit(float(spec.ymax)) - (row + F.lit(0.5).cast("double")) * F.lit(float(spec.resolution))
