"""Daily means by region at all levels, in one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame

from daymosaic.functions.sizing import materialise
from daymosaic.operators.quality import qc_clean
from daymosaic.operators.regions import admin_polygons_clean, locate_points, poly_daily_means, project_polygons

#: metres a projected border may be off
TOLERANCE = 1.0


def regional_series(
    observations: DataFrame, points: DataFrame, polygons: DataFrame, clean: bool = True, degrees: bool = False, tolerance: float = TOLERANCE
) -> DataFrame:
    """Clean the observations, locate the points, average by (level, polygon, day).

    Points are in metres of the zone. Polygons are too, or in ``degrees``: they are then projected, their edges cut so
    that no border is off by more than ``tolerance``, and their geometry comes out projected. Where the points lie
    is computed once and kept as a table.
    """
    regions = admin_polygons_clean(polygons)
    if degrees:
        regions, _ = materialise(project_polygons(regions, tolerance), "regions")
    located, rows = materialise(locate_points(points, regions), "located")
    cleaned = qc_clean(observations) if clean else observations
    return poly_daily_means(cleaned, located, regions, located_rows=rows)
