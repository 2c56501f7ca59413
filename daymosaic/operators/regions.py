"""Administrative polygons, the point-in-polygon join, and daily means by region."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymosaic.fixed_values import ADMIN_LEVELS, EXCLUDED_PROVINCES, INDICATORS
from daymosaic.functions.geometry import edges_of, rings_from_wkt, touches, wkt_with_rings
from daymosaic.functions.missing import nan_to_null
from daymosaic.functions.projection import to_metres
from daymosaic.functions.sizing import MAX_BROADCAST_BYTES, fits_broadcast, materialise, row_bytes, small_side, written

#: a cell with more edges is cut, but not more often than that
MAX_EDGES, MAX_DEPTH = 24, 14
#: points a task locates
POINTS_PER_TASK = 10_000


def admin_polygons_clean(polygons: DataFrame) -> DataFrame:
    """Polygons of the mapped territory, with the name and code columns of the output.

    A NULL province name is no reason to leave; a NULL code is, and at the
    municipio level a NULL name too. Provinces are named by their province name.
    """
    province = F.col("`ine.prov.name`")
    kept = polygons.where(
        F.coalesce(~province.isin(*EXCLUDED_PROVINCES), F.lit(True))
        & F.col("cpro").isNotNull()
        & ((F.col("admin_level") != "municipio") | F.col("name").isNotNull())
    )
    return kept.select(
        "admin_level", "polygon_id",
        F.when(F.col("admin_level") == "provincia", province).otherwise(F.col("name")).alias("name"),
        F.col("cpro").alias("province_code"), "wkt",
    )


def project_polygons(polygons: DataFrame, tolerance: float | None = None) -> DataFrame:
    """Boundaries in degrees turned into metres of the zone; the shape of the text is kept.

    A straight line in degrees is bent in metres. With a ``tolerance`` (metres) edges are cut into equal
    pieces first, as many as keep the bend of each below it: the bend falls with the square of their number.
    """
    def vertex(lon: Column, lat: Column) -> Column:
        x, y = to_metres(lon, lat)
        return F.struct(x.alias("x"), y.alias("y"))

    others = [f"`{c}`" for c in polygons.columns if c != "wkt"]
    parsed = polygons.selectExpr("*", f"{rings_from_wkt('wkt')} AS _rings")
    if tolerance is None:
        projected = parsed.withColumn("_rings", F.transform("_rings", lambda ring: F.transform(ring, lambda p: vertex(p["x"], p["y"]))))
    else:
        edges = F.expr("transform(_rings, ring -> zip_with(slice(ring, 1, greatest(size(ring) - 1, 0)), "
                       "slice(ring, 2, greatest(size(ring) - 1, 0)), (a, b) -> named_struct('a', a, 'b', b)))")

        def bend(edge: Column) -> Column:
            """How far the middle of an edge is from the middle of its projected ends; each end is projected once."""
            ends = F.array(vertex(edge["a"]["x"], edge["a"]["y"]), vertex(edge["b"]["x"], edge["b"]["y"]),
                           vertex((edge["a"]["x"] + edge["b"]["x"]) / 2, (edge["a"]["y"] + edge["b"]["y"]) / 2))
            return F.transform(F.array(ends), lambda e: F.hypot(
                e[2]["x"] - (e[0]["x"] + e[1]["x"]) / 2, e[2]["y"] - (e[0]["y"] + e[1]["y"]) / 2))[0]

        def counted(edge: Column) -> Column:
            n = F.greatest(F.lit(1), F.ceil(F.sqrt(bend(edge) / F.lit(float(tolerance)))).cast("int"))
            return F.struct(edge["a"].alias("a"), edge["b"].alias("b"), n.alias("n"))

        def along(edge: Column) -> Column:
            return F.transform(F.sequence(F.lit(0), edge["n"] - 1), lambda k: vertex(
                edge["a"]["x"] + (edge["b"]["x"] - edge["a"]["x"]) * k / edge["n"], edge["a"]["y"] + (edge["b"]["y"] - edge["a"]["y"]) * k / edge["n"]))

        def densified(ring_edges: Column, ring: Column) -> Column:
            last = F.element_at(ring, -1)
            return F.concat(F.flatten(F.transform(F.transform(ring_edges, counted), along)), F.array(vertex(last["x"], last["y"])))

        projected = parsed.withColumn("_edges", edges).withColumn("_rings", F.zip_with("_edges", "_rings", densified))
    return projected.selectExpr(*others, f"{wkt_with_rings('wkt', '_rings')} AS wkt")


def quadtree(box: np.ndarray, edges: np.ndarray, max_edges: int, max_depth: int):
    """Cells (exponent, column, row, flip, edges or None) that cover a polygon with ``edges`` (ax, ay, bx, by) and their ``box``es.

    A cell has sides of 2 ** exponent. Its edges are those that share its rows and do not lie wholly to its left: they decide
    for its points. Of those that do not pass it, the ones that cross all of its rows are on one side of all its
    points; only whether those to the right are odd in number is kept, as ``flip``. A cell is cut into four while more
    than ``max_edges`` edges pass it, or several times that many are left to decide. A cell no edge passes is
    decided here: it has no edges (None) or is left out.
    """
    if not len(edges):
        return
    low_x, low_y, high_x, high_y = box
    extent = max(high_x.max() - low_x.min(), high_y.max() - low_y.min())
    top = math.ceil(math.log2(extent)) if extent > 0 else 0
    side = 2.0 ** top
    stack = [(top, c, r, False, np.arange(len(edges)))
             for c in range(math.floor(low_x.min() / side), math.floor(high_x.max() / side) + 1)
             for r in range(math.floor(low_y.min() / side), math.floor(high_y.max() / side) + 1)]
    while stack:
        e, c, r, flip, own = stack.pop()
        side = 2.0 ** e
        x0, x1, y0, y1 = c * side, (c + 1) * side, r * side, (r + 1) * side
        own = own[(low_y[own] <= y1) & (high_y[own] >= y0) & (high_x[own] >= x0)]
        ax, ay, bx, by = edges[own].T
        # an edge passes when its box meets the cell and the corners, a little outside, are not all on one side of it
        wide = side * 1e-6
        turns = [(bx - ax) * (y - ay) - (by - ay) * (x - ax) for x in (x0 - wide, x1 + wide) for y in (y0 - wide, y1 + wide)]
        passing = (low_x[own] <= x1) & (np.minimum.reduce(turns) <= 0) & (np.maximum.reduce(turns) >= 0)
        x, y = (c + 0.5) * side, (r + 0.5) * side
        up = (ay > y) != (by > y)
        to_right = up & (x < (bx - ax) * (y - ay) / np.where(by == ay, 1.0, by - ay) + ax)
        across = ~passing & (low_y[own] <= y0) & (high_y[own] >= y1)
        flip ^= bool((across & to_right).sum() % 2)
        left, passes = own[~across], int(passing.sum())
        if not passes:
            if (int(flip) + int((~across & to_right).sum())) % 2:
                yield e, c, r, False, None
        elif (passes <= max_edges and len(left) <= 4 * max_edges) or e <= top - max_depth:
            yield e, c, r, flip, left
        else:
            stack.extend((e - 1, 2 * c + i, 2 * r + j, flip, left) for i in (0, 1) for j in (0, 1))


def polygon_cover(polygons: DataFrame, max_edges: int = MAX_EDGES, max_depth: int = MAX_DEPTH) -> DataFrame:
    """One row per polygon and cell of its quadtree: (admin_level, polygon_id, e, gx, gy, flip, whole, edges).

    Large shapes get large cells inside and small ones along their border only, whatever their
    level. Each polygon is cut by array operations in one task; a polygon is one row, so that is no more than it holds.
    """
    kind = polygons.schema["polygon_id"].dataType.simpleString()
    struct = pa.struct([(n, pa.float64()) for n in ("ax", "ay", "bx", "by")])
    names = ("admin_level", "polygon_id", "e", "gx", "gy", "flip", "whole", "edges")

    def cut(batches):
        for batch in batches:
            lists = batch.column(2)
            flat = lists.flatten()
            edges = np.stack([flat.field(i).to_numpy(zero_copy_only=False) for i in range(4)], axis=1)
            offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            for row in range(batch.num_rows):
                own = edges[offsets[row]: offsets[row + 1]]
                own = own[np.isfinite(own).all(axis=1)]
                ax, ay, bx, by = own.T
                box = np.stack([np.minimum(ax, bx), np.minimum(ay, by), np.maximum(ax, bx), np.maximum(ay, by)])
                cells = list(quadtree(box, own, max_edges, max_depth))
                n, at = len(cells), np.concatenate([np.zeros(0, np.int64), *[c[4] for c in cells if c[4] is not None]])
                ends = np.cumsum([0, *[0 if c[4] is None else len(c[4]) for c in cells]])
                values = pa.StructArray.from_arrays([pa.array(own[at, i]) for i in range(4)], fields=list(struct))
                whole = [c[4] is None for c in cells]
                columns = [pa.array([batch.column(i)[row].as_py()] * n, batch.column(i).type) for i in (0, 1)]
                columns += [pa.array([c[0] for c in cells], pa.int32()), *[pa.array([c[i] for c in cells], pa.int64()) for i in (1, 2)]]
                columns += [pa.array([c[3] for c in cells], pa.bool_()), pa.array(whole, pa.bool_()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values, mask=pa.array(whole, pa.bool_()))]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    edges_column = f"coalesce({edges_of(rings_from_wkt('wkt'))}, array()) AS edges"
    # a polygon file is one small split; covering large shapes is not one task's work
    spread = polygons.repartition("admin_level", "polygon_id")
    return spread.selectExpr("admin_level", "polygon_id", edges_column).mapInArrow(
        cut, f"admin_level string, polygon_id {kind}, e int, gx bigint, gy bigint, flip boolean, whole boolean, "
             "edges array<struct<ax: double, ay: double, bx: double, by: double>>")


def locate_points(
    points: DataFrame, polygons: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES, max_edges: int = MAX_EDGES, max_depth: int = MAX_DEPTH
) -> DataFrame:
    """(point_id, admin_level, polygon_id) for every polygon a point touches.

    Polygons are independent: a point on a shared border is in both. The cover is written once. The join is
    an equality on cells of the sizes that occur in it, broadcast while it is small; the
    exact test runs on the candidates. Points are located once, not once per day. Their places are written first: they may
    be costly to compute, and a file of points is a small split, so they are dealt to as many tasks as their number asks for.
    A point with a missing or infinite coordinate (NaN sorts above all) is nowhere.
    """
    cut = polygon_cover(polygons, max_edges, max_depth)
    cover, seen = written(cut, "cover", bytes=F.sum(row_bytes(cut)), sizes=F.collect_set(F.struct("admin_level", "e")))
    sizes = [(r["admin_level"], r["e"]) for r in seen["sizes"]]  # some sizes a level
    if not sizes:
        return points.join(cover.select("admin_level", "polygon_id"), F.lit(False)).select("point_id", "admin_level", "polygon_id")
    cells = ", ".join(f"named_struct('admin_level', '{level}', 'e', {e}, 'size', {2.0 ** e!r}D)" for level, e in sorted(sizes))
    finite = " AND ".join(f"{c} BETWEEN -1.7976931348623157E308D AND 1.7976931348623157E308D" for c in ("x", "y"))
    places, count = materialise(points.select("point_id", "x", "y"), "places")
    places = places.repartition(max(1, math.ceil(count / POINTS_PER_TASK)))
    placed = places.where(finite).selectExpr("point_id", "x", "y", f"inline(array({cells}))").selectExpr(
        "point_id", "x", "y", "admin_level", "e", "floor(x / size) AS gx", "floor(y / size) AS gy"
    )
    side = cover.hint("broadcast" if (seen["bytes"] or 0) <= max_bytes else "merge")
    candidates = placed.join(side, ["admin_level", "e", "gx", "gy"])
    return candidates.where("whole OR " + touches("edges", "x", "y", "CAST(flip AS INT)")).select(
        "point_id", "admin_level", "polygon_id"
    )


def poly_daily_means(
    observations: DataFrame, located: DataFrame, polygons: DataFrame,
    max_bytes: int = MAX_BROADCAST_BYTES, located_rows: int | None = None,
) -> DataFrame:
    """Mean of each indicator per polygon and day, all levels in one pass.

    Missing values are skipped; a polygon without points has no row. Grouped by
    the polygon's identifier, as names repeat. While ``located`` is small it is
    broadcast and the only shuffle carries partial means. Beyond that, the
    observations of a point and day are summed before they are shuffled to its
    polygons, so a point with very many rows arrives as one row a day.
    """
    keys = ["admin_level", "polygon_id", "date"]
    sums = [F.sum(nan_to_null(F.col(v))).alias(v) for v in INDICATORS]
    counts = [F.count(nan_to_null(F.col(v))).alias(f"_n_{v}") for v in INDICATORS]
    if fits_broadcast(located, max_bytes, located_rows, max(map(len, ADMIN_LEVELS))):
        totals = observations.select("point_id", "date", *INDICATORS).join(F.broadcast(located), "point_id").groupBy(*keys).agg(*sums, *counts)
    else:
        daily = observations.groupBy("point_id", "date").agg(*sums, *counts)
        totals = daily.join(located.hint("merge"), "point_id").groupBy(*keys).agg(
            *[F.sum(v).alias(v) for v in INDICATORS], *[F.sum(f"_n_{v}").alias(f"_n_{v}") for v in INDICATORS])
    means = totals.select(*keys, *[F.try_divide(v, F.col(f"_n_{v}").cast("double")).alias(v) for v in INDICATORS])
    attributes = polygons.select("admin_level", "polygon_id", "name", "province_code", "wkt")
    return means.join(attributes, ["admin_level", "polygon_id"]).select(
        "date", *INDICATORS, "name", "province_code", F.col("wkt").alias("geom"),
        "admin_level", "polygon_id",
    )


def daily_means_filter(observations: DataFrame, located: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES, located_rows: int | None = None) -> DataFrame:
    """Means by polygon and day with the SQL filter clause, which skips NaN (NULL is skipped anyway).

    The located points are broadcast while they are known or measured to be small.
    """
    side = small_side(located, max_bytes, located_rows, max(map(len, ADMIN_LEVELS)))
    return observations.join(side, "point_id").groupBy("admin_level", "polygon_id", "date").agg(*[
        F.expr(f"avg({v}) FILTER (WHERE NOT isnan({v}))").alias(v) for v in INDICATORS
    ])
