"""Polygon boundaries as arrays: WKT text, edges, and the point-in-polygon test.

The expressions are SQL text, where array functions with nested lambdas read
most plainly. Arguments are SQL expressions too.
"""

from __future__ import annotations


def rings_from_wkt(wkt: str) -> str:
    """Rings of a POLYGON or MULTIPOLYGON text, all parts in one list."""
    return (
        f"transform(regexp_extract_all({wkt}, r'\\(([^()]+)\\)', 1), ring -> "
        "transform(transform(split(ring, ','), v -> split(trim(v), ' +')), xy -> "
        "named_struct('x', CAST(xy[0] AS DOUBLE), 'y', CAST(xy[1] AS DOUBLE))))"
    )


def wkt_from_rings(rings: str) -> str:
    """POLYGON text of one outer ring and its holes."""
    return (
        f"concat('POLYGON (', array_join(transform({rings}, ring -> concat('(', "
        "array_join(transform(ring, p -> concat_ws(' ', CAST(p.x AS STRING), CAST(p.y AS STRING))), ', '), "
        "')')), ', '), ')')"
    )


def wkt_with_rings(wkt: str, rings: str) -> str:
    """``wkt`` with its rings replaced by as many others; what is between them is kept."""
    ring_text = (
        "concat('(', array_join(transform(ring, p -> "
        "concat_ws(' ', CAST(p.x AS STRING), CAST(p.y AS STRING))), ', '), ')')"
    )
    return (
        f"array_join(zip_with(split({wkt}, r'\\([^()]+\\)'), transform({rings}, ring -> {ring_text}), "
        "(between, ring) -> concat(between, coalesce(ring, ''))), '')"
    )


def edges_of(rings: str) -> str:
    """Edges of all rings; every ring repeats its first vertex at the end."""
    return (
        f"flatten(transform({rings}, ring -> zip_with("
        "slice(ring, 1, greatest(size(ring) - 1, 0)), slice(ring, 2, greatest(size(ring) - 1, 0)), (a, b) -> "
        "named_struct('ax', a.x, 'ay', a.y, 'bx', b.x, 'by', b.y))))"
    )


def on_edge(x: str, y: str) -> str:
    """The point lies on edge ``e``: no turn, and inside the edge's own box."""
    return (
        f"((e.bx - e.ax) * ({y} - e.ay) - (e.by - e.ay) * ({x} - e.ax) = 0"
        f" AND {x} BETWEEN least(e.ax, e.bx) AND greatest(e.ax, e.bx)"
        f" AND {y} BETWEEN least(e.ay, e.by) AND greatest(e.ay, e.by))"
    )


def crosses_ray(x: str, y: str) -> str:
    """The ray from the point to the right crosses edge ``e`` (half-open in y)."""
    return (
        f"((e.ay > {y}) <> (e.by > {y})"
        f" AND {x} < (e.bx - e.ax) * ({y} - e.ay) / nullif(e.by - e.ay, 0D) + e.ax)"
    )


def touches(edges: str, x: str, y: str, more: str = "0") -> str:
    """The point is inside the polygon or on its boundary (even-odd over all rings); ``more`` edges are crossed besides.

    Both tests see only the edges that reach the point's height, which are picked once, by comparisons alone.
    """
    level = f"(e.ay <= {y} AND e.by >= {y}) OR (e.by <= {y} AND e.ay >= {y})"
    return (
        f"exists(array(filter({edges}, e -> {level})), near -> exists(near, e -> {on_edge(x, y)})"
        f" OR (size(filter(near, e -> {crosses_ray(x, y)})) + {more}) % 2 = 1)"
    )
