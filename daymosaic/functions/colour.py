"""Continuous colour ramps, interpolated in CIELAB.

The conversion is staged over several projections: each stage refers to the
columns of the one before, so the expression tree stays small and the optimiser
does not inline expensive terms more than once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymosaic.fixed_values import (
    EVEN_BREAKS, MISSING_COLOUR, PSI_BREAKS, RAMP_COLOURS, REVERSED_RAMPS,
)

# sRGB primaries and D65 white of the colour space definition.
RGB_TO_XYZ = (
    (0.4124564, 0.3575761, 0.1804375),
    (0.2126729, 0.7151522, 0.0721750),
    (0.0193339, 0.1191920, 0.9503041),
)
XYZ_TO_RGB = (
    (3.2404542, -1.5371385, -0.4985314),
    (-0.9692660, 1.8760108, 0.0415560),
    (0.0556434, -0.2040259, 1.0572252),
)
WHITE = (0.95047, 1.0, 1.08883)
LAB_EPSILON = 216 / 24389
LAB_KAPPA = 24389 / 27


def hex_to_lab(colour: str) -> tuple[float, float, float]:
    """CIELAB of ``#RRGGBB``; used for the nine anchors only."""
    def linear(channel: float) -> float:
        return channel / 12.92 if channel <= 0.04045 else ((channel + 0.055) / 1.055) ** 2.4

    rgb = [linear(int(colour[i:i + 2], 16) / 255) for i in (1, 3, 5)]
    f = []
    for weights, white in zip(RGB_TO_XYZ, WHITE):
        t = sum(w * c for w, c in zip(weights, rgb)) / white
        f.append(t ** (1 / 3) if t > LAB_EPSILON else (LAB_KAPPA * t + 16) / 116)
    return 116 * f[1] - 16, 500 * (f[0] - f[1]), 200 * (f[1] - f[2])


def _array(values) -> str:
    return "array(" + ", ".join(f"{float(v)!r}D" for v in values) + ")"


def _between_anchors(anchors) -> str:
    start = f"element_at({_array(anchors)}, _seg)"
    return f"{start} + (element_at({_array(anchors)}, _seg + 1) - {start}) * _w"


def _tristimulus(f: str, white: float) -> str:
    cube = f"{f} * {f} * {f}"
    return f"{white!r}D * CASE WHEN {cube} > {LAB_EPSILON!r}D THEN {cube} ELSE (116D * {f} - 16D) / {LAB_KAPPA!r}D END"


def _byte(c: str) -> str:
    gamma = f"CASE WHEN {c} <= 0.0031308D THEN {c} * 12.92D ELSE 1.055D * pow({c}, {1 / 2.4!r}D) - 0.055D END"
    return f"CAST(round(greatest(0D, least(1D, {gamma})) * 255D) AS INT)"


def ramp_position(value: str, low: str, high: str, reversed_ramp: str) -> str:
    """Place in [0, 1] of the ramp; a reversed one runs the other way. A missing value has none, in a flat layer too."""
    share = f"CASE WHEN {value} IS NULL OR isnan({value}) THEN NULL WHEN {high} = {low} THEN 0.5D ELSE ({value} - {low}) / nullif({high} - {low}, 0D) END"
    return f"CASE WHEN {reversed_ramp} THEN 1D - ({share}) ELSE {share} END"


def is_reversed(var: str) -> str:
    return f"{var} IN (" + ", ".join(f"'{v}'" for v in REVERSED_RAMPS) + ")"


def with_rgb(df: DataFrame, position: str, psi: str, out: str) -> DataFrame:
    """Append the ramp colour at ``position`` in [0, 1] as one number, red first; NULL without a position.

    ``psi`` is a condition: variable ``Psi`` has its own break points.
    """
    lab = list(zip(*[hex_to_lab(c) for c in RAMP_COLOURS]))
    # segment 1..8: one more than the number of inner breaks not beyond the position
    segment = " + ".join(
        ["1"] + [f"CAST({position} >= element_at(_breaks, {k}) AS INT)" for k in range(2, len(RAMP_COLOURS))]
    )
    stages = [
        {"_breaks": f"CASE WHEN {psi} THEN {_array(PSI_BREAKS)} ELSE {_array(EVEN_BREAKS)} END"},
        {"_seg": segment},
        {"_w": f"({position} - element_at(_breaks, _seg)) / (element_at(_breaks, _seg + 1) - element_at(_breaks, _seg))"},
        {name: _between_anchors(anchors) for name, anchors in zip(("_l", "_a", "_b"), lab)},
        {"_fy": "(_l + 16D) / 116D", "_fx": "(_l + 16D) / 116D + _a / 500D", "_fz": "(_l + 16D) / 116D - _b / 200D"},
        {name: _tristimulus(f, white) for name, f, white in zip(("_x", "_y", "_z"), ("_fx", "_fy", "_fz"), WHITE)},
        {
            name: " + ".join(f"{w!r}D * {c}" for w, c in zip(weights, ("_x", "_y", "_z")))
            for name, weights in zip(("_lr", "_lg", "_lb"), XYZ_TO_RGB)
        },
        {out: f"CASE WHEN {position} IS NOT NULL AND NOT isnan({position}) "
              f"THEN ({_byte('_lr')} * 256 + {_byte('_lg')}) * 256 + {_byte('_lb')} END"},
    ]
    keep = df.columns
    for stage in stages:
        df = df.selectExpr("*", *[f"{e} AS {name}" for name, e in stage.items()])
    return df.select(*keep, out)


def with_colour(df: DataFrame, value: str, low: str, high: str, var: str, out: str) -> DataFrame:
    """Append the ramp colour of ``value`` in its domain [low, high] as ``#RRGGBB``.

    Variable ``Psi`` uses its own break points. A missing value gets the
    transparent colour.
    """
    placed = df.selectExpr("*", f"{ramp_position(value, low, high, is_reversed(var))} AS _t")
    numbered = with_rgb(placed, "_t", f"{var} = 'Psi'", "_rgb")
    return numbered.selectExpr(
        *[f"`{c}`" for c in df.columns], f"coalesce('#' || lpad(hex(_rgb), 6, '0'), '{MISSING_COLOUR}') AS {out}")


def channel(colour: Column, index: int) -> Column:
    """Channel 0 (red), 1 (green) or 2 (blue) of ``#RRGGBB[AA]``."""
    return F.conv(F.substring(colour, 2 + 2 * index, 2), 16, 10).cast("int")
