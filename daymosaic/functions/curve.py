"""Places along a space-filling curve: rows near each other in it are near each other on the ground."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from daymosaic.schemas import GridSpec

#: bits of each coordinate
BITS = 16


def _spread(v: Column) -> Column:
    """The bits of a 16-bit number with a gap after each."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask).cast("bigint"))
    return v


def morton(x: Column, y: Column, spec: GridSpec) -> Column:
    """Place of (x, y) along the Morton curve over the area of ``spec``; outside it, that of the nearest border.

    Missing coordinates come first, NaN last.
    """
    def cell(c: Column, low: float, high: float) -> Column:
        share = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (c - F.lit(float(low))) / F.lit(float(high - low))))
        return F.when(c.isNotNull(), F.floor(share * F.lit(float((1 << BITS) - 1))))

    return _spread(cell(x, spec.xmin, spec.xmax)).bitwiseOR(F.shiftleft(_spread(cell(y, spec.ymin, spec.ymax)), 1))
