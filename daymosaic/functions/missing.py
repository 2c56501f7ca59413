"""NULL and NaN bookkeeping.

Indicator columns hold both NULL (not available) and NaN (undefined), and the
cleaning rules tell them apart. These helpers are the only place where that
difference is spelled out; no other module calls bare ``avg``, ``least``,
``greatest`` or ``/`` on an indicator.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def null_double() -> Column:
    return F.lit(None).cast("double")


def is_missing(c: Column) -> Column:
    return c.isNull() | F.isnan(c)


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def clamp01(c: Column) -> Column:
    """Limit to [0, 1]; missing stays missing (``least`` and ``greatest`` would skip it)."""
    return F.when(~is_missing(c), F.greatest(F.lit(0.0), F.least(F.lit(1.0), c)))


def ratio_or_nan(num: Column, den: Column) -> Column:
    """``num / den`` of two sums in which nothing counts as 0; NaN where ``den`` is 0."""
    num, den = F.coalesce(num, F.lit(0.0)), F.coalesce(den, F.lit(0.0))
    return F.when(den == 0, F.lit(float("nan"))).otherwise(num / den)


def ratio_or_null(num: Column, den: Column) -> Column:
    return F.when(den != 0, num / den)


def mean_skip_missing(c: Column) -> Column:
    """Mean of the values that are neither NULL nor NaN; NULL when there is none."""
    return F.avg(nan_to_null(c))


def sum_unless_missing(c: Column) -> Column:
    """Sum that is NULL as soon as one value of the group is missing."""
    present = nan_to_null(c)
    return F.when(F.count(present) == F.count(F.lit(1)), F.sum(present))


def not_listed(c: Column, values) -> Column:
    """``NOT IN`` that keeps NULL."""
    return F.coalesce(~c.isin(*values), F.lit(True))
