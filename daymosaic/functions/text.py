"""Paths, names and dates inside them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from daymosaic.fixed_values import INITIAL_FOLDER, INITIAL_MARK


def pad2(c: Column) -> Column:
    """Pad to two digits on the left; unlike bare ``lpad`` longer text is kept whole."""
    return F.lpad(c, F.greatest(F.lit(2), F.length(c)), F.lit("0"))


def partition_digits(path: Column) -> Column:
    """``.../year=2025/month=3/day=7/`` -> ``20250307``; NULL where a folder is not there.

    Folders are found by name: another one with a ``=`` in its name may be anywhere in the path.
    """
    numbers = [F.nullif(F.regexp_extract(path, f"(?:^|/){name}=([0-9]+)(?:/|$)", 1), F.lit("")) for name in ("year", "month", "day")]
    return F.concat(*[pad2(n) for n in numbers])


def date_in_name(path: Column) -> Column:
    """First run of eight digits as a date; NULL where there is none or it is no date."""
    return F.try_to_date(F.nullif(F.regexp_extract(path, "[0-9]{8}", 0), F.lit("")), "yyyyMMdd")


def partition_uri(root: str, date: Column) -> Column:
    """Folder of a day below ``root``, month and day unpadded."""
    return F.format_string(
        root.replace("%", "%%") + "year=%d/month=%d/day=%d/",
        F.year(date), F.month(date), F.dayofmonth(date),
    )


def compact_date(date: Column) -> Column:
    return F.date_format(date, "yyyyMMdd")


def replace_first(c: Column, old: str, new: Column | str) -> Column:
    """Replace the first occurrence of plain text."""
    new = F.lit(new) if isinstance(new, str) else new
    at = F.instr(c, old)
    return F.when(
        at > 0,
        F.concat(F.substring(c, F.lit(1), at - 1), new, F.substring(c, at + len(old), F.length(c))),
    ).otherwise(c)


def last_part(path: Column) -> Column:
    return F.split_part(path, F.lit("/"), F.lit(-1))


def join_with_last(names: Column, sep: str = ", ", last: str = " and ") -> Column:
    """``a, b and c`` from an array of strings."""
    n = F.size(names)
    return F.when(n <= 1, F.array_join(names, sep)).otherwise(
        F.concat(
            F.array_join(F.slice(names, F.lit(1), n - 1), sep), F.lit(last), F.element_at(names, -1)
        )
    )


def point_wkt(x: Column, y: Column) -> Column:
    return F.format_string("POINT (%s %s)", x.cast("string"), y.cast("string"))


def state_path(initial_path: Column, date: Column, outputs: str) -> Column:
    """File of the state after ``date`` that belongs to a province's initial file."""
    moved = replace_first(initial_path, INITIAL_FOLDER, outputs)
    return replace_first(moved, INITIAL_MARK, compact_date(date))
