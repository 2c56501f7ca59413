"""Declared schemas of every table the engine reads, and the grid description."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from daymosaic.fixed_values import EXTRA_OUTPUTS, INDICATORS, WEATHER_VARS


def _doubles(names) -> list[T.StructField]:
    return [T.StructField(n, T.DoubleType()) for n in names]


LAYER = T.StructType(
    [T.StructField("layer", T.IntegerType())]
    + _doubles(["W", "theta", "psi", "waterWP", "waterFC"])
)

STATE = T.StructType([
    T.StructField("soil", T.ArrayType(LAYER)),
    T.StructField("control", T.StructType([T.StructField("soilFunctions", T.StringType())])),
])

RESULT = T.StructType([
    T.StructField("WaterBalance", T.StructType(_doubles([
        "Rain", "Snow", "PET", "NetRain", "SoilEvaporation",
        "Transpiration", "Runoff", "DeepDrainage",
    ]))),
    T.StructField("Stand", T.StructType(_doubles(["LAIexpanded"]))),
    T.StructField("Plants", T.ArrayType(T.StructType(_doubles(["LAI", "DDS", "LFMC"])))),
    T.StructField("FireHazard", T.StructType(_doubles(["DFMC [%]", "SFP", "CFP"]))),
])

#: one simulated point and day, nested
RESULTS = T.StructType([
    T.StructField("province", T.IntegerType()),
    T.StructField("point_id", T.LongType()),
    T.StructField("x", T.DoubleType()),
    T.StructField("y", T.DoubleType()),
    T.StructField("date", T.DateType()),
    T.StructField("result", RESULT),
    T.StructField("state", STATE),
    T.StructField("error", T.StringType()),
])

POINTS = T.StructType([
    T.StructField("province", T.IntegerType()),
    T.StructField("point_id", T.LongType()),
    T.StructField("x", T.DoubleType()),
    T.StructField("y", T.DoubleType()),
])

WEATHER = T.StructType(
    _doubles(["x", "y"]) + [T.StructField("dates", T.DateType())] + _doubles(WEATHER_VARS)
)

POINT = T.StructType(_doubles(["x", "y"]))

IMAGES = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("var", T.StringType()),
    T.StructField("palette_selected", T.StringType()),
    T.StructField("base64_string", T.StringType()),
] + _doubles(["left_ext", "down_ext", "right_ext", "up_ext", "min_value", "max_value"]))

#: the published indicators; the last three columns are folders
INDICATOR_DAYS = T.StructType([
    T.StructField("province", T.IntegerType()),
    T.StructField("point_id", T.LongType()),
    T.StructField("date", T.DateType()),
    T.StructField("geometry", POINT),
] + _doubles([*INDICATORS, *EXTRA_OUTPUTS]) + [T.StructField(n, T.IntegerType()) for n in ("year", "month", "day")])


@dataclass(frozen=True)
class GridSpec:
    """Regular grid, described only by its numbers; it is never materialised.

    Cells are numbered row by row from the top left corner, starting at 1.
    """

    xmin: float
    xmax: float
    ymin: float
    ymax: float
    resolution: float
    crs: str = "EPSG:25830"

    def __post_init__(self):
        if self.resolution <= 0 or self.xmax <= self.xmin or self.ymax <= self.ymin:
            raise ValueError(f"not a grid: {self}")

    @property
    def ncol(self) -> int:
        return round((self.xmax - self.xmin) / self.resolution)

    @property
    def nrow(self) -> int:
        return round((self.ymax - self.ymin) / self.resolution)

    @property
    def ncell(self) -> int:
        return self.ncol * self.nrow

    def coarse(self, factor: int) -> "GridSpec":
        """Grid of ``factor`` x ``factor`` blocks; edge blocks may be partial."""
        res = self.resolution * factor
        ncol = -(-self.ncol // factor)
        nrow = -(-self.nrow // factor)
        return GridSpec(
            self.xmin, self.xmin + ncol * res, self.ymax - nrow * res, self.ymax, res, self.crs
        )
