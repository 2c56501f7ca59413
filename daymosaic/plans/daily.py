"""The daily batch: flatten new results, publish them, and refresh what depends on them.

Each step publishes through its own ledger. The indicators of a day are made again when the result files of the
day change; its regional means and images when its indicators were published again. Days that
leave the window leave all datasets.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymosaic.fixed_values import IMAGES_PER_GROUP, ROWS_PER_GROUP
from daymosaic.functions.curve import morton
from daymosaic.functions.sizing import materialise
from daymosaic.functions.text import partition_digits
from daymosaic.operators.flatten import flatten_results
from daymosaic.operators.quality import rejected
from daymosaic.plans.maps import daily_images
from daymosaic.plans.regional import regional_series
from daymosaic.schemas import GridSpec
from daymosaic.sources.ledger import DayDataset, file_sources, ledger_sources, publish, read_published
from daymosaic.sources.readers import list_files
from daymosaic.sources.writers import with_date_parts


def _by_parts(root: str, **layout) -> DayDataset:
    return DayDataset(
        root, ("year", "month", "day"), lambda d: f"year={d.year}/month={d.month}/day={d.day}", "make_date(year, month, day)", **layout)


def indicator_days(root: str, schema=None, spec: GridSpec | None = None) -> DayDataset:
    """Rows of a day lie along a space-filling curve over ``spec``, or by their coordinates without one."""
    sort = ("geometry.x", "geometry.y") if spec is None else (morton(F.col("geometry.x"), F.col("geometry.y"), spec),)
    return _by_parts(root, sort=sort, rows_per_group=ROWS_PER_GROUP, schema=schema)


def reject_days(root: str) -> DayDataset:
    return _by_parts(root)


def series_days(root: str) -> DayDataset:
    """One folder a level and day, so a row group holds a day."""
    return DayDataset(root, ("admin_level", "date"), lambda d: f"admin_level=*/date={d}", "CAST(date AS DATE)", sort=("polygon_id",))


def image_days(root: str) -> DayDataset:
    return DayDataset(
        root, ("date",), lambda d: f"date={d:%Y%m%d}", "to_date(CAST(date AS STRING), 'yyyyMMdd')", sort=("var",), rows_per_group=IMAGES_PER_GROUP)


def with_geometry(flat: DataFrame) -> DataFrame:
    """Coordinates as one column, where there are any."""
    if not {"x", "y"} <= set(flat.columns):
        return flat.withColumn("geometry", F.lit(None).cast("struct<x: double, y: double>"))
    return flat.withColumn("geometry", F.struct("x", "y")).drop("x", "y")


def accepted_and_rejected(results: DataFrame) -> list[DataFrame]:
    """Published rows and rejects of nested results, each with its folder columns."""
    kept = [c for c in results.columns if c not in ("result", "state", "x", "y")]
    return [with_geometry(flatten_results(results)), with_date_parts(rejected(results).select(*kept))]


def publish_days(
    spark: SparkSession, results: DataFrame, indicators: DayDataset, rejects: DayDataset, run_date: dt.date,
    txn: str | None = None, sources: DataFrame | None = None, keep: bool = False,
) -> list[dt.date]:
    """Publish the days of the window whose result files are new or changed; failed rows go to ``rejects``.

    ``results`` is read from files, unless ``sources`` says what its days come from. A window has 381 days, so those
    to publish become a literal list and the reader skips every other folder or row group. Results that are
    themselves computed, not just read, are written once (``keep``), as accepted and rejected rows both come from them.
    """
    def make(days: list[dt.date]) -> list[DataFrame]:
        asked = results.where(F.col("date").isin(days))
        return accepted_and_rejected(materialise(asked, "asked")[0] if keep else asked)

    return publish(spark, [indicators, rejects], file_sources(results) if sources is None else sources, make, run_date, txn)


def _of_days(spark: SparkSession, indicators: DayDataset, days: list[dt.date]) -> DataFrame:
    return read_published(spark, indicators, days[0], days[-1]).where(F.col("date").isin(days))


def publish_series(
    spark: SparkSession, indicators: DayDataset, points: DataFrame, polygons: DataFrame, series: DayDataset, run_date: dt.date,
    degrees: bool = False,
) -> list[dt.date]:
    """Regional means of the days whose indicators were published since."""
    def make(days):
        return [regional_series(_of_days(spark, indicators, days), points, polygons, clean=False, degrees=degrees)]

    return publish(spark, [series], ledger_sources(spark, indicators), make, run_date)


def publish_images(
    spark: SparkSession, indicators: DayDataset, points: DataFrame, spec: GridSpec, order: str, ncol: int, nrow: int,
    images: DayDataset, run_date: dt.date,
) -> list[dt.date]:
    """Images of the days whose indicators were published since."""
    def make(days):
        return [daily_images(_of_days(spark, indicators, days), points, spec, order, ncol, nrow)]

    return publish(spark, [images], ledger_sources(spark, indicators), make, run_date)


def processed_dates(spark: SparkSession, indicators_root: str) -> DataFrame:
    """Days a dataset without a ledger holds, from the names of its folders; no file is read."""
    digits = partition_digits(F.col("path"))
    return (
        list_files(spark, indicators_root, "*.parquet")
        .select(F.to_date(digits, "yyyyMMdd").alias("date")).where(F.col("date").isNotNull()).distinct()
    )
