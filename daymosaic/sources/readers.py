"""Readers. Schemas are declared; paths may be any the cluster's file systems know."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymosaic.fixed_values import EXCLUDED_FILE_CODES, INDICATORS
from daymosaic.schemas import IMAGES, INDICATOR_DAYS, POINTS, RESULTS, WEATHER
from daymosaic.sources import folders


def read_indicators(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame:
    """The indicator dataset below ``root``; its folders become year, month and day.

    With a ``schema``, as ``schemas.INDICATOR_DAYS``, no file is opened to find it out.
    """
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(root)


def scan_day_partition(spark: SparkSession, root: str, date: dt.date, columns=INDICATORS) -> DataFrame:
    """Position and ``columns`` of one day: its folder is the only one listed, and only those columns are read.

    A day without a folder has no rows; a folder whose files lack a column is an error.
    """
    folder = f"year={date.year}/month={date.month}/day={date.day}"
    if not folders.exists(spark, f"{root}/{folder}"):
        return spark.createDataFrame([], INDICATOR_DAYS).select("geometry", *columns)
    return spark.read.option("basePath", root).parquet(f"{root}/{folder}").select("geometry", *columns)


def scan_date_range(spark: SparkSession, root: str, first: dt.date, last: dt.date, columns) -> DataFrame:
    """``columns`` of the days from ``first`` to ``last``, by folder."""
    day = F.make_date("year", "month", "day")
    return read_indicators(spark, root).where(day.between(F.lit(first), F.lit(last))).select(*columns)


def read_results(spark: SparkSession, *paths: str) -> DataFrame:
    """Nested results of any number of province files or folders as one table."""
    return spark.read.schema(RESULTS).parquet(*paths)


def read_weather(spark: SparkSession, root: str, more: T.StructType | None = None) -> DataFrame:
    """Weather of all days below ``root``; ``more`` declares columns beyond the usual ones."""
    return spark.read.schema(T.StructType([*WEATHER.fields, *(more.fields if more else [])])).parquet(root)


def read_points(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(POINTS).parquet(path)


def read_images(spark: SparkSession, root: str) -> DataFrame:
    """The image table; its folders are named by date."""
    return spark.read.schema(IMAGES).parquet(root)


def list_files(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """(path, size) of the files of ``folder`` that match a glob; contents are not read."""
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true").load(folder)
        .select("path", F.col("length").alias("size"))
    )


def file_name_filter(paths: DataFrame, exclude: str = EXCLUDED_FILE_CODES) -> DataFrame:
    """Paths that do not match ``exclude``."""
    return paths.where(~F.col("path").rlike(exclude))


def files_of_date(paths: DataFrame, date: str) -> DataFrame:
    """Paths that contain a date written YYYYMMDD."""
    return paths.where(F.col("path").contains(date))


def indicator_columns(df: DataFrame) -> DataFrame:
    """Columns whose name contains an indicator name."""
    return df.select(df.colRegex("`.*(" + "|".join(INDICATORS) + ").*`"))


def union_by_name(*tables: DataFrame | None) -> DataFrame:
    """Tables under each other; absent ones are skipped, absent columns are NULL."""
    first, *rest = [t for t in tables if t is not None]
    for other in rest:
        first = first.unionByName(other, allowMissingColumns=True)
    return first
