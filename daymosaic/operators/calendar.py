"""Which days to process, to keep and to report. The run date is always a parameter."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymosaic.fixed_values import WINDOW_NEWEST, WINDOW_OLDEST


def window_bounds(run_date: dt.date) -> tuple[dt.date, dt.date]:
    return run_date - dt.timedelta(WINDOW_OLDEST), run_date - dt.timedelta(WINDOW_NEWEST)


def days_of_runs(runs: DataFrame, *carried: str) -> DataFrame:
    """The 381 days each run of ``runs`` (run_date) covers."""
    run = F.col("run_date")
    days = F.sequence(F.date_sub(run, WINDOW_OLDEST), F.date_sub(run, WINDOW_NEWEST))
    return runs.select(*carried, F.explode(days).alias("date"))


def date_window(spark: SparkSession, run_date: dt.date) -> DataFrame:
    """The days one run covers."""
    return days_of_runs(spark.range(1).select(F.lit(run_date).alias("run_date")))


def pending_dates(window: DataFrame, processed: DataFrame) -> DataFrame:
    """Days of the window that were not processed yet."""
    return window.join(processed.select("date").distinct(), "date", "left_anti")


def missing_dates(points: DataFrame, observed: DataFrame, run_date: dt.date) -> DataFrame:
    """(province, date) of the window for which a source holds no row at all.

    Every province is expected on every day.
    """
    first, last = window_bounds(run_date)
    expected = points.select("province").distinct().withColumn(
        "date", F.explode(F.sequence(F.lit(first), F.lit(last)))
    )
    return expected.join(observed.select("province", "date").distinct(), ["province", "date"], "left_anti")


def window_retention(df: DataFrame, run_date: dt.date, column: str = "date") -> DataFrame:
    """Rows inside the window: a plain range predicate, so partitions are pruned."""
    first, last = window_bounds(run_date)
    return df.where(F.col(column).between(F.lit(first), F.lit(last)))


def assert_dates_present(window: DataFrame, observed: DataFrame) -> DataFrame:
    """``window`` unchanged; running it stops when a day has no row in ``observed``."""
    seen = observed.select("date").distinct().withColumn("_seen", F.lit(True))
    joined = window.join(seen, "date", "left")
    stop = F.raise_error(F.concat(F.lit("no data for "), F.col("date").cast("string")))
    return joined.where(F.when(F.col("_seen"), F.lit(True)).otherwise(stop.cast("boolean"))).drop("_seen")
