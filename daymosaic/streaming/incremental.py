"""Publishing days as their result files arrive, accepted and rejected rows alike.

A file stream remembers which files it has seen; ``availableNow`` works off what is new and stops, as a
daily job does. Files of a day come in any batch, late ones long after the day was published: a batch only names the days
it touches, and those days are made again from all their files. A point delivered twice for a day counts as
delivered last. Each batch is one transaction of the ledger, so a batch that runs again after a restart
publishes nothing twice.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daymosaic.functions.sizing import materialise, small_side
from daymosaic.operators.calendar import window_bounds
from daymosaic.plans.daily import publish_days
from daymosaic.schemas import RESULTS
from daymosaic.sources.ledger import DayDataset

#: what a result file says once a day of each point
KEYS = ("province", "point_id", "date")


def results_stream(spark: SparkSession, root: str, files_per_batch: int = 1000, schema: StructType = RESULTS) -> DataFrame:
    """New result files below ``root``, flat or in ``province=/date=`` folders."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(root)


def rows_of_days(results: DataFrame, days: DataFrame) -> DataFrame:
    """Rows of ``results`` whose date is among ``days``, however many those are.

    Their first and last day become a range the reader prunes folders and row groups with; the days
    themselves are a semi-join.
    """
    first, last = days.agg(F.min("date"), F.max("date")).first()
    return results.where(F.col("date").between(F.lit(first), F.lit(last))).join(
        small_side(days.select(F.col("date").alias("_day"))), F.col("date") == F.col("_day"), "left_semi")


def latest_delivery(results: DataFrame, keys=KEYS, asked: Column | None = None) -> DataFrame:
    """One row a key, of several that from the file written last (then the last in name, then in content).

    Compared before the shuffle, so a key delivered very often arrives as one row a task. With ``asked``, a condition, only
    the latest rows that meet it are returned: the others take part in the comparison, but none of their values moves.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in results.columns])
    order = F.struct(F.col("_metadata.file_modification_time"), F.col("_metadata.file_path"), F.xxhash64(row))
    kept = row if asked is None else F.when(asked, row)
    picked = results.select(*[F.col(k).alias(f"_key_{k}") for k in keys], kept.alias("_row"), order.alias("_order"))
    latest = picked.groupBy(*[f"_key_{k}" for k in keys]).agg(F.max_by("_row", "_order").alias("_row"))
    return latest.where(F.col("_row").isNotNull()).select("_row.*")


def stream_days(
    spark: SparkSession, results_root: str, indicators: DayDataset, rejects: DayDataset, checkpoint: str, run_date: dt.date,
    files_per_batch: int = 1000, schema: StructType = RESULTS, keys=KEYS,
) -> None:
    """Publish every day of the window touched by result files not seen before."""
    def publish_batch(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        # several steps use the days: the new files are read for them once
        days, count = materialise(batch.select("date").distinct(), "days")
        if not count:
            return
        # a batch is what its days come from: each one makes them anew
        sources = days.select(F.col("date").alias("day"), F.xxhash64(F.lit(checkpoint), F.lit(number)).alias("source"))
        results = rows_of_days(session.read.schema(schema).parquet(results_root), days)
        first, last = window_bounds(run_date)
        latest = latest_delivery(results, keys, F.col("date").between(F.lit(first), F.lit(last)))
        publish_days(session, latest, indicators, rejects, run_date, f"{checkpoint}:{number}", sources, keep=True)

    query = (
        results_stream(spark, results_root, files_per_batch, schema).select("date").writeStream
        .foreachBatch(publish_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
