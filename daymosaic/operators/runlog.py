"""Summary of pipeline runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymosaic.fixed_values import NO_ERRORS, TAG_FAILED, TAG_FINE
from daymosaic.functions.text import join_with_last


def run_summary(log: DataFrame, run: str = "run_date") -> DataFrame:
    """One row per run: counts by status, names of failed targets, and a tag.

    ``log`` has (run, target, status). Names are made distinct before they are
    listed, so a list is as long as the pipeline has targets, however many log
    lines a failing target wrote.
    """
    counts = log.groupBy(run).agg(*[
        F.count_if(F.col("status") == s).alias(s) for s in ("skipped", "completed", "errored")
    ])
    failed = (
        log.where(F.col("status") == "errored").select(run, "target").distinct()
        .groupBy(run).agg(F.sort_array(F.collect_list("target")).alias("_names"))
    )
    return counts.join(failed, run, "left").select(
        run, "skipped", "completed", "errored",
        F.coalesce(join_with_last(F.col("_names")), F.lit(NO_ERRORS)).alias("errors"),
        F.when(F.col("errored") > 0, TAG_FAILED).otherwise(TAG_FINE).alias("tag"),
    )
