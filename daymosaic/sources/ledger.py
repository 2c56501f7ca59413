"""Datasets of whole days, and the ledger of what was published of them.

A publication replaces days. New folders are written beside the dataset, below ``_staged``; a plan of what
they are to replace is written last. Only then folders change places, one rename a folder, and the ledger
gets a row for each day. A publication that broke off is finished by the next one if its plan is
complete, and thrown away if not: moving again what was moved before changes nothing. So a day is
either the old or the new one, a day without rows any more loses its folder, and a day outside the
window is retired.

The ledger has two tables below ``_ledger``, both only ever added to. ``days`` says for each
day in which publication it changed last, what it was made from, how many rows were accepted and rejected;
``files`` names the files of that publication and their rows. One publisher writes a dataset at a time.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymosaic.fixed_values import ROWS_PER_FILE
from daymosaic.operators.calendar import window_bounds, window_retention
from daymosaic.sources import folders
from daymosaic.sources.writers import write_folders

PUBLISHED, FAILED, RETIRED = "published", "failed", "retired"

DAYS = ("day date, seq bigint, run_date date, source bigint, txn string, state string, "
        "accepted bigint, rejected bigint, n_files bigint")
FILES = "day date, seq bigint, part int, folder string, file string, rows bigint"


@dataclass(frozen=True)
class DayDataset:
    """Where a dataset lies and how a day is laid out in it.

    ``by`` are its folder columns; ``pattern`` gives the folders of a day as a glob; ``day_of`` is SQL
    text that gives the day of a row from the folder columns.
    """

    root: str
    by: tuple[str, ...]
    pattern: Callable[[dt.date], str]
    day_of: str
    sort: tuple[str, ...] = ()
    rows_per_file: int = ROWS_PER_FILE
    rows_per_group: int | None = None
    schema: object = field(default=None, compare=False)


def current_days(spark: SparkSession, dataset: DayDataset) -> DataFrame:
    """The last row of each day in the ledger."""
    path = f"{dataset.root}/_ledger/days"
    if not folders.exists(spark, path):
        return spark.createDataFrame([], DAYS)
    names = [c.split()[0] for c in DAYS.split(", ")]
    latest = spark.read.schema(DAYS).parquet(path).groupBy("day").agg(F.max_by(F.struct(*names[1:]), "seq").alias("last"))
    return latest.select("day", "last.*")


def current_files(spark: SparkSession, dataset: DayDataset, part: int = 0) -> DataFrame:
    """Files of the days as last published, as paths below the root."""
    path = f"{dataset.root}/_ledger/files"
    if not folders.exists(spark, path):
        return spark.createDataFrame([], FILES)
    files = spark.read.schema(FILES).parquet(path).where(F.col("part") == part).distinct()
    return files.join(current_days(spark, dataset).select("day", "seq"), ["day", "seq"])


def read_published(spark: SparkSession, dataset: DayDataset, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """Rows of the published days from ``first`` to ``last``: the ledger names the files, no folder is listed.

    With a declared schema no file is opened to find it out, and a file that lacks one of its columns is an error.
    """
    files = current_files(spark, dataset)
    if first is not None:
        files = files.where(F.col("day") >= F.lit(first))
    if last is not None:
        files = files.where(F.col("day") <= F.lit(last))
    paths = [f"{dataset.root}/{r['folder']}/{r['file']}" for r in files.select("folder", "file").collect()]
    schema = dataset.schema
    if not paths:
        if schema is None:
            raise ValueError(f"nothing is published below {dataset.root} and no schema is declared")
        return spark.createDataFrame([], schema)
    reader = spark.read.option("basePath", dataset.root)
    if schema is None:
        return reader.parquet(*paths)
    lacking = set(schema.fieldNames()) - set(reader.parquet(paths[0]).columns)
    if lacking:
        raise ValueError(f"{paths[0]} lacks {', '.join(sorted(lacking))}")
    return reader.schema(schema).parquet(*paths)


def file_sources(rows: DataFrame, date: str = "date") -> DataFrame:
    """(day, source) of rows read from files: which files a day's rows come from, in which version, as one number.

    Only the date is read. The number does not depend on the order of files.
    """
    version = F.xxhash64("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
    return rows.select(F.col(date).alias("day"), version.alias("v")).distinct().groupBy("day").agg(F.bit_xor("v").alias("source"))


def ledger_sources(spark: SparkSession, dataset: DayDataset) -> DataFrame:
    """(day, source) of the days published there: their source is the publication they come from."""
    return current_days(spark, dataset).where(F.col("state") == PUBLISHED).select("day", F.col("seq").alias("source"))


def publish(
    spark: SparkSession, datasets: list[DayDataset], sources: DataFrame, make: Callable[[list[dt.date]], list[DataFrame]],
    run_date: dt.date, txn: str | None = None,
) -> list[dt.date]:
    """Publish the days of the window whose source is new or changed, and retire those before the window.

    ``sources`` has (day, source). ``make`` gives the rows of some days for each of ``datasets``: those
    accepted, then those rejected. The ledger lies with the first one. A day whose rows were all
    rejected is done, like any other, until its source changes. ``txn`` names the call; one that
    was published before does nothing. Returns the days that changed.
    """
    main = datasets[0]
    recover(spark, datasets)
    known = current_days(spark, main)
    if txn is not None and known_txn(spark, main, txn):
        return []
    first, _ = window_bounds(run_date)
    done = known.where(F.col("state") != RETIRED).select("day", F.col("source").alias("done"))
    asked = window_retention(sources, run_date, "day").join(done, "day", "left").where(~F.col("source").eqNullSafe(F.col("done")))
    todo = {r["day"]: r["source"] for r in asked.select("day", "source").collect()}  # days of one window
    gone = [r["day"] for r in done.where(F.col("day") < F.lit(first)).select("day").collect()]
    if not todo and not gone:
        return []
    seq = (known.agg(F.max("seq")).first()[0] or 0) + 1
    staged = f"_staged/{seq}"
    if todo:
        for dataset, rows in zip(datasets, make(sorted(todo))):
            write_folders(rows, f"{dataset.root}/{staged}", dataset.by, dataset.sort, dataset.rows_per_file, dataset.rows_per_group)
    _write_plan(spark, datasets, seq, todo, gone, run_date, txn)
    _finish(spark, datasets, seq)
    for dataset in datasets:
        folders.remove(spark, f"{dataset.root}/_staged")
    return sorted([*todo, *gone])


def known_txn(spark: SparkSession, dataset: DayDataset, txn: str) -> bool:
    path = f"{dataset.root}/_ledger/days"
    return folders.exists(spark, path) and not spark.read.schema(DAYS).parquet(path).where(F.col("txn") == txn).isEmpty()


def recover(spark: SparkSession, datasets: list[DayDataset]) -> None:
    """Finish publications that have a whole plan, throw away those that have none."""
    for found in folders.matching(spark, datasets[0].root, "_staged/*"):
        seq = found.split("/")[-1]
        if folders.exists(spark, f"{datasets[0].root}/{found}/_plan/files/_SUCCESS"):
            _finish(spark, datasets, int(seq))
    for dataset in datasets:
        folders.remove(spark, f"{dataset.root}/_staged")


def _staged_files(spark: SparkSession, dataset: DayDataset, seq: int, part: int) -> DataFrame | None:
    """FILES rows of what was written, counted file by file."""
    staged = f"{dataset.root}/_staged/{seq}"
    if not folders.matching(spark, staged, f"{dataset.by[0]}=*"):
        return None
    path = F.col("_metadata.file_path")
    return spark.read.parquet(staged).select(
        F.expr(dataset.day_of).alias("day"), F.array_join(F.slice(F.split(path, "/"), -1 - len(dataset.by), len(dataset.by)), "/").alias("folder"),
        F.col("_metadata.file_name").alias("file")).groupBy("day", "folder", "file").agg(F.count(F.lit(1)).alias("rows")).select(
        "day", F.lit(seq).cast("bigint").alias("seq"), F.lit(part).alias("part"), "folder", "file", "rows")


def _write_plan(spark, datasets, seq: int, todo: dict, gone: list, run_date: dt.date, txn: str | None) -> None:
    plan = f"{datasets[0].root}/_staged/{seq}/_plan"
    files = spark.createDataFrame([], FILES)
    for part, dataset in enumerate(datasets):
        found = _staged_files(spark, dataset, seq, part) if todo else None
        files = files if found is None else files.unionByName(found)
    files = files.coalesce(1)
    own = [(d, seq, run_date, s, txn, None) for d, s in todo.items()] + [(d, seq, run_date, None, txn, RETIRED) for d in gone]
    days = spark.createDataFrame(own, "day date, seq bigint, run_date date, source bigint, txn string, state string")
    counts = files.groupBy("day").agg(
        F.sum(F.when(F.col("part") == 0, F.col("rows"))).alias("accepted"), F.sum(F.when(F.col("part") > 0, F.col("rows"))).alias("rejected"),
        F.count(F.when(F.col("part") == 0, 1)).alias("n_files"))
    none = F.lit(0).cast("bigint")
    days.join(counts, "day", "left").select(
        "day", "seq", "run_date", "source", "txn",
        F.coalesce("state", F.when(F.col("accepted") > 0, PUBLISHED).otherwise(FAILED)).alias("state"),
        *[F.coalesce(c, none).alias(c) for c in ("accepted", "rejected", "n_files")],
    ).coalesce(1).write.mode("overwrite").parquet(f"{plan}/days")
    files.write.mode("overwrite").parquet(f"{plan}/files")  # its end ends the plan


def _finish(spark: SparkSession, datasets: list[DayDataset], seq: int) -> None:
    """Let folders change places as planned, and enter the plan into the ledger. May be repeated."""
    root = datasets[0].root
    plan = f"{root}/_staged/{seq}/_plan"
    days, files = spark.read.schema(DAYS).parquet(f"{plan}/days"), spark.read.schema(FILES).parquet(f"{plan}/files")
    touched = [r["day"] for r in days.select("day").collect()]
    for part, dataset in enumerate(datasets):
        planned = {r["folder"] for r in files.where(F.col("part") == part).select("folder").distinct().collect()}
        for folder in [f for day in touched for f in folders.matching(spark, dataset.root, dataset.pattern(day))]:
            if folder not in planned:
                folders.remove(spark, f"{dataset.root}/{folder}")
        staged = f"{dataset.root}/_staged/{seq}"
        for folder in folders.matching(spark, staged, "/".join(f"{c}=*" for c in dataset.by)):
            folders.move(spark, f"{staged}/{folder}", f"{dataset.root}/{folder}")
    entered = f"{root}/_ledger/days"
    if not folders.exists(spark, entered) or spark.read.schema(DAYS).parquet(entered).where(F.col("seq") == seq).isEmpty():
        files.coalesce(1).write.mode("append").parquet(f"{root}/_ledger/files")
        days.coalesce(1).write.mode("append").parquet(entered)  # its end makes the publication known
