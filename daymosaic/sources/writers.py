"""Writers of the published datasets. All of them may be repeated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymosaic.fixed_values import IMAGES_PER_GROUP, ROWS_PER_FILE, ROWS_PER_GROUP
from daymosaic.functions.curve import morton
from daymosaic.functions.text import partition_uri, point_wkt
from daymosaic.schemas import GridSpec


def write_folders(df: DataFrame, root: str, by, sort=(), rows_per_file: int = ROWS_PER_FILE, rows_per_group: int | None = None) -> None:
    """Write ``df`` below ``root`` in folders of ``by``, replacing those that ``df`` has rows for.

    Rebalancing gathers small partitions and splits a folder that holds much of the data over
    several tasks. ``sort`` orders the rows of a file, and ``rows_per_group`` bounds its row groups, which makes
    their statistics selective for later range predicates.
    """
    writer = (
        df.hint("rebalance", *by).sortWithinPartitions(*by, *sort).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(*by)
    )
    if rows_per_group:
        writer = writer.option("parquet.block.row.count.limit", rows_per_group)
    writer.parquet(root)


def write_weather(weather: DataFrame, root: str, spec: GridSpec, rows_per_group: int = ROWS_PER_GROUP, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Weather below ``root``, one folder a day, its rows along a space-filling curve over ``spec``.

    Days are cut into ranges of the curve, so a day with much of the data is written by several tasks. A small box
    then meets few row groups, whose statistics let the reader skip the others.
    """
    place = morton(F.col("x"), F.col("y"), spec)
    (
        weather.repartitionByRange(F.col("dates"), place).sortWithinPartitions(F.col("dates"), place).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", rows_per_file)
        .option("parquet.block.row.count.limit", rows_per_group).partitionBy("dates").parquet(root)
    )


def with_date_parts(df: DataFrame, date: str = "date") -> DataFrame:
    return df.withColumns({
        "year": F.year(date), "month": F.month(date), "day": F.dayofmonth(date),
    })


def write_partitioned_day(
    df: DataFrame, root: str, sort=(), rows_per_file: int = ROWS_PER_FILE, rows_per_group: int = ROWS_PER_GROUP
) -> None:
    """Write days below ``root`` as ``year=/month=/day=``, replacing the days present in ``df``."""
    write_folders(with_date_parts(df), root, ["year", "month", "day"], sort, rows_per_file, rows_per_group)


def partition_paths(df: DataFrame, root: str, date: str = "date") -> DataFrame:
    """Folder of every day in ``df``."""
    return df.select(date).distinct().select(date, partition_uri(root, F.col(date)).alias("path"))


def point_layer(df: DataFrame, x: Column, y: Column) -> DataFrame:
    """Columns of the point layer: everything not internal, and the position as WKT."""
    kept = [c for c in df.columns if not c.startswith("internal")]
    return df.select(*kept, point_wkt(x, y).alias("wkt"))


def write_point_layer(df: DataFrame, root: str) -> None:
    write_partitioned_day(df, root)


def write_image_table(images: DataFrame, root: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """The image table, one folder per date; rewriting a date replaces it."""
    write_folders(images, root, ["date"], ["var"], rows_per_file, IMAGES_PER_GROUP)


def timeseries_publish(means: DataFrame, root: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Regional means, one folder per level and day: publishing a day leaves all other days alone.

    A folder is a day, so a row group is a day too.
    """
    write_folders(means, root, ["admin_level", "date"], ["polygon_id"], rows_per_file)


def state_checkpoint(states: DataFrame, root: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """State of each point after a day, one folder per date; provinces lie in order inside the files."""
    write_folders(states, root, ["date"], ["province", "point_id"], rows_per_file)


def write_state_history(states: DataFrame, table: str, root: str, buckets: int, keys=("province", "point_id")) -> None:
    """States of many days as a table below ``root``, one folder a day, bucketed by point.

    ``states`` has one row a point and ``state_date``. Whatever joins or orders states by point then reads a bucket in one
    task, and no state moves. One task writes a bucket, so a day has one file a bucket.
    """
    (
        states.repartition(buckets, *keys).sortWithinPartitions("state_date", *keys).write.mode("overwrite").option("path", root)
        .partitionBy("state_date").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    )
