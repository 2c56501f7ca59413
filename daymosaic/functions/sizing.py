"""Broadcast decisions backed by a measurement, and the shared folder for cut lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: bytes a joined side may have to be sent to every executor
MAX_BROADCAST_BYTES = 256 * 1024 * 1024

ROW_OVERHEAD = 32

#: pairs a task of a join makes that returns many rows for each of its larger side
PAIRS_PER_TASK = 4_000_000

#: pairs a row counts as at least, which keeps the rows of a task few enough to be sorted in memory
LEAST_PAIRS = 16

#: groups of keys in which a running sum over all keys is made
KEY_BLOCKS = 1024


def _fixed_width(dtype: T.DataType) -> int | None:
    """Bytes of a value of ``dtype``, or None where values differ in length."""
    if isinstance(dtype, T.StructType):
        widths = [_fixed_width(f.dataType) for f in dtype.fields]
        return None if None in widths else 8 + sum(widths)
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StringType, T.BinaryType)):
        return None
    return 8


def _bytes_of(c: Column, dtype: T.DataType) -> Column:
    fixed = _fixed_width(dtype)
    if fixed is not None:
        return F.lit(fixed).cast("bigint")
    if isinstance(dtype, T.ArrayType):
        element = _fixed_width(dtype.elementType)
        if element is not None:
            inner = F.size(c) * element
        else:
            inner = F.aggregate(
                c, F.lit(0).cast("bigint"), lambda s, e: s + _bytes_of(e, dtype.elementType)
            )
    elif isinstance(dtype, T.StructType):
        inner = sum((_bytes_of(c[f.name], f.dataType) for f in dtype.fields), F.lit(0))
    elif isinstance(dtype, T.MapType):
        raise TypeError("maps are not measured")
    else:
        inner = F.octet_length(c)
    return F.coalesce(inner.cast("bigint"), F.lit(0).cast("bigint")) + 16


def row_bytes(df: DataFrame) -> Column:
    """Size of a row of ``df`` in memory."""
    row = F.lit(ROW_OVERHEAD).cast("bigint")
    for f in df.schema.fields:
        row = row + _bytes_of(F.col(f"`{f.name}`"), f.dataType)
    return row


def measured_bytes(df: DataFrame) -> int:
    """Size of ``df`` in memory, by one distributed aggregation over it."""
    return df.agg(F.sum(row_bytes(df))).first()[0] or 0


def fits_broadcast(
    df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES, at_most_rows: int | None = None, text_bytes: int | None = None
) -> bool:
    """True when ``df`` is known, or else measured, to have at most ``max_bytes``.

    ``at_most_rows`` is a bound that is known already: it follows from the
    definition of ``df`` or was counted while it was written. Together with
    ``text_bytes``, the longest text in it, it can make measuring unnecessary.
    What is measured is a dimension (points, polygons, grid cells), never the
    observations.
    """
    if at_most_rows is not None:
        widths = [
            16 + text_bytes if text_bytes is not None and isinstance(f.dataType, T.StringType)
            else _fixed_width(f.dataType) for f in df.schema.fields
        ]
        if None not in widths and at_most_rows * (ROW_OVERHEAD + sum(widths)) <= max_bytes:
            return True
    return measured_bytes(df) <= max_bytes


def small_side(
    df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES, at_most_rows: int | None = None, text_bytes: int | None = None
) -> DataFrame:
    """``df`` with a broadcast hint if it is small, with a sort-merge hint if it is not.

    Beyond the bound both sides are shuffled on the join key and adaptive
    execution splits the partitions of hot keys.
    """
    return df.hint("broadcast" if fits_broadcast(df, max_bytes, at_most_rows, text_bytes) else "merge")


def spread_by_pairs(df: DataFrame, partners: DataFrame, key: str, pairs_per_task: int = PAIRS_PER_TASK) -> DataFrame:
    """``df`` in as many tasks as the pairs need that it makes with a side it is joined to, few keys in each.

    ``partners`` has each ``key`` of that side once with the number of ``partners`` a row meets there; other rows go.
    Without this the tasks of ``df`` follow its own bytes, and each has as much more to do as its rows have partners.
    All pairs are thought of as one line, key after key, and tasks take equal pieces of it: a piece is many whole keys, or
    part of one that has many rows or many partners. So a task meets few partners again and again, and its dictionaries
    of them stay small. A row's place among those of its key comes from its own values, which makes a
    retried task send it to the same task again; copies of a row stay together. Only keys are read to count. Where one
    task's pairs suffice, ``df`` stays as it is.
    """
    same = F.col(key).eqNullSafe(F.col("_key"))
    partners = partners.withColumnRenamed(key, "_key")
    weight = F.greatest("partners", F.lit(LEAST_PAIRS).cast("bigint"))
    weighed, seen = written(df.select(key).join(partners, same).groupBy("_key").agg(F.sum(weight).alias("_pairs")),
                            "pairs-per-key", pairs=F.sum("_pairs"))
    tasks = -(-(seen["pairs"] or 0) // pairs_per_task)
    if tasks <= 1:
        return df
    # where each key starts on the line: among those of its block, and the block among all blocks
    weighed = weighed.withColumn("_block", F.pmod(F.xxhash64("_key"), F.lit(KEY_BLOCKS).cast("bigint")))
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    blocks = weighed.groupBy("_block").agg(F.sum("_pairs").alias("_all")).select(
        "_block", F.sum("_all").over(earlier.orderBy("_block")).alias("_blocks_before"))
    keys, count = materialise(
        weighed.withColumn("_before", F.sum("_pairs").over(earlier.partitionBy("_block").orderBy("_key")))
        .join(blocks.hint("broadcast"), "_block")
        .select("_key", "_pairs", (F.coalesce("_before", F.lit(0)) + F.coalesce("_blocks_before", F.lit(0))).alias("_start")),
        "starts-of-keys")
    columns = [F.col(f"`{c}`") for c in df.columns]
    share = F.pmod(F.xxhash64(*columns), F.lit(1 << 31).cast("bigint")) / F.lit(float(1 << 31))
    task = F.floor((F.col("_start") + F.floor(share * F.col("_pairs"))) / F.lit(pairs_per_task)).cast("int")
    placed = df.join(small_side(keys, at_most_rows=count), same).select(*columns, task.alias("_task"))
    return placed.repartitionById(tasks, "_task").drop("_task")


def side_by_side(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` with the rows of equal ``keys`` in a task one after the other, also below a join.

    Rows that lack values come last: a first page of nulls alone makes a Parquet writer give up its dictionary for good.
    """
    lacking = sum((F.col(f"`{c}`").isNull().cast("int") for c in df.columns), F.lit(0))
    ordered = df.sortWithinPartitions(lacking, *keys)
    # Spark drops a sort right below a join; it keeps one below a metric
    return ordered.observe(f"ordered-{uuid.uuid4().hex[:12]}", F.count(F.lit(1)).alias("rows"))


_made: list[str] = []


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below ``spark.checkpoint.dir``.

    A local-mode session without that setting (a test, a laptop) is given one of its own, which goes
    when Python ends; a cluster has to name one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="daymosaic-")
        atexit.register(shutil.rmtree, root, True)
        spark.conf.set("spark.checkpoint.dir", root)
    path = f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"
    _made.append(path)
    return path


def remove_intermediates(spark: SparkSession) -> int:
    """Remove the folders made so far; for the end of a job, when nothing lazy reads them any more. Returns their number."""
    files = spark._jvm.org.apache.hadoop.fs
    for path in _made:
        place = files.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    count = len(_made)
    _made.clear()
    return count


def written(df: DataFrame, purpose: str, **measures: Column) -> tuple[DataFrame, dict]:
    """Write ``df`` to the shared folder; (the table read back, ``rows`` and the given aggregates of it).

    The plan is cut there. Rows are counted and measured while they are written.
    """
    path = shared_folder(df.sparkSession, purpose)
    seen = Observation(purpose)
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[m.alias(n) for n, m in measures.items()])
    counted.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), dict(seen.get)


def materialise(df: DataFrame, purpose: str) -> tuple[DataFrame, int]:
    """Write ``df`` to the shared folder; (the table read back, its number of rows)."""
    table, seen = written(df, purpose)
    return table, seen["rows"]
