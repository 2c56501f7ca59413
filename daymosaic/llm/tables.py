"""Reading given tables and small helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from daymosaic.functions.sizing import shared_folder

#: what separates words: blank, tab, line feed, vertical tab, form feed, carriage return
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
BLANK_CLASS = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, by a path that only Spark has to understand."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_crc(doc_id: Column) -> Column:
    """crc32 of an id written as text; 0 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")), F.lit(0).cast("bigint"))


def trimmed(text: Column) -> Column:
    """``text`` without blanks at its ends; null becomes empty."""
    return F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))


def word_array(text: Column) -> Column:
    """The words of a text, in order; no words for null, empty and blank texts.

    Bind it with ``let`` where a lambda looks into it.
    """
    return F.filter(F.split(trimmed(text), f"{BLANK_CLASS}+"), lambda w: w != "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once for each row."""
    return F.transform(F.array(value), body)[0]


def save(df: DataFrame, purpose: str, **measures: Column) -> tuple[DataFrame, dict]:
    """Write ``df`` to the shared folder: (the table read back, ``rows`` and the given aggregates of it).

    Lineage is cut there; a lost executor costs at most the step after it.
    """
    path = shared_folder(df.sparkSession, purpose)
    seen = Observation(purpose)
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[m.alias(n) for n, m in measures.items()])
    counted.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), dict(seen.get)


def hidden(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with its columns renamed, and the names by the former ones: what an operator adds clashes with none."""
    names = {c: f"in_{k}" for k, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def with_places(df: DataFrame, keys: list[str], order: list[str], purpose: str) -> DataFrame:
    """``df`` with ``place``, the rank from 0 among the rows of equal ``keys`` (null equals null) by ``order``.

    Rows are sorted by ranges of keys and order, so a key with any share of the rows is spread over tasks: every
    stretch counts from its first row, and the rows of the key in earlier stretches are added. Rows alike in all of that are
    told apart by a number, so they spread too; which of them comes first does not matter.
    """
    columns = df.columns
    numbered = df.withColumn("alike", F.xxhash64(F.monotonically_increasing_id()))
    ranged = numbered.repartitionByRange(*keys, *order, "alike").sortWithinPartitions(*keys, *order, "alike")
    rows, _ = save(ranged.select(*columns, F.spark_partition_id().alias("stretch"), F.monotonically_increasing_id().alias("row")), purpose)
    earlier = Window.partitionBy(*keys).orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    # one row a key and stretch
    begins = rows.groupBy(*keys, "stretch").agg(F.min("row").alias("begin"), F.count(F.lit(1)).alias("n")).select(
        *[F.col(k).alias(f"key_{i}") for i, k in enumerate(keys)], F.col("stretch").alias("of"), "begin",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    same = F.col("stretch") == F.col("of")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"key_{i}"))
    return rows.join(begins, same).select(*columns, (F.col("row") - F.col("begin") + F.col("before")).alias("place"))
