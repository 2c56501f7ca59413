"""Folders of a dataset on whatever file system its path names; metadata only, no file is read."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _at(spark, path)
    return fs.exists(place)


def matching(spark: SparkSession, root: str, pattern: str) -> list[str]:
    """Paths relative to ``root`` of what matches a glob below it, in order."""
    fs, place = _at(spark, f"{root}/{pattern}")
    depth = pattern.count("/") + 1
    found = [str(f.getPath().toString()) for f in fs.globStatus(place) or []]
    return sorted("/".join(f.rstrip("/").split("/")[-depth:]) for f in found)


def remove(spark: SparkSession, path: str) -> None:
    fs, place = _at(spark, path)
    fs.delete(place, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Put ``source`` in the place of ``target``, which may exist."""
    fs, place = _at(spark, source)
    _, aim = _at(spark, target)
    if fs.exists(aim):
        fs.delete(aim, True)
    fs.mkdirs(aim.getParent())
    if not fs.rename(place, aim):
        raise OSError(f"{source} could not be moved to {target}")
