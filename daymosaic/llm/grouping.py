"""Union-find over edges in tables: parents, path compression and contraction as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymosaic.llm.tables import save


def compressed(parents: DataFrame) -> DataFrame:
    """(node, root) for (node, root) rows whose ``root`` may itself have a parent; parents are smaller."""
    while True:
        up = parents.select(F.col("node").alias("__up"), F.col("root").alias("__top"))
        stepped = parents.join(up, F.col("root") == F.col("__up"), "left").select(
            "node", F.coalesce("__top", "root").alias("root"), F.col("__top").isNotNull().alias("moved"))
        stepped, seen = save(stepped, "roots", moved=F.sum(F.col("moved").cast("int")))
        parents = stepped.select("node", "root")
        if not seen["moved"]:
            return parents


def relabelled(groups: DataFrame | None, roots: DataFrame) -> DataFrame:
    """``groups`` (node, root) after some of its roots got the roots ``roots``."""
    if groups is None:
        return roots
    up = roots.select(F.col("node").alias("__up"), F.col("root").alias("__top"))
    moved = groups.join(up, F.col("root") == F.col("__up"), "left").select("node", F.coalesce("__top", "root").alias("root"))
    return moved.unionByName(roots)  # a node of ``roots`` was a root until now, so it is no node of ``groups``


def components(edges: DataFrame) -> DataFrame | None:
    """(node, root) for every node that is not the smallest of its component; None without edges.

    ``edges`` has columns a and b. Each node takes its smallest smaller
    neighbour as parent, paths are compressed, edges are drawn between the roots, and so
    on until no edge is left; a few rounds, as each at least halves the nodes with edges in typical graphs.
    """
    groups = None
    while True:
        ordered = edges.where(F.col("a") != F.col("b")).select(
            F.greatest("a", "b").alias("node"), F.least("a", "b").alias("low")).distinct()
        ordered, seen = save(ordered, "edges")
        if not seen["rows"]:
            return groups
        roots = compressed(ordered.groupBy("node").agg(F.min("low").alias("root")))
        groups = relabelled(groups, roots)
        edges = with_roots(with_roots(ordered, roots, "node", "a"), roots, "low", "b").select("a", "b")


def with_roots(df: DataFrame, roots: DataFrame, column: str, name: str) -> DataFrame:
    """``df`` with the root of ``column``, itself where it has none."""
    up = roots.select(F.col("node").alias("__up"), F.col("root").alias("__top"))
    return df.join(up, F.col(column) == F.col("__up"), "left").withColumn(
        name, F.coalesce("__top", F.col(column))).drop("__up", "__top")
