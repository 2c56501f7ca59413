"""A training corpus from ``documents``: filter, deduplicate, decontaminate, mix, shard.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept.
``run`` writes every stage as Parquet to the shared folder and reads it again.

Defined results: null, empty and wordless texts are scored like any, are no near copies of anything, hold no benchmark
window and are mixed as size 0; rows without an id are documents of their own, and of rows that share
one the one of a group stays; an empty table gives an empty result; other columns are carried through under
their names, whatever these are, but one named like a column of the last stage is renamed there (``op8_shard``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymosaic.llm import op2_mix, op7_minhash, op8_shard, op9_decontaminate, op10_toxicity
from daymosaic.llm.tables import id_crc, save, table

#: near duplicates share this many per cent of their five-word shingles
SIMILAR = 80


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier does not take for toxic; it learns from labels outside the held-out quarter."""
    labels = table(spark, sf_dir, "labels").where(id_crc(F.col("doc_id")) % 4 != 2)
    return op10_toxicity.without_toxic(docs, labels)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id."""
    return op7_minhash.without_near_duplicates(docs, percent=SIMILAR)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of ten words of a benchmark item occurs."""
    return op9_decontaminate.without_hits(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix by source weights; a document taken several times is there several times."""
    return op2_mix.mixed_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and a gapless place in it."""
    return op8_shard.sharded_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("minhash_near_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: a fitted classifier and a knapsack are no SQL; tests/llm compares the stages with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs, _ = save(stage(spark, docs, sf_dir), name)
    return docs
