from collections import Counter

from pyspark.sql import functions as F

from daymosaic.llm import op8_shard as shard
from daymosaic.llm.tables import save, with_places


def test_places_are_gapless_and_growth_moves_only_into_the_new_shard(spark, awkward):
    rows = awkward.select("doc_id", "text").unionByName(spark.range(100, 900).select(F.col("id").alias("doc_id"), F.lit("t").alias("text")))
    for weights in (None, [1.0] * 5, [1.0, 2.0, 4.0]):
        got = shard.assign(rows, weights=weights).collect()
        n = len(weights or [0] * 24)
        places = {}
        for r in got:
            places.setdefault(r["shard"], []).append(r["slot"])
            assert r["grown_shard"] in (r["shard"], n)
        assert all(sorted(p) == list(range(len(p))) for p in places.values()) and len(got) == 811
        by = {}
        for r in got:
            assert by.setdefault(r["doc_id"], r["shard"]) == r["shard"]
        assert 0 < sum(r["grown_shard"] == n for r in got) < 811 * 3 / n


def test_weights_are_kept(spark):
    got = Counter(r["shard"] for r in spark.range(6000).select(shard.shard_of(F.col("id"), [1.0, 2.0, 3.0]).alias("shard")).collect())
    assert [round(got[i] / 1000) for i in range(3)] == [1, 2, 3]


def test_clashing_names_and_empty_tables(spark, awkward):
    clash = awkward.withColumnRenamed("lang", "shard").withColumnRenamed("source", "slot")
    got = shard.assign(clash, carry={"doc_id": F.col("doc_id"), "lang": F.col("shard")})
    assert got.columns == ["doc_id", "lang", "shard", "slot", "grown_shard"] and got.count() == 11
    assert shard.assign(awkward.limit(0)).count() == 0


def test_documents_keep_their_own_columns_of_these_names(spark, awkward):
    clash = awkward.withColumnsRenamed({"lang": "shard", "source": "Slot", "n_chars": "given_shard"}).withColumn("row", F.lit(1)).withColumn("draw", F.lit(2))
    got = shard.sharded_documents(clash)
    assert got.columns == ["doc_id", "text", "given_given_shard", "given_Slot", "given_shard", "row", "draw", "shard", "slot", "grown_shard"]
    assert Counter((r["text"], r["given_given_shard"]) for r in got.collect()) == Counter((r["text"], r["lang"]) for r in awkward.collect())
    assert shard.sharded_documents(awkward.limit(0)).count() == 0


def test_a_hot_id_is_spread_and_its_places_are_gapless(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        rows = spark.range(6000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"))  # a third has no id
        placed, _ = save(with_places(rows.withColumn("k", F.lit(1)), ["k"], ["doc_id"], "hot").withColumn("task", F.spark_partition_id()), "hot")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = placed.collect()
    assert sorted(r["place"] for r in got) == list(range(6000))
    order = sorted(got, key=lambda r: r["place"])
    assert [r["doc_id"] for r in order] == [None] * 2000 + sorted(i for i in range(6000) if i % 3)


def test_main_path_has_no_python(spark, data, plan):
    text = plan(shard.query(spark, data))
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text
