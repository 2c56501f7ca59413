"""Each stage against brute force on its own input, and the stages one after another."""

import corpus_pipeline as pipeline
from pyspark.sql import functions as F

from daymosaic.llm import op2_mix as mix, op10_toxicity as tox
from daymosaic.llm.op8_shard import PLACES
from daymosaic.llm.tables import save
from tests.llm.test_op7_minhash import brute as groups
from tests.llm.test_op9_decontaminate import brute as hits


def best_sum(sizes, wanted):
    """Whole passes over all sizes, then the largest sum of some of them that still fits; sums are bits of a number."""
    if not sum(sizes):
        return 0
    passes, left = divmod(wanted, sum(sizes))
    sums = 1
    for size in sizes:
        sums |= sums << size
    return passes * sum(sizes) + (sums & ((1 << left + 1) - 1)).bit_length() - 1


def test_stages_on_whole_documents(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    columns = docs.columns
    stages = dict(pipeline.STAGES)
    ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())

    polite, _ = save(stages["toxicity"](spark, docs, data), "t")
    scores = {r["doc_id"]: r["score"] for r in tox.query(spark, data).collect()}
    assert ids(polite) == sorted(i for i, s in scores.items() if s < tox.THRESHOLD) and polite.columns == columns

    single, _ = save(stages["minhash_near_dedup"](spark, polite, data), "t")
    found = groups({r["doc_id"]: r["text"] for r in polite.collect()}, 80)
    assert ids(single) == sorted({root for _, root in found.values()}) and single.columns == columns

    clean, _ = save(stages["decontamination"](spark, single, data), "t")
    items = [tuple(r) for r in spark.read.parquet(f"{data}/benchmark.parquet").select("item_id", "text").collect()]
    marked = hits([(r["doc_id"], r["text"]) for r in single.collect()], items)
    assert ids(clean) == sorted(int(i) for i, _, n, _ in marked if not n) and clean.columns == columns

    mixed, _ = save(stages["mixing"](spark, clean, data), "t")
    assert mixed.columns == columns and set(ids(mixed)) <= set(ids(clean))
    plan = {r["source"]: r["target"] for r in mix.mix(clean, "doc_id", "source", "text").collect()}
    words = {s: 0 for s in plan}
    for r in mixed.select("source", mix.word_count(mixed["text"]).alias("w")).collect():
        words[r["source"]] += r["w"]
    own = {s: [] for s in plan}
    for r in clean.select("source", mix.word_count(clean["text"]).alias("w")).collect():
        own[r["source"]].append(r["w"])
    assert words == {s: best_sum(own[s], round(target)) for s, target in plan.items()}

    shards, _ = save(stages["sharding"](spark, mixed, data), "t")
    assert ids(shards) == ids(mixed)
    places = {}
    for r in shards.collect():
        places.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_stages_take_awkward_and_empty_documents(spark, data, awkward):
    for docs in (awkward, awkward.limit(0)):
        for _, stage in pipeline.STAGES:
            docs, seen = save(stage(spark, docs, data), "t")
    assert seen["rows"] == 0


def test_stages_take_columns_of_any_name(spark, data, awkward):
    docs = awkward
    for name in ("shard", "slot", "grown_shard", "__hits", "__score", "__row", "__copy", "__n", "__id", "row", "copies", "id", "kept_id", "place"):
        docs = docs.withColumn(name, F.concat(F.lit(f"{name}:"), F.coalesce("text", F.lit("-"))))
    columns = docs.columns
    for name, stage in pipeline.STAGES:
        docs, seen = save(stage(spark, docs, data), "t")
        if name != "sharding":
            assert docs.columns == columns
    assert seen["rows"] and docs.columns == [f"given_{c}" if c in PLACES else c for c in columns] + list(PLACES)
    assert docs.where("copies <> concat('copies:', coalesce(text, '-')) OR given_slot <> concat('slot:', coalesce(text, '-'))").count() == 0
