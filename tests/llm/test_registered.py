"""Registered queries against their SQL, and all of them for a stable schema."""

import pytest

import __spark_entry__ as registry
import corpus_pipeline
from check import compare, oracle_connection
from daymosaic.llm.registry import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, data, name):
    assert compare(spark, oracle_connection(data), data, name) == ""


def test_all_are_registered():
    assert set(QUERIES) <= set(registry.queries()) and set(ORACLES) <= set(registry.oracle_sql())
    for n in range(1, 14):
        assert [q for q in QUERIES if q.startswith(f"op{n}_")], n
    assert "pipeline" in QUERIES


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "minhash_near_dedup", "decontamination", "mixing", "sharding"]
