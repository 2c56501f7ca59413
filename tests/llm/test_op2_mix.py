import itertools

import numpy as np
from hypothesis import given, settings, strategies as st

from daymosaic.llm import op2_mix as mix


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 9), st.integers(1, 3)), min_size=1, max_size=5, unique_by=lambda x: x[0]), st.integers(0, 40))
def test_fit_is_the_nearest_sum_below(pairs, budget):
    lengths, counts = (np.array(x) for x in zip(*pairs))
    taken = mix.fit(lengths, counts, budget)
    assert (taken <= counts).all() and (taken >= 0).all()
    best = max(s for c in itertools.product(*[range(n + 1) for n in counts]) if (s := int(np.dot(c, lengths))) <= budget)
    assert int((taken * lengths).sum()) == best


def test_targets_share_the_excess_again():
    assert mix.targets([10, 10, 80], [5, 2, 1], 100) == [30.0, 30.0, 40.0]
    assert sum(mix.targets([100, 50, 7], [5, 2, 1], 157)) == 157
    assert mix.targets([], [], 0) == [] and mix.targets([0, 5], [5, 2], 5) == [0.0, 5.0]


def test_plan_meets_large_targets():
    rng = np.random.default_rng(1)
    lengths = np.unique(rng.integers(1, 3000, 400))
    counts = rng.integers(1, 500, len(lengths))
    total = int((lengths * counts).sum())
    for target in (total * 0.37, total * 1.5, total * 3, 9_000.0):
        passes, extra = mix.plan_source(lengths, counts, target, 3)
        assert (extra <= counts).all() and abs(int(((passes * counts + extra) * lengths).sum()) - target) <= 1


def test_mix_of_awkward_rows(spark, awkward):
    rows = mix.mix(awkward, "doc_id", "source", "text").collect()
    assert len(rows) == 11 and all(0 <= r["copies"] <= 3 for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r["source"], [r["target"], 0])[1] += r["copies"] * r["size"]
    assert set(by) == {"a", "b", None} and abs(sum(t for t, _ in by.values()) - sum(r["size"] for r in rows)) < 1e-6
    for target, taken in by.values():
        assert abs(target - taken) < 31
    again = mix.mix(awkward.repartition(3), "doc_id", "source", "text").collect()
    key = lambda rs: sorted((str(r["key"]), r["size"], r["copies"]) for r in rs)
    assert key(rows) == key(again)


def test_mixed_documents_repeat_rows(spark, awkward):
    from pyspark.sql import functions as F
    plan = mix.mix(awkward, "doc_id", "source", "text").agg(F.sum("copies")).first()[0]
    out = mix.mixed_documents(awkward)
    assert out.columns == awkward.columns and out.count() == plan
    assert mix.mixed_documents(awkward.limit(0)).count() == 0
