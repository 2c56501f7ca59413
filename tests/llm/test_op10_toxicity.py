import numpy as np
import pyarrow as pa

from daymosaic.llm import op10_toxicity as tox


def scored(model, texts):
    weights, constant = model
    return 1 / (1 + np.exp(-(constant + tox._sums(weights, *tox.places(pa.array(texts, pa.string()))))))


def labelled(rng, n, group_share):
    """Toxic texts have an insult; they name a group more often than others do."""
    texts, y = [], []
    for _ in range(n):
        toxic = rng.random() < 0.3
        words = [f"word{rng.integers(60)}" for _ in range(12)]
        if toxic:
            words[rng.integers(12)] = "idiot"
        if rng.random() < (group_share if toxic else 0.05):
            words[rng.integers(12)] = "muslims"
        texts.append(" ".join(words))
        y.append(int(toxic))
    return texts, np.array(y)


def test_counterfactuals_take_the_weight_off_identity_terms():
    texts, y = labelled(np.random.default_rng(0), 600, 0.6)
    rows = tox.training_rows(pa.array(texts))
    neutral = ["the muslims of word3 word4 met word5"]
    with_, without = (scored(tox.fit(*rows, y, strength=s), neutral)[0] for s in (20.0, 0.0))
    assert with_ < without and with_ < tox.THRESHOLD
    both = scored(tox.fit(*rows, y, strength=20.0), ["you idiot word1", "word1 word2"])
    assert both[0] > 0.5 and both[1] < 0.1


def test_swaps_are_words_of_letters():
    to = tox.swaps()
    assert tox.counterfactual("Muslims, women2men; gays été", to) == "christians, men2woman; gays été"
    assert tox.counterfactual("", to) == "" and tox.counterfactual("idiots", to) == "idiots"


def test_inflected_and_repeated_words_share_features():
    where, first = tox.places(pa.array(["achlichkeit achlicher", "achlichung", None, ""], pa.string()))
    a, b = set(where[first[0]: first[1]]), set(where[first[1]: first[2]])
    assert len(a & b) >= 4 and len(a) > len(b) and first[2] == first[3] == first[4]


def test_awkward_rows_and_labels(spark, awkward):
    labels = spark.createDataFrame([(1, 1), (6, 0), (6, None), (None, 1), (999, 1)], "doc_id bigint, toxic int")
    rows = tox.score(awkward, tox.train(awkward, labels)).collect()
    assert len(rows) == 11 and all(0 <= r[tox.SCORE] <= 1 for r in rows)
    assert len({r[tox.SCORE] for r in rows if r["doc_id"] == 5}) == 1
    none = tox.score(awkward, tox.train(awkward, labels.limit(0))).collect()
    assert {round(r[tox.SCORE], 9) for r in none} == {tox.PRIOR}
    assert tox.without_toxic(awkward.limit(0), labels).count() == 0


def test_held_out_accuracy(spark):
    import os

    import pytest
    sf = "/root/testdata/sf0.01"
    if not os.path.isdir(sf):
        pytest.skip("needs the test tables")
    out = {r["doc_id"]: r for r in tox.query(spark, sf).collect()}
    truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [(out[i]["predicted"], t) for i, t in truth.items() if out[i]["held_out"]]
    clean = [p for p, t in held if t == 0]
    assert sum(clean) <= 0.02 * len(clean) and sum(p for p, t in held if t) >= 0.5 * sum(t for _, t in held)


def test_fit_reaches_the_minimum_a_dense_newton_method_finds():
    """The same loss written out over a dense matrix, minimised by another method: nearly the same loss and scores."""
    texts, y = labelled(np.random.default_rng(4), 500, 0.5)
    own, swapped = tox.training_rows(pa.array(texts))
    used = tox._select(own, y.astype(np.float32))
    x = np.array([np.isin(used, r) for r in own], float)
    change = np.array([x[i] - np.isin(used, s) for i, s in enumerate(swapped) if s is not None])

    def loss(w, b):
        z = x @ w + b
        return np.logaddexp(0, z).sum() - y @ z + tox.RIDGE / 2 * w @ w + tox.COUNTERFACTUAL * ((change @ w) ** 2).sum()

    w, b = np.zeros(len(used)), 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-(x @ w + b)))
        g = np.append(x.T @ (p - y) + tox.RIDGE * w + 2 * tox.COUNTERFACTUAL * change.T @ (change @ w), (p - y).sum())
        xb, d = np.column_stack([x, np.ones(len(x))]), p * (1 - p)
        h = xb.T @ (xb * d[:, None])
        h[:-1, :-1] += tox.RIDGE * np.eye(len(used)) + 2 * tox.COUNTERFACTUAL * change.T @ change
        step = np.linalg.solve(h + 1e-9 * np.eye(len(h)), g)
        w, b = w - step[:-1], b - step[-1]
    weights, constant = tox.fit(own, swapped, y)
    assert not np.delete(weights, used).any()
    assert loss(weights[used], constant) <= loss(w, b) * 1.02
    assert np.abs(scored((weights, constant), texts) - 1 / (1 + np.exp(-(x @ w + b)))).max() < 0.05
