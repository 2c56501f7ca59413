"""Mining against sorting all scores; products against exact integers; heaps against sorting."""

import random

import numpy as np
import pytest

from daymosaic.llm import op12_hard_negatives as op


def brute(rows):
    best = {}
    for vec, label, v in rows:
        if vec is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        new = ((label + 1) % 10 if vec % 7 == 0 else label, [int(np.floor(256 * float(np.float32(x)))) for x in v])
        best[vec] = min(best.get(vec, new), new)
    out = []
    for a, (label, q) in best.items():
        if a % 50:
            continue
        scored = [(-sum(x * y for x, y in zip(q, p)), c, other) for c, (other, p) in best.items() if c != a]
        for ps, positive, _ in sorted(x for x in scored if x[2] == label)[:5]:
            inside = sorted(x for x in scored if x[2] != label and 50 * -ps <= 100 * -x[0] <= 95 * -ps)[:3]
            out += [(a, positive, i + 1, n, -ps, -s) for i, (s, n, _) in enumerate(inside)]
    return sorted(out)


def mined(spark, rows):
    df = spark.createDataFrame([(v, lab, e, 1, "x") for v, lab, e in rows], "vec_id bigint, label int, embedding array<float>, q int, tile string")
    return sorted(tuple(r) for r in op.hard_negatives(df).collect())


@pytest.mark.parametrize("shape", [(1, 1, 1), (33, 64, 70), (65, 67, 129), (256, 64, 300)])
def test_strassen_is_exact(shape):
    rng, (m, k, n) = np.random.default_rng(sum(shape)), shape
    a, b = rng.integers(-2**25, 2**25, (m, k)), rng.integers(-2**25, 2**25, (k, n))
    assert (op.strassen(a, b, 8).astype(object) == a.astype(object) @ b.astype(object)).all()


def test_heaps_keep_the_best_whatever_the_order():
    rng = np.random.default_rng(3)
    scores, ids = rng.integers(0, 6, (9, 400)), rng.permutation(400)
    parts = [op.Heaps(9, 4) for _ in range(3)]
    for at in range(0, 400, 50):
        own = np.arange(at, at + 50)[np.argsort(ids[at: at + 50])]
        parts[at // 50 % 3].offer(np.arange(9), scores[:, own], ids[own])
    whole = op.Heaps(9, 4)
    for part in parts:
        whole.merge(np.arange(9), part.scores, part.ids)
    for row in range(9):
        assert list(zip(-whole.scores[row], whole.ids[row])) == sorted(zip(-scores[row], ids))[:4]


def test_windows_are_those_of_the_whole_numbers():
    numbers = np.array([-201, -7, 0, 1, 2, 19, 20, 101, 10**17, 2**62], np.int64)
    for number, low, high in zip(numbers.tolist(), *(w.tolist() for w in op.windows(numbers))):
        assert low == -(-50 * number // 100) and high == 95 * number // 100


def test_random_rows_with_ties_and_groups_of_copies(spark, monkeypatch):
    monkeypatch.setattr(op, "ANCHORS", 4)
    rng = random.Random(8)
    rows = [(i, rng.randrange(4), [rng.uniform(-1, 1) for _ in range(5)]) for i in range(300)]
    rows += [(i, i % 3, rows[50][2]) for i in range(300, 500)]
    assert mined(spark, rows) == brute(rows)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 0.5]), (1, 1, [1.0, 0.25]), (2, 2, [0.75, 0.0]), (2, 3, [0.0]), (2, 2, [0.75, 0.0]), (3, 2, []), (4, None, [1.0, 1.0]),
            (None, 2, [1.0, 1.0]), (5, 2, None), (6, 2, [nan, 1.0]), (8, 2, [inf, 1.0]), (9, 2, [None, 1.0]), (50, 9, [0.5]), (7, 0, [0.9, 0.1]),
            (100, 4, [1e30, -1e30]), (11, 5, [0.7, 0.1, 0.3])]
    tame = [r for r in rows if r[0] != 100]
    assert mined(spark, tame) == brute(tame)
    mined(spark, rows)  # beyond 64 bits: ends, whatever its products are
    assert mined(spark, []) == [] and mined(spark, [(1, 1, [1.0])]) == []
