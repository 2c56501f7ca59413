import collections
import math
import re
import zlib

import pytest
from pyspark.sql import functions as F

from daymosaic.llm import op3_lm as lm


def tokens(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower) + [1]


def brute(rows, trains, order, mu):
    """(n, known, train tokens, base, score) of each text, by counts in one place."""
    counts = collections.Counter()
    texts = [[0, *tokens(t)] for t in rows]
    for t, train in zip(texts, trains):
        if train:
            for k in range(1, order + 1):
                counts.update(tuple(t[i:i + k]) for i in range(len(t) - k + 1))
    single = {g[0]: c for g, c in counts.items() if len(g) == 1 and g != (0,)}
    total, distinct = sum(single.values()), len(single)
    out = []
    for t in texts:
        base = score = 0.0
        for i in range(1, len(t)):
            p = (single.get(t[i], 0) + 0.1) / (total + 0.1 * (distinct + 1))
            base += math.log10(p)
            for k in range(2, order + 1):
                if i - k + 1 >= 0:
                    p = (counts[tuple(t[i - k + 1:i + 1])] + mu * p) / (counts[tuple(t[i - k + 1:i])] + mu)
            score += math.log10(p)
        out.append((len(t) - 1, sum(w in single for w in t[1:]), total, base, score))
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_brute_force(spark, awkward, monkeypatch, order):
    monkeypatch.setattr(lm, "BLOCK_BYTES", 60_000)  # many blocks and parts
    monkeypatch.setattr(lm, "PART_KEYS", 20_000)
    train = F.coalesce(F.col("doc_id") % 3 != 0, F.lit(False))
    rows = awkward.select("doc_id", "text", train.alias("t")).collect()
    expected = brute([r["text"] for r in rows], [r["t"] for r in rows], order, 3.0)
    got = lm.scores(awkward, trains=train, order=order, mu=3.0).collect()
    rounded = lambda x: (*x[:3], round(x[3], 6), round(x[4], 6))
    assert sorted(rounded(e) for e in expected) == sorted(
        rounded((g["n_tokens"], g["n_known"], g["train_tokens"], g["base_score"], g["score"])) for g in got)


def test_next_words_share_all_probability(spark, documents):
    docs = documents([(1, "a b a b b", None, None, 0), (2, "b a", None, None, 0)])
    probe = documents([(10, "b", None, None, 0), (11, "b a", None, None, 0), (12, "b b", None, None, 0), (13, "b never", None, None, 0)])
    rows = {r["id"]: r["score"] for r in lm.scores(docs.unionByName(probe), trains=F.col("doc_id") < 10, mu=2.0).collect()}
    one = brute(["a b a b b", "b a", "b", "b a", "b b", "b never"], [True] * 2 + [False] * 4, 2, 2.0)
    assert [round(rows[10 + i], 9) for i in range(4)] == [round(o[4], 9) for o in one[2:]]
    # after b: a, b, the end, and all unseen words together with the base's mass for one
    total, seen = 9, {"a": 3, "b": 4, "end": 2}
    after = {"a": 2, "b": 1, "end": 1}
    base = {w: (c + 0.1) / (total + 0.4) for w, c in {**seen, "unseen": 0}.items()}
    assert abs(sum((after.get(w, 0) + 2.0 * p) / (4 + 2.0) for w, p in base.items()) - 1) < 1e-9


def test_contract_columns_and_held_out_gain(spark, data):
    out = lm.query(spark, data).collect()
    held = [r for r in out if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0) for r in out)
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_empty_table_and_no_training(spark, awkward):
    assert lm.scores(awkward.limit(0)).count() == 0
    rows = lm.scores(awkward, trains=F.lit(False)).collect()
    assert len(rows) == 11 and all(r["train_tokens"] == 0 and abs(r["base_score"]) < 1e-9 for r in rows)
