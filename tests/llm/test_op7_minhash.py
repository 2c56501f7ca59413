import re
from collections import Counter

import numpy as np
import pytest

from daymosaic.llm import op7_minhash as dedup
from daymosaic.llm.grouping import components


def shingles(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return ({tuple(w[i:i + 5]) for i in range(len(w) - 4)} or {tuple(w)}) if w else set()


def brute(texts, percent):
    """Smallest id reachable over links between documents, by comparing all of them."""
    sets = {i: shingles(t) for i, t in texts.items()}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def near_copies(seed, n, length, edits):
    rng = np.random.default_rng(seed)
    base = [f"w{rng.integers(500)}" for _ in range(length)]
    out = []
    for _ in range(n):
        own = list(base)
        for p in rng.integers(0, length, rng.integers(0, edits + 1)):
            own[p] = f"e{rng.integers(10**6)}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("percent", [80, 85])
def test_groups_equal_brute_force(spark, documents, percent):
    texts = near_copies(1, 60, 150, 5) + near_copies(2, 40, 60, 2) + near_copies(3, 30, 12, 1) + ["x y", "x  Y", "x y z", "", "lone words here now today yes"]
    rows = [(i * 7 % 1009, t, None, None, 0) for i, t in enumerate(texts)]
    expected = brute({r[0]: r[1] for r in rows}, percent)
    got = dedup.near_duplicates(documents(rows), percent=percent).collect()
    assert {r["id"]: (r["n_shingles"], r["component_id"]) for r in got} == expected
    assert all(r["kept"] == (r["id"] == r["component_id"]) for r in got)


def test_rest_of_the_pairs_is_exact(spark, documents, monkeypatch):
    # without any leader round, the prefix filter alone has to find every link
    monkeypatch.setattr(dedup, "LEADER_ROUNDS", 1)
    texts = near_copies(5, 80, 100, 4)
    rows = [(i, t, None, None, 0) for i, t in enumerate(texts)]
    got = dedup.near_duplicates(documents(rows)).collect()
    assert {r["id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute(dict(enumerate(texts)), 85)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(4)
    shared, slots = rng.integers(0, 1 << 62, 600, dtype=np.uint64), 256
    for n in (20, 600):  # short sets take many steps, long ones few
        a, b = shared[:n], np.concatenate([shared[n // 5: n], rng.integers(0, 1 << 62, n // 5, dtype=np.uint64)])
        s = dedup.super_minhash(np.concatenate([a, b]), np.repeat([0, 1], n), 2, slots)
        truth = (n - n // 5) / (n + n // 5)
        assert np.isfinite(s).all() and abs((s[0] == s[1]).mean() - truth) < 0.12


def test_signature_equals_element_by_element_definition():
    rng, slots = np.random.default_rng(6), 16
    elements = rng.integers(0, 1 << 62, 9, dtype=np.uint64)
    expected = np.full(slots, np.inf)
    for e in elements:
        order = list(range(slots))
        for step in range(slots):
            value, place = dedup._drawn(np.array([e]), step, slots)
            order[step], order[place[0]] = order[place[0]], order[step]
            expected[order[step]] = min(expected[order[step]], value[0])
    assert (dedup.super_minhash(elements, np.zeros(9, int), 1, slots)[0] == expected).all()


def test_bands_follow_the_threshold():
    for percent in (80, 85, 95):
        assert (1 - (percent / 100) ** dedup.ROWS_PER_BAND) ** dedup.bands_for(percent) <= dedup.MISS


def test_awkward_rows(spark, awkward):
    got = Counter((r["id"], r["n_shingles"], r["component_id"], r["kept"]) for r in dedup.near_duplicates(awkward).collect())
    assert got[(1, 2, 1, True)] == 1 and got[(5, 2, 1, False)] == 2 and got[(None, 2, 1, False)] == 1
    assert got[(2, 0, 2, True)] == 1 and got[(6, 1, 6, True)] == 1 and got[(7, 1, 6, False)] == 1 and sum(got.values()) == 11
    assert dedup.near_duplicates(awkward.limit(0)).count() == 0


def test_one_row_of_each_group_stays(spark, awkward):
    left = dedup.without_near_duplicates(awkward)
    assert left.columns == awkward.columns
    assert sorted(str(r["doc_id"]) for r in left.collect()) == ["1", "2", "3", "4", "6", "8", "9"]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(30)] + [(7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{200 + i: 100 for i in range(30)}}
    assert components(spark.createDataFrame([(1, 1)], "a bigint, b bigint")) is None


def test_links_do_not_hang_on_the_size_of_leaders(spark, documents, monkeypatch):
    """Near copies whose buckets are led by a text of another size are compared all the same."""
    monkeypatch.setattr(dedup, "_sized_alike", lambda a, b, percent: dedup.F.lit(False))  # no leader has anything to offer
    texts = near_copies(5, 8, 80, 2)
    rows = [(i, t, None, None, 0) for i, t in enumerate(texts)]
    expected = brute({r[0]: r[1] for r in rows}, 85)
    assert len({root for _, root in expected.values()}) < len(rows)
    got = dedup.near_duplicates(documents(rows), percent=85).collect()
    assert {r["id"]: (r["n_shingles"], r["component_id"]) for r in got} == expected


def test_rows_that_share_an_id_join_their_groups(spark, documents):
    one, two, three = ("alpha beta gamma delta epsilon zeta", "one two three four five six", "red green blue white black grey")
    rows = [(3, one), (5, one), (5, two), (9, two), (9, three), (12, three), (20, "not like any of the others here")]
    got = dedup.near_duplicates(documents([(i, t, None, None, 0) for i, t in rows])).collect()
    assert {(r["id"], r["component_id"]) for r in got} == {(3, 3), (5, 3), (9, 3), (12, 3), (20, 20)}
    kept = dedup.without_near_duplicates(documents([(i, t, None, None, 0) for i, t in rows])).collect()
    assert sorted(r["doc_id"] for r in kept) == [3, 20]


def test_copies_without_an_id_leave_one(spark, documents):
    text, other = "alpha beta gamma delta epsilon zeta", "one two three four five six"
    rows = [(None, text, None, None, 0)] * 4 + [(None, other, None, None, 0)] * 3 + [(7, other, None, None, 0), (None, "", None, None, 0), (None, None, None, None, 0)]
    kept = dedup.without_near_duplicates(documents(rows)).collect()
    assert sorted((r["doc_id"] or -1, r["text"] or "") for r in kept) == sorted([(-1, text), (7, other), (-1, ""), (-1, "")])
