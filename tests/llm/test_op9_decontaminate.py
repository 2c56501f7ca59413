import re

import pytest

from daymosaic.llm import op9_decontaminate as clean


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(docs, items, n=10):
    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for item, t in items:
            v = words(t)
            k = min(n, len(v))
            windows = {tuple(v[j:j + k]) for j in range(len(v) - k + 1)} if k else set()
            for p in range(len(w) - k + 1) if k else ():
                if tuple(w[p:p + k]) in windows:
                    hit |= set(range(p, p + k))
                    found.add(str(item))
        out.append((str(i), len(w), len(hit), sorted(found)))
    return sorted(out)


ITEMS = [(1, "one two three four five six seven eight nine ten eleven"), (2, "été là"), (10, "Une, deux"), (3, ""), (4, None),
         (5, "two three four five six seven eight nine ten eleven twelve"), (5, "été là")]
DOCS = [(1, "x One-two THREE four/five six seven eight nine ten eleven twelve y"), (2, "one two three"), (3, None), (4, ""),
        (5, "une deux une deux. été là!"), (6, "is 日本 été " + "là " * 3000), (7, "one two three four five six seven eight nine ten " * 40), (None, "été là")]


@pytest.mark.parametrize("most", [clean.MAX_WINDOWS, 40])
def test_hits_equal_brute_force(spark, most):
    docs = spark.createDataFrame([(*d, "c") for d in DOCS], "doc_id bigint, text string, items string")
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = [(str(r["doc_id"]), r[clean.HITS]["n_words"], sum(s["last"] - s["first"] for s in r[clean.HITS]["spans"]), r[clean.HITS]["items"])
           for r in clean.mark(docs, bench, max_windows=most).collect()]
    assert sorted(got) == brute(DOCS, ITEMS)


def test_spans_and_documents_are_removed(spark):
    docs = spark.createDataFrame(DOCS, "doc_id bigint, text string")
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    cut = {r["doc_id"]: r["text"] for r in clean.without_spans(docs, bench).collect()}
    assert cut[1] == "x  y" and cut[2] == "one two three" and cut[3] is None and cut[5] == "!" and cut[7].strip() == ""
    assert sorted(r["doc_id"] for r in clean.without_hits(docs, bench).collect()) == [2, 3, 4]


def test_empty_sides(spark, awkward):
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert clean.without_hits(awkward.limit(0), bench).count() == 0
    assert clean.without_hits(awkward, bench.limit(0)).count() == 11


def test_repeated_documents_are_each_marked(spark):
    rows = [(1, "one two three four five six seven eight nine ten eleven")] * 3 + [(1, "one two")] * 2
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    bench = spark.createDataFrame(ITEMS[:1], "item_id bigint, text string")
    got = sorted((r[clean.HITS]["n_words"], len(r[clean.HITS]["spans"])) for r in clean.mark(docs, bench).collect())
    assert got == [(2, 0)] * 2 + [(11, 1)] * 3
    assert clean.without_hits(docs, bench).count() == 2
    empty = spark.createDataFrame([], "item_id bigint, text string")
    assert clean.without_hits(docs, empty).count() == 5
