"""Packing against exhaustive search and its own bounds; pieces against the tokenizer."""

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from daymosaic.llm import op13_packing as op
from daymosaic.llm.tables import save


def fewest(lengths, capacity):
    """By trying all ways, longest piece first."""
    lengths, best = sorted(lengths, reverse=True), [len(lengths)]

    def place(i, rooms):
        if len(rooms) >= best[0] and i < len(lengths):
            return
        if i == len(lengths):
            best[0] = min(best[0], len(rooms))
            return
        for j, room in enumerate(rooms):
            if room >= lengths[i] and room not in rooms[:j]:
                place(i + 1, [*rooms[:j], room - lengths[i], *rooms[j + 1:]])
        place(i + 1, [*rooms, capacity - lengths[i]])

    place(0, [])
    return best[0]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_bound_and_best_fit_enclose_the_fewest(lengths):
    x = np.array(lengths)
    kinds, counts = np.unique(x, return_counts=True)
    place = op.best_fit(x, 20)
    assert np.bincount(place, x).max() <= 20
    assert op.whole_bound(op.bound(kinds, counts, 20)) <= fewest(lengths, 20) <= place.max() + 1


def test_bound_beats_the_sum_of_lengths():
    assert op.bound(np.array([11]), np.array([6]), 20) == 6
    assert op.bound(np.array([7]), np.array([6]), 20) == 3  # two of 7 in 20, and the sum of lengths is 2.1


def test_best_fit_takes_the_fullest_with_room():
    assert op.best_fit(np.array([6, 5, 4, 5]), 10).tolist() == [0, 1, 0, 1]


def test_repack_keeps_former_sequences_unless_beaten():
    lengths = np.array([5, 5, 4, 3, 3])
    place, handed, gap = op.repack(lengths, np.array([0, 0, 1, 1, 1]), 10, 100)
    assert place.tolist() == [0, 0, 1, 1, 1] and not handed.any() and gap == 0
    place, _, _ = op.repack(lengths, np.array([0, 1, 2, 2, 2]), 10, 100)
    assert place.max() == 1


def packed(spark, lengths, **options):
    rows = [(i, 0, 0, int(n), i) for i, n in enumerate(lengths)]
    return op.pack(spark.createDataFrame(rows, op.PIECE), **options).collect()


def sound(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


@pytest.mark.parametrize("kind", ["small", "halves", "mixed", "equal"])
def test_groups_exchange_until_near_the_bound(spark, kind):
    rng = np.random.default_rng(4)
    lengths = {"small": rng.integers(1, 30, 3000), "halves": rng.integers(45, 60, 600), "mixed": rng.integers(1, 101, 2000), "equal": np.full(700, 34)}[kind]
    rows = packed(spark, lengths, capacity=100, group=150, fan=4, exchanged=100)
    assert sorted(r["doc_id"] for r in rows) == list(range(len(lengths)))
    kinds, counts = np.unique(lengths, return_counts=True)
    least, alone = op.whole_bound(op.bound(kinds, counts, 100)), int(op.best_fit(lengths, 100).max()) + 1
    used = sound(rows, 100)
    assert least <= used <= alone * 1.03  # groups are tiny here
    if kind in ("small", "equal"):
        assert used == least


def test_pieces_of_awkward_documents(spark, awkward):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(op.default_tokenizer())
    tokenizer.encode_special_tokens = True
    docs = awkward.selectExpr("*", "1 AS length", "2 AS grp", "3 AS `row`", "4 AS bin", "5 AS piece")
    rows = op.pack(op.pieces_of(docs, op.default_tokenizer())).collect()
    sound(rows, 4096)
    found = sorted((r["doc_id"] or -1, r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    expected = []
    for r in awkward.collect():
        ids = np.array([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1], "<u4")
        expected += [(r["doc_id"] or -1, i, s, len(ids[s: s + 4096]), zlib.crc32(ids[s: s + 4096].tobytes())) for i, s in enumerate(range(0, len(ids), 4096))]
    assert found == sorted(expected)
    assert max(r["piece"] for r in rows) > 5 and sum(r["length"] == 1 for r in rows) >= 3


#: what meets at borders: letters with and without marks of their own, signs, blanks, digits, other scripts
PARTS = st.sampled_from([*"aAzZhHtTjJkK019.,'!-_[]<|>#", "é", "É", "ß", "Σ", "σ", "\u0301", "\u0331", "\u030a", "日本", "٣", " ", "  ", "\n", "\t", "\x0b",
                         "\u00a0", "\u2003", "\u200d", "\x1c", "\x00", "\u212a", "😀", "'s", "n't", "<|endoftext|>", "w" * 70])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(PARTS, max_size=25).map("".join), min_size=1, max_size=5))
def test_stretches_give_the_ids_of_whole_texts(texts):
    stretches = op.stretches_of(op.default_tokenizer())
    ids, offsets = stretches.of(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])] == [
        stretches.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_stretches_forget(monkeypatch):
    monkeypatch.setattr(op, "REMEMBERED", 3)
    stretches = op.Stretches(op.default_tokenizer())
    for texts in (["a b c d e f"], ["a b", "g " + "h" * 80], [""], ["f e d", "a" * 90]):
        ids, _ = stretches.of(pa.array(texts).slice(0))
        assert ids.tolist() == [i for t in texts for i in stretches.tokenizer.encode(t, add_special_tokens=False).ids]


def test_texts_with_control_strings_are_ordinary(spark):
    rows = op.pieces_of(spark.createDataFrame([(1, "a <|endoftext|> b")], "doc_id bigint, text string"), op.default_tokenizer()).collect()
    assert rows[0]["length"] > 4


def test_empty_table_and_whole_query(spark, data):
    assert packed(spark, []) == []
    rows, _ = save(op.query(spark, data), "packed-all")
    docs = spark.read.parquet(f"{data}/documents.parquet")
    assert rows.where("piece = 0").count() == docs.count()
    n = rows.select("sequence_id").distinct().count()
    lengths = rows.groupBy("length").count().toPandas()
    least = op.whole_bound(op.bound(lengths["length"].to_numpy(), lengths["count"].to_numpy(), op.CAPACITY))
    assert n <= least + 1
