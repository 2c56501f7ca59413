"""The trie against prefixes counted one by one, and the tree against a dictionary."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from check import rows_of_spark
from daymosaic.llm import op11_prefix_trie as op

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).hexdigest(), text or ""))
    own = {c: [(r, t) for _, _, r, _, t in sorted(v)] for c, v in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = own.get(c - (abs(c) % 100) * (1 if c >= 0 else -1), [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    below = {p: [q for q in members if q[: len(p)] == p] for p in members}
    childless = {p for p in members if not any(len(q) == len(p) + 1 for q in below[p])}
    return sorted((
        min(m), len(p), min(members[p[:-1]]) if p else None, len(m), sum(len(q) == len(p) + 1 for q in below[p]),
        sum(q in childless for q in below[p]), sum((len(members[q]) - 1) * len(q[-1][1]) for q in below[p] if q),
        hashlib.sha256(",".join(map(str, sorted(c for c in m if len(whole[c]) == len(p)))).encode()).hexdigest(),
    ) for p, m in members.items())


def found(df):
    nodes = op.prefix_trie(*op.rebuilt(*op.numbered_turns(df))).collect()
    return sorted((r["conv_id"], r["depth"], r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"], r["ends_sha256"]) for r in nodes)


def test_awkward_conversations(spark):
    rows = [(100, 0, "user", "a"), (100, 1, "assistant", "b"), (100, None, "system", "first"), (101, 0, None, None), (101, 0, "user", ""),
            (101, 0, "user", ""), (102, 5, "user", "a"), (250, 0, "user", "x"), (-7, 0, "user", "été 日本"), (-107, 1, "user", "z"), (-100, 1, "user", "q"),
            (None, 0, "user", "lost"), (103, 0, "user", "a"), (103, 1, "assistant", "b"), (104, 0, "user", "a" * 5000)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_random_conversations_with_shared_beginnings(spark, monkeypatch):
    monkeypatch.setattr(op, "TREE_KEYS", 7)  # a prefix is spread over many trees
    monkeypatch.setattr(op, "CHUNK", 40)
    rng = random.Random(5)
    rows = [(c, t, rng.choice(["user", "assistant"]), rng.choice("abc") * rng.randint(0, 2)) for c in range(230) for t in range(rng.randint(1, 7))]
    rows += [(c, t, "user", "same") for c in range(1000, 1090) for t in range(3)]
    df = spark.createDataFrame(rows, SCHEMA).withColumnsRenamed({}).selectExpr("*", "'x' AS depth", "1 AS a", "2 AS place", "3 AS size")
    assert found(df) == brute(rows)


def test_long_conversations_cross_segments_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(op, "SEGMENT", 4)
    monkeypatch.setattr(op, "BLOCK", 3)
    rows = [(c, t, "user", f"t{t % 5}" if t < 40 or c != 201 else f"u{t}") for c in (200, 201, 202, 203) for t in range(70 - c % 100)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_turnless_and_empty(spark):
    short = [c for c in range(1, 99) if zlib.crc32(str(c).encode()) % 6 >= 1][:3]
    rows = [(c, 0, "user", "gone") for c in short]  # conversation 0 is absent and gives no turns
    only = found(spark.createDataFrame(rows, SCHEMA))
    assert only == brute(rows) and [r[1:6] for r in only] == [(0, None, 3, 0, 1)]
    assert found(spark.createDataFrame([], SCHEMA)) == []


@pytest.mark.parametrize("width", [1, 2])
def test_tree_grows_through_all_layouts(width):
    rng, tree, sums = random.Random(width), op.RadixTree(), defaultdict(lambda: [0, 0, None])
    keys = {bytes(rng.randrange(256) for _ in range(width * rng.randint(1, 3))) for _ in range(4000)}
    for i, key in enumerate(sorted(keys, key=lambda k: rng.random())):
        tree.insert(key, key, 1, i, i)
        for d in range(width, len(key) + 1, width):
            s = sums[key[:d]]
            s[0], s[1], s[2] = s[0] + 1, s[1] + i, i if s[2] is None else min(s[2], i)
    got = {sample[: d * width]: [f, s, m] for d, sample, f, s, m in tree.aligned(width)}
    assert got == dict(sums)
    layouts, stack = set(), [tree.root]
    while stack:
        node = stack.pop()
        layouts.add(type(node.children).__name__)
        stack.extend(node.children)
    assert layouts >= {"_Four", "_Any"}


def test_query_reads_whole_table(spark, data):
    names, rows = rows_of_spark(op.query(spark, data))
    root = [r for r in rows if r[names.index("depth")] == "0.0"]
    assert len(root) == 1 and root[0][names.index("n_convs")] == repr(float(spark.read.parquet(f"{data}/conversations.parquet").select("conv_id").distinct().count()))
