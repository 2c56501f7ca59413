"""Prefix trie of conversations by adaptive radix trees over fixed-width big-endian turn ids.

A turn's id is 16 bytes, the head of the SHA-256 of its role and text. A conversation is the
string of its turns' ids, cut into segments of ``SEGMENT`` turns, so no row grows
with a conversation. Equal segments under equal prefixes are added up before they
move. Each task then puts the segments it holds, in order, into adaptive radix trees
(node layouts for 4, 16, 48 and 256 children, compressed paths); a tree has
at most ``TREE_KEYS`` keys, so a prefix shared by a third of all conversations is
simply spread over many trees. A tree emits a row for each depth that is a whole number of turns;
rows of the same node from several trees are added up by a shuffle that combines first.

A node is known by its depth and the sum, modulo 2**48 and twice over, of a hash of every (place, id)
of its path. Such sums add up in any order: prefixes of very long conversations come from
running sums over blocks, without walking a conversation in one task.

Sums over subtrees need no walk either. Each node belongs to its smallest member. If a conversation m owns
``O(m)`` code points of nodes, the distinct nodes below v hold the sum of O over v's members, but for
the smallest member's nodes above v, which its length and v's depth in code points tell. So both
subtree columns are sums over members and come from the same trees in a second run over the owners only.

Defined results: rows without a conv_id take no part; null role or text is empty; a null turn comes first;
turns that tie follow by role, then id, so repeated rows stay, one after the other; a remainder takes the sign of its
dividend; conversations without turns are members of the root; an empty table gives no node; other
columns are not looked at.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daymosaic.llm.tables import save, table, with_places

ID_BYTES = 16
#: turns of a segment, segments of a block
SEGMENT = 32
BLOCK = 128
TREE_KEYS = 8192
MODULUS = 1 << 48
#: conversations are rebuilt from the first turns of the one that begins their hundred
FAMILY = 100
SHARED_TURNS = 6
#: characters of ids hashed at a time
CHUNK = 1 << 16

TRIE_NODE = ("depth bigint, a bigint, b bigint, parent_a bigint, parent_b bigint, size bigint, path_size bigint, "
             "first_sum bigint, second_sum bigint, least bigint")


# --- adaptive radix tree ----------------------------------------------------------------------

class _Sixteen:
    """Up to 4, then 16 children: their bytes in order beside them."""

    limit = 16

    def __init__(self):
        self.bytes, self.nodes = bytearray(), []

    def get(self, byte):
        at = self.bytes.find(byte)
        return self.nodes[at] if at >= 0 else None

    def put(self, byte, node):
        at = self.bytes.find(byte)
        if at >= 0:
            self.nodes[at] = node
            return self
        if len(self.nodes) == self.limit:
            return _FortyEight(self).put(byte, node)
        at = next((i for i, other in enumerate(self.bytes) if other > byte), len(self.bytes))
        self.bytes.insert(at, byte)
        self.nodes.insert(at, node)
        return self

    def __iter__(self):
        return iter(self.nodes)


class _Four(_Sixteen):
    limit = 4

    def put(self, byte, node):
        if len(self.nodes) < self.limit or byte in self.bytes:
            return super().put(byte, node)
        grown = _Sixteen()
        grown.bytes, grown.nodes = self.bytes, self.nodes
        return grown.put(byte, node)


class _FortyEight:
    """Up to 48 children: a place for each byte."""

    limit = 48

    def __init__(self, smaller):
        self.places, self.nodes = bytearray(256), list(smaller.nodes)
        for i, byte in enumerate(smaller.bytes):
            self.places[byte] = i + 1

    def get(self, byte):
        at = self.places[byte]
        return self.nodes[at - 1] if at else None

    def put(self, byte, node):
        at = self.places[byte]
        if at:
            self.nodes[at - 1] = node
            return self
        if len(self.nodes) == self.limit:
            return _Any(self).put(byte, node)
        self.nodes.append(node)
        self.places[byte] = len(self.nodes)
        return self

    def __iter__(self):
        return (self.nodes[at - 1] for at in self.places if at)


class _Any:
    """A child for any byte."""

    def __init__(self, smaller):
        self.nodes = [smaller.get(byte) for byte in range(256)]

    def get(self, byte):
        return self.nodes[byte]

    def put(self, byte, node):
        self.nodes[byte] = node
        return self

    def __iter__(self):
        return (n for n in self.nodes if n is not None)


class _Node:
    """The bytes from its parent's branch on (compressed path), its children, and the sums of keys that end here."""

    __slots__ = ("path", "children", "first", "second", "least", "sample")

    def __init__(self, path, sample, children=None, first=0, second=0, least=None):
        self.path, self.sample, self.children = path, sample, children if children is not None else _Four()
        self.first, self.second, self.least = first, second, least

    def add(self, first, second, least):
        self.first += first
        self.second += second
        self.least = least if self.least is None else min(self.least, least)


class RadixTree:
    """Byte strings with two sums and a least number each; a key may be the beginning of another."""

    def __init__(self):
        self.root, self.keys = _Node(b"", None), 0

    def insert(self, key: bytes, sample, first: int, second: int, least: int) -> None:
        node, at = self.root, 0
        self.keys += 1
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                node.children = node.children.put(key[at], _Node(key[at:], sample, None, first, second, least))
                return
            path, rest = child.path, len(key) - at
            if key.startswith(path, at):
                node, at = child, at + len(path)
                continue
            same = next((i for i in range(1, min(len(path), rest)) if path[i] != key[at + i]), min(len(path), rest))
            upper = _Node(path[:same], child.sample)
            child.path = path[same:]
            upper.children = upper.children.put(path[same], child)
            node.children = node.children.put(key[at], upper)
            node, at = upper, at + same
        node.add(first, second, least)

    def aligned(self, width: int):
        """(depth // width, sample, sums and least of all keys below) for each depth that is a multiple of ``width``."""
        stack, done = [(self.root, 0, False)], {}
        while stack:
            node, above, ready = stack.pop()
            if not ready:
                stack.append((node, above, True))
                stack.extend((c, above + len(node.path), False) for c in node.children)
                continue
            first, second, least = node.first, node.second, node.least
            for child in node.children:
                f, s, m = done.pop(id(child))
                first, second, least = first + f, second + s, m if least is None else min(least, m)
            done[id(node)] = first, second, least
            for depth in range(above // width + 1, (above + len(node.path)) // width + 1):
                yield depth, node.sample, first, second, least


def _trees(batches, segment, tree_keys):
    """Rows of TRIE_NODE of sorted segments (place, a, b, before, key, sizes, as_, bs, first_sum, second_sum, least)."""
    tree, at = RadixTree(), None
    out: list[list] = [[] for _ in range(10)]

    def emit():
        for turns, (sizes, ha, hb), first, second, least in tree.aligned(ID_BYTES):
            place, a, b, before = at
            row = (place * segment + turns, (a + ha[turns]) % MODULUS, (b + hb[turns]) % MODULUS,
                   (a + ha[turns - 1]) % MODULUS, (b + hb[turns - 1]) % MODULUS,
                   sizes[turns] - sizes[turns - 1], before + sizes[turns], first, second, least)
            for column, value in zip(out, row):
                column.append(value)

    def batch():
        made = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=[f.split()[0] for f in TRIE_NODE.split(", ")])
        for c in out:
            c.clear()
        return made

    def running(numbers):
        total, sums = 0, [0]
        for x in numbers:
            total += x
            sums.append(total)
        return sums

    for rows in batches:
        for place, a, b, before, key, sizes, ha, hb, first, second, least in zip(*(c.to_pylist() for c in rows.columns)):
            if (place, a, b, before) != at or tree.keys >= tree_keys:
                emit()
                tree, at = RadixTree(), (place, a, b, before)
            tree.insert(key, (running(sizes), running(ha), running(hb)), first, second, least)
            if len(out[0]) >= 20_000:
                yield batch()
    emit()
    yield batch()


def trie_nodes(segments: DataFrame, first: Column, second: Column) -> DataFrame:
    """TRIE_NODE rows, one a node: sums of ``first`` and ``second`` and the least conv_id over its members."""
    same = ["place", "a", "b", "before", "key", "sizes", "as_", "bs"]
    distinct = segments.groupBy(*same).agg(
        F.sum(first).alias("first_sum"), F.sum(second).alias("second_sum"), F.min("conv_id").alias("least"))
    in_order, segment, tree_keys = ["place", "a", "b", "key"], SEGMENT, TREE_KEYS
    parts = distinct.repartitionByRange(*in_order).sortWithinPartitions(*in_order).mapInArrow(
        lambda batches: _trees(batches, segment, tree_keys), TRIE_NODE)
    alike = ["parent_a", "parent_b", "size", "path_size"]
    return parts.groupBy("depth", "a", "b").agg(
        *[F.max(c).alias(c) for c in alike], F.sum("first_sum").alias("first_sum"), F.sum("second_sum").alias("second_sum"),
        F.min("least").alias("least"))


# --- conversations ----------------------------------------------------------------------------

def _family(conv: Column) -> Column:
    return conv - conv % FAMILY


def _shared(conv: Column) -> Column:
    """How many first turns of its family's conversation a conversation begins with."""
    return F.crc32(conv.cast("string").cast("binary")) % SHARED_TURNS


def numbered_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((conv_id, place, id, size) of every turn, (conv_id) of every conversation); places count from 0.

    Turns are numbered through a sort by ranges, so a conversation of any length is spread over tasks.
    """
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    known = conversations.where(F.col("conv_id").isNotNull())
    turns = known.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").alias("turn"), role.alias("role"),
        F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * ID_BYTES).alias("id"),
        F.length(text).cast("bigint").alias("size"))
    placed = with_places(turns, ["conv_id"], ["turn", "role", "id"], "trie-rows")  # nulls first
    return placed.select("conv_id", "place", "id", "size"), known.select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()


def rebuilt(placed: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns and conversations after each takes over the first turns of its family's conversation."""
    family, shared = _family(F.col("conv_id")), _shared(F.col("conv_id"))
    heads = placed.where((F.col("conv_id") % FAMILY == 0) & (F.col("place") < SHARED_TURNS - 1)).groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("place", "id", "size"))).alias("head")).withColumnRenamed("conv_id", "family")
    known, _ = save(convs.withColumns({"family": family, "shared": shared}).join(heads, "family", "left").select(
        "conv_id", "shared", F.when(F.col("shared") > 0, F.slice("head", 1, F.greatest("shared", F.lit(1)))).alias("head")
    ).withColumn("taken", F.coalesce(F.greatest(F.size("head"), F.lit(0)), F.lit(0)).cast("bigint")), "trie-conversations")
    borrowed = known.select("conv_id", F.explode("head").alias("t")).select("conv_id", "t.place", "t.id", "t.size")
    own = placed.where(F.col("place") >= shared).join(known.select("conv_id", "taken"), "conv_id").select(
        "conv_id", (F.col("place") - shared + F.col("taken")).alias("place"), "id", "size")
    return borrowed.unionByName(own), known.select("conv_id")


def segments_of(turns: DataFrame) -> DataFrame:
    """Segments with what comes before them: (conv_id, place, a, b, before, key, sizes, as_, bs, turns, a_, b_, size).

    ``a``, ``b`` and ``before`` sum up the hashes and code points of earlier segments; ``a_``, ``b_`` and
    ``size`` those of the segment itself.
    """
    def summed(numbers: str) -> Column:
        return F.aggregate(numbers, F.lit(0).cast("bigint"), lambda s, x: s + x)

    hashed = turns.select(
        "conv_id", F.floor(F.col("place") / (SEGMENT * BLOCK)).alias("block"), F.floor(F.col("place") / SEGMENT).alias("segment"),
        F.struct("place", "id", "size", *[F.xxhash64(F.lit(seed), "place", "id").bitwiseAND(F.lit(MODULUS - 1)).alias(c)
                                          for seed, c in ((11, "a"), (12, "b"))]).alias("t"))
    block = ["conv_id", "block"]
    gathered = hashed.repartition(*block).groupBy(*block, "segment").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    cut, _ = save(gathered.select(
        *block, F.col("segment").alias("place"), F.unhex(F.array_join("ts.id", "")).alias("key"), F.size("ts").cast("bigint").alias("turns"),
        F.col("ts.size").alias("sizes"), F.col("ts.a").alias("as_"), F.col("ts.b").alias("bs"),
    ).withColumns({"a_": summed("as_") % MODULUS, "b_": summed("bs") % MODULUS, "size": summed("sizes")}), "trie-segments")

    def so_far(window) -> dict:  # exact: sums of many hashes leave 64 bits
        total = {c: F.coalesce(F.sum(F.col(f"{c}_" if c != "before" else "size").cast("decimal(38,0)")).over(window), F.lit(0))
                 for c in ("a", "b", "before")}
        return {c: (v if c == "before" else v % MODULUS).cast("bigint") for c, v in total.items()}

    rows, sums = [Window.unboundedPreceding, -1], {"a": "a_", "b": "b_", "before": "size"}

    def so_far(window) -> dict:
        return {c: F.coalesce(_exact_sum(of).over(window), F.lit(0)).cast("decimal(38,0)") for c, of in sums.items()}

    narrow = cut.select(*block, "place", *sums.values())
    inside = narrow.withColumns(so_far(Window.partitionBy(*block).orderBy("place").rowsBetween(*rows))).where("place > 0")
    blocks = narrow.groupBy(*block).agg(*[_exact_sum(of).alias(of) for of in sums.values()]).withColumns(
        so_far(Window.partitionBy("conv_id").orderBy("block").rowsBetween(*rows))).select(
        *block, *[F.col(c).alias(f"block_{c}") for c in sums])
    earlier = inside.join(blocks, block).select("conv_id", "place", *[
        ((F.col(c) + F.col(f"block_{c}")) % (F.lit(MODULUS) if c != "before" else F.lit(1 << 62))).cast("bigint").alias(c) for c in sums])
    begin = cut.where("place = 0").withColumns({c: F.lit(0).cast("bigint") for c in sums})
    return begin.unionByName(cut.where("place > 0").join(earlier, ["conv_id", "place"])).drop("block")


def _exact_sum(numbers: str) -> Column:
    """Many hashes add up to more than 64 bits."""
    return F.sum(F.col(numbers).cast("decimal(20,0)"))


# --- ids of the conversations that end at a node ----------------------------------------------

def _joined(batches, chunk_size):
    """Chunks of comma-joined ids of sorted rows (depth, a, b, conv_id): the first id orders a node's chunks."""
    at, ids, size = None, [], 0

    def chunk():
        return pa.RecordBatch.from_pydict({"depth": [at[0]], "a": [at[1]], "b": [at[2]], "start": [ids[0]], "ids": [",".join(map(str, ids))]})

    for rows in batches:
        for *node, conv in zip(*(c.to_pylist() for c in rows.columns)):
            if node != at or size >= chunk_size:
                if ids:
                    yield chunk()
                at, ids, size = node, [], 0
            ids.append(conv)
            size += len(str(conv)) + 1
    if ids:
        yield chunk()


def _hashed(batches):
    """One SHA-256 a node over its chunks in order, fed chunk by chunk."""
    at, digest = None, None

    def row():
        return pa.RecordBatch.from_pydict({"depth": [at[0]], "a": [at[1]], "b": [at[2]], "ends_sha256": [digest.hexdigest()]})

    for rows in batches:
        for *node, _, ids in zip(*(c.to_pylist() for c in rows.columns)):
            if node != at:
                if digest is not None:
                    yield row()
                at, digest = node, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
    if digest is not None:
        yield row()


def ends_hashes(ends: DataFrame) -> DataFrame:
    """(depth, a, b, ends_sha256) of rows (depth, a, b, conv_id): ids joined in stretches first, so many are few rows."""
    node, chunk_size = ["depth", "a", "b"], CHUNK
    chunks = ends.select(*node, "conv_id").repartitionByRange(*node, "conv_id").sortWithinPartitions(*node, "conv_id").mapInArrow(
        lambda batches: _joined(batches, chunk_size), "depth bigint, a bigint, b bigint, start bigint, ids string")
    return chunks.repartition(*node).sortWithinPartitions(*node, "start").mapInArrow(
        _hashed, "depth bigint, a bigint, b bigint, ends_sha256 string")


# --- the trie ---------------------------------------------------------------------------------

def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row a node for ``turns`` (conv_id, place, id, size), places gapless from 0, and all conversations ``convs`` (conv_id)."""
    segments, _ = save(segments_of(turns), "trie-keys")
    zero = F.lit(0).cast("bigint")
    totals = segments.groupBy("conv_id").agg(
        F.sum("turns").alias("depth"), *[(_exact_sum(f"{c}_") % MODULUS).cast("bigint").alias(c) for c in ("a", "b")],
        F.sum("size").alias("length"))
    members, _ = save(convs.join(totals, "conv_id", "left").select(
        "conv_id", *[F.coalesce(c, zero).alias(c) for c in ("depth", "a", "b", "length")]), "trie-members")

    def with_root(nodes: DataFrame, rows: DataFrame, first: Column, second: Column) -> DataFrame:
        root = rows.agg(F.sum(first).alias("first_sum"), F.sum(second).alias("second_sum"), F.min("conv_id").alias("least"))
        return nodes.unionByName(root.where(F.col("least").isNotNull()).select(
            *[zero.alias(c) for c in ("depth", "a", "b", "size", "path_size")], "first_sum", "second_sum", "least"), allowMissingColumns=True)

    one, node, above = F.lit(1).cast("bigint"), ["depth", "a", "b"], [(F.col("depth") - 1).alias("depth"), F.col("parent_a").alias("a"), F.col("parent_b").alias("b")]
    long = segments.join(members.select("conv_id", "length"), "conv_id")
    found, _ = save(with_root(trie_nodes(long, one, F.col("length")), members, one, F.col("length")), "trie-nodes")
    children = found.where("depth > 0").groupBy(*above).agg(F.count(one).alias("n_children"))
    nodes, _ = save(found.join(children, node, "left").withColumn("n_children", F.coalesce("n_children", zero)), "trie-children")

    # what each conversation owns: code points of the nodes it is the smallest member of, and a leaf or none
    owned = nodes.groupBy(F.col("least").alias("conv_id")).agg(
        F.sum("size").alias("owned"), F.sum((F.col("n_children") == 0).cast("bigint")).alias("leaves"))
    owners, _ = save(owned.join(members.select("conv_id", "length"), "conv_id"), "trie-owners")
    below = with_root(trie_nodes(segments.join(owners.select("conv_id", "owned", "leaves"), "conv_id"), F.col("owned"), F.col("leaves")),
                      owners, F.col("owned"), F.col("leaves"))

    parents = nodes.select("depth", F.col("a").alias("parent_a"), F.col("b").alias("parent_b"), F.col("least").alias("parent_conv_id")).withColumn(
        "depth", F.col("depth") + 1)
    rest = F.col("length") - F.col("path_size") + F.col("size")  # code points of the smallest member from this node on
    paid = F.col("second_sum") - F.col("first_sum") * (F.col("path_size") - F.col("size"))
    distinct = F.col("below_owned") - F.col("owned") + rest
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return (
        nodes.join(below.select(*node, F.col("first_sum").alias("below_owned"), F.col("second_sum").alias("n_leaves")), node)
        .join(owners.select(F.col("conv_id").alias("least"), "owned", "length"), "least")
        .join(parents, ["depth", "parent_a", "parent_b"], "left")
        .join(ends_hashes(members), node, "left")
        .select(F.col("least").alias("conv_id"), "depth", "parent_conv_id", F.col("first_sum").alias("n_convs"), "n_children", "n_leaves",
                (paid - distinct).alias("saved_tokens"), F.coalesce("ends_sha256", nothing).alias("ends_sha256"))
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(*rebuilt(*numbered_turns(table(spark, sf_dir, "conversations"))))


SQL = f"""
WITH crc_table AS (SELECT list(list_reduce(list_prepend(n, range(0, 8)), lambda c, i:
        CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS v FROM range(0, 256) AS r(n)),
 t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
        PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS place FROM conversations WHERE conv_id IS NOT NULL),
 ids AS (SELECT DISTINCT conv_id, encode(CAST(conv_id AS VARCHAR)) AS w FROM t),
 c AS (SELECT conv_id, xor(list_reduce(list_prepend(4294967295,
        list_transform(range(1, 2 * octet_length(w), 2), lambda i: CAST('0x' || substr(hex(w), i, 2) AS BIGINT))),
        lambda c, x: xor(c >> 8, v[(xor(c, x) & 255) + 1])), 4294967295) % {SHARED_TURNS} AS h FROM ids, crc_table),
 r AS (SELECT c.conv_id, 0 AS part, place, role, text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % {FAMILY} AND place < h
    UNION ALL SELECT conv_id, 1, place, role, text FROM t JOIN c USING (conv_id) WHERE place >= h),
 l AS (SELECT conv_id, list({{'r': role, 't': text}} ORDER BY part, place) AS s FROM r GROUP BY conv_id
    UNION ALL SELECT conv_id, [] FROM c WHERE conv_id NOT IN (SELECT conv_id FROM r)),
 m AS (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS d FROM l),
 n AS (SELECT s[1:d] AS p, d, min(conv_id) AS conv_id, count(*) AS n_convs,
        sha256(coalesce(string_agg(CASE WHEN len(s) = d THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256
    FROM m GROUP BY s[1:d], d),
 k AS (SELECT p[1:d - 1] AS p, d - 1 AS d, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
 f AS (SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * length(p[d].t) END AS saved
    FROM n LEFT JOIN k USING (p, d)),
 u AS (SELECT p, d, saved, n_children, unnest(range(0, d + 1)) AS up FROM f),
 b AS (SELECT p[1:up] AS p, up AS d, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves FROM u GROUP BY ALL)
SELECT f.conv_id, f.d AS depth, parent.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, f.ends_sha256
FROM f JOIN b ON f.p = b.p AND f.d = b.d LEFT JOIN f AS parent ON f.d > 0 AND parent.p = f.p[1:f.d - 1] AND parent.d = f.d - 1"""
