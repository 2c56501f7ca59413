"""Near-duplicate documents by SuperMinHash, banding, verification and union-find.

A document is the set of its distinct runs of five words (all its words when it
has fewer). For each element, SuperMinHash draws a random permutation of the
signature's slots step by step: step j offers the value j + r to the j-th
slot of the permutation. Values of a step are larger than those of all earlier
ones, so a document is done as soon as every slot holds a value below the
next step; long documents need one or two steps. The ranks an element offers
are correlated, a slot each, which gives signatures of lower variance than
independent hashes.

1. Documents with equal sets become one class, represented by its smallest id.
2. Signatures are cut into bands of ``ROWS_PER_BAND`` slots; as many bands that a pair at the
   threshold shares none with a probability of ``MISS`` at most.
3. Classes that share a bucket are linked to the bucket's leader when the exact
   similarity of their full sets reaches the threshold. This takes one pair a
   class, not all pairs of a bucket, and joins large groups of near copies.
   The first leader is the class that meets most others, which stands in the middle of its group.
4. Buckets that still hold more than one group get another leader, a few times.
5. Classes of buckets that are still apart are compared across groups, all of them: candidates are
   pairs that share one of the rare elements that similar sets must share (prefix filter), so pairs
   that cannot reach the threshold are not made, and no bucket is cut and no candidate dropped.

Groups are kept as tables (node, root) and merged by joins; the driver sees
counts only. Sets are made again for classes that share a bucket and are
never kept for the others.

Defined results: null, empty and wordless texts have size 0, are linked with
nothing and kept; repeated rows give repeated results; rows that share an id are
one document that is linked through any of its texts; a row with a null id
gets the group of its class and is not kept, unless no row of the class has an
id: then its group is null and it is kept; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymosaic.llm import texts
from daymosaic.llm.grouping import components, relabelled, with_roots
from daymosaic.llm.tables import hidden, save, table

SHINGLE = 5
PERCENT = 85
ROWS_PER_BAND = 6
MISS = 1e-6
LEADER_ROUNDS = 3
#: shingles whose permutations are held in memory at once
AT_ONCE = 1 << 17
_STEP = 0x9E3779B97F4A7C15


def bands_for(percent: int, rows: int = ROWS_PER_BAND, miss: float = MISS) -> int:
    """Bands a pair of this similarity shares none of with probability ``miss`` at most."""
    return max(1, math.ceil(math.log(miss) / math.log(1 - min(percent / 100, 0.99) ** rows)))


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes, first of each text and the end)."""
    words, offsets = texts.word_hashes(column)
    _, place = texts.window_starts(offsets, size)
    hashes = texts.sequence_hashes(words, place, size)
    windows = np.concatenate([[0], np.cumsum(np.maximum(np.diff(offsets) - size + 1, 0))])
    sets = []
    for i, n in enumerate(np.diff(offsets)):
        if n >= size:
            sets.append(np.unique(hashes[windows[i]: windows[i + 1]]))
        elif n:
            sets.append(texts.sequence_hashes(words, offsets[i: i + 1], int(n)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return np.concatenate([np.zeros(0, np.uint64), *sets]), np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)


def _drawn(elements: np.ndarray, step: int, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """(a number in [step, step + 1), a place in [step, slots)) for each element."""
    x = texts.mix(elements + np.uint64((_STEP * (step + 1)) % (1 << 64)))
    value = step + (x >> np.uint64(32)).astype(np.float64) / 4294967296.0
    place = step + (((x & np.uint64(0xFFFFFFFF)) * np.uint64(slots - step)) >> np.uint64(32)).astype(np.int64)
    return value, place


def super_minhash(elements: np.ndarray, owners: np.ndarray, n: int, slots: int) -> np.ndarray:
    """Signatures, one row for each of ``n`` sets; infinite for empty sets."""
    signature = np.full((n, slots), np.inf)
    flat = signature.reshape(-1)
    value, place = _drawn(elements, 0, slots)
    np.minimum.at(flat, owners * slots + place, value)
    open_sets = np.zeros(n, bool)
    open_sets[np.unique(owners)] = True
    open_sets &= signature.max(axis=1) >= 1
    held = open_sets[owners]
    e, o = elements[held], owners[held]
    order = np.tile(np.arange(slots, dtype=np.uint16), (len(e), 1))
    each = np.arange(len(e))
    order[each, place[held]] = 0  # the first swap; slot 0 of the permutation is used up
    for step in range(1, slots):
        if not len(e):
            break
        value, place = _drawn(e, step, slots)
        slot = order[each, place]
        order[each, place] = order[each, step]
        np.minimum.at(flat, o * slots + slot, value)
        left = np.flatnonzero(open_sets)
        open_sets[left] = signature[left].max(axis=1) >= step + 1
        held = open_sets[o]
        if not held.all():
            e, o, order = e[held], o[held], order[held]
            each = np.arange(len(e))
    return signature


def signatures(sets: np.ndarray, first: np.ndarray, slots: int) -> np.ndarray:
    """``super_minhash`` of many sets, so many at once that memory stays bounded."""
    n, out, a = len(first) - 1, [], 0
    while a < n:
        b = int(np.searchsorted(first, first[a] + AT_ONCE, "right")) - 1
        b = min(max(b, a + 1), n)
        owners = np.repeat(np.arange(b - a), np.diff(first[a: b + 1]))
        out.append(super_minhash(sets[first[a]: first[b]], owners, b - a, slots))
        a = b
    return np.concatenate(out) if out else np.zeros((0, slots))


def band_keys(signature: np.ndarray, rows: int = ROWS_PER_BAND) -> np.ndarray:
    """One 64-bit key for each band of each signature."""
    bits = np.ascontiguousarray(signature).view(np.uint64).reshape(len(signature), -1, rows)
    key = np.broadcast_to(np.arange(bits.shape[1], dtype=np.uint64), bits.shape[:2]) + np.uint64(1)
    for r in range(rows):
        key = texts.mix(key * np.uint64(0xD1342543DE82EF95) + bits[:, :, r])
    return key


def prints(sets: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two sums over mixed elements; with the size they stand for the set."""
    out = []
    for salt in (0x243F6A8885A308D3, 0x13198A2E03707344):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(texts.mix(sets ^ np.uint64(salt)), dtype=np.uint64)])
        out.append((total[first[1:]] - total[first[:-1]]).view(np.int64))
    return out[0], out[1]


def _signed(docs: DataFrame, bands: int, shingle: int) -> DataFrame:
    """(id, n_shingles, p1, p2, bands) of each document (id, text)."""
    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                ids, column = batch.column(0).slice(k, 256), batch.column(1).slice(k, 256)
                sets, first = shingle_sets(column, shingle)
                p1, p2 = prints(sets, first)
                size = np.diff(first)
                full = np.flatnonzero(size)
                keys = band_keys(signatures(sets, np.concatenate([[0], np.cumsum(size[full])]), bands * ROWS_PER_BAND))
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(np.where(size > 0, bands, 0))]), pa.int32()),
                    pa.array(keys.reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(size), pa.array(p1), pa.array(p2), lists],
                    names=["id", "n_shingles", "p1", "p2", "bands"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, n_shingles bigint, p1 bigint, p2 bigint, bands array<bigint>")


def _sets(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """(id, n, shingles) of the documents (id, text) that stand for a wanted class (rep, p1, p2)."""
    chosen = docs.join(wanted, F.col("id") == F.col("rep")).select("id", "text", "p1", "p2")

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                sets, first = shingle_sets(part.column(1), shingle)
                p1, p2 = prints(sets, first)
                same = np.flatnonzero((p1 == part.column(2).to_numpy()) & (p2 == part.column(3).to_numpy()))
                lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(sets.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(same)), pa.array(np.diff(first)[same]), lists.take(pa.array(same))],
                    names=["id", "n", "shingles"])

    kind = docs.schema["id"].dataType.simpleString()
    return chosen.mapInArrow(run, f"id {kind}, n bigint, shingles array<bigint>")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("id").alias("a"), F.col("n").alias("an"), F.col("shingles").alias("ash"))
    right = sets.select(F.col("id").alias("b"), F.col("n").alias("bn"), F.col("shingles").alias("bsh"))
    both = F.size(F.array_intersect("ash", "bsh"))
    return pairs.join(left, "a").join(right, "b").where(
        both * 100 >= (F.col("an") + F.col("bn") - both) * percent).select("a", "b")


def _sized_alike(a: str, b: str, percent: int):
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT,
                    shingle: int = SHINGLE) -> DataFrame:
    """(id, n_shingles, component_id, kept) of each row of ``docs``."""
    plain = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    signed, _ = save(_signed(plain, bands_for(percent), shingle), "signatures")
    same_set = ["n_shingles", "p1", "p2"]
    with_id = signed.where(F.col("id").isNotNull() & (F.col("n_shingles") > 0))
    classes, _ = save(with_id.groupBy(*same_set).agg(F.min("id").alias("rep"), F.first("bands").alias("bands")), "classes")
    groups = _linked(plain, classes, percent, shingle)
    shared = _through_ids(with_id, classes, same_set)
    if shared is not None:
        groups = _grown(groups, shared)
    found = classes.select(*[F.col(c).alias(f"c_{c}") for c in same_set], "rep")
    if groups is not None:
        found = with_roots(found, groups, "rep", "root")
    else:
        found = found.withColumn("root", F.col("rep"))
    matched = signed.drop("bands").join(found, [F.col(c) == F.col(f"c_{c}") for c in same_set], "left")
    component = F.coalesce("root", "id")
    return matched.select(
        "id", "n_shingles", component.alias("component_id"),
        F.when(F.col("root").isNull(), F.lit(True)).otherwise(F.coalesce(F.col("id") == F.col("root"), F.lit(False))).alias("kept"))


def _grown(groups: DataFrame | None, edges: DataFrame) -> DataFrame | None:
    """``groups`` after merging along ``edges`` (a, b) between representatives."""
    if groups is not None:
        edges = with_roots(with_roots(edges, groups, "a", "a"), groups, "b", "b")
    roots = components(edges)
    return groups if roots is None else save(relabelled(groups, roots), "groups")[0]


def _through_ids(with_id: DataFrame, classes: DataFrame, same_set: list[str]) -> DataFrame | None:
    """Edges (a, b) between the classes of rows that share an id; none where ids are all different."""
    repeated, seen = save(with_id.groupBy("id").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("id"), "repeated")
    if not seen["rows"]:
        return None
    of = with_id.join(repeated, "id").join(classes.select(*same_set, "rep"), same_set).select("id", "rep").distinct()
    least = of.groupBy("id").agg(F.min("rep").alias("b"))
    return save(of.join(least, "id").where(F.col("rep") != F.col("b")).select(F.col("rep").alias("a"), "b").distinct(), "through-ids")[0]


def _linked(plain: DataFrame, classes: DataFrame, percent: int, shingle: int) -> DataFrame | None:
    """(node, root) over class representatives."""
    in_buckets = classes.select("rep", F.col("n_shingles").alias("n"), F.explode("bands").alias("key"))
    shared = in_buckets.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > 1)
    members, seen = save(in_buckets.join(shared, "key"), "buckets")
    if not seen["rows"]:
        return None
    # who meets most others stands in the middle of its group
    met, _ = save(members.groupBy("rep").agg(F.sum("members").alias("met")), "met")
    members, _ = save(members.drop("members").join(met, "rep"), "members")
    wanted = classes.select("rep", "p1", "p2").join(members.select("rep").distinct(), "rep")
    sets, _ = save(_sets(plain, wanted, shingle), "sets")
    groups, tried = None, None

    def labelled():
        if groups is None:
            return members.withColumn("label", F.col("rep"))
        return with_roots(members, groups, "rep", "label")

    def grown(edges):
        return _grown(groups, edges)

    def apart(by: DataFrame, order) -> DataFrame:
        """Buckets with more than one group and the leader ``order`` puts first."""
        first = F.min(F.struct(order.alias("order"), F.col("rep").alias("leader"), F.col("n").alias("leader_n"),
                               F.col("label").alias("leader_label")))
        return by.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), first.alias("first")).where(
            F.col("low") != F.col("high")).select("key", "first.*")

    for turn in range(LEADER_ROUNDS):
        by = labelled()
        order = -F.col("met") if turn == 0 else F.xxhash64(F.lit(turn), "rep")
        offers = by.join(apart(by, order), "key").where(
            (F.col("label") != F.col("leader_label")) & _sized_alike("n", "leader_n", percent))
        pairs = offers.groupBy(F.col("rep").alias("a")).agg(F.min(F.struct("order", F.col("leader").alias("b"))).alias("x")).select(
            "a", "x.b")
        pairs, seen = save(pairs, "pairs")
        if not seen["rows"]:  # leaders of another size offer nothing; what is still apart is compared below
            break
        tried = pairs if tried is None else tried.unionByName(pairs)
        groups = grown(save(_verified(pairs, sets, percent), "links")[0])

    by = labelled()
    left_over = by.join(apart(by, F.col("rep")).select("key"), "key").select(F.col("rep").alias("id"), "label").distinct()
    pairs = _likely(sets.join(left_over, "id"), percent)
    if tried is not None:
        done = tried.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        pairs = pairs.join(done, ["a", "b"], "left_anti")
    pairs, seen = save(pairs, "rest")
    if not seen["rows"]:
        return groups
    return grown(save(_verified(pairs, sets, percent), "links")[0])


def _likely(sets: DataFrame, percent: int) -> DataFrame:
    """All pairs (a, b), a > b, of sets (id, label, n, shingles) with different labels that can be similar enough.

    Two sets of n and m elements that share at least s of them have an element in common
    among the first n - s + 1 of the one and the first m - s + 1 of the other, in
    any order of all elements. In the order from rare to frequent, what near copies do not share comes first.
    """
    own = sets.withColumn("set", F.xxhash64("shingles"))
    each, _ = save(own.select("id", "set", "label", "n", F.explode("shingles").alias("e")), "elements")
    often = each.groupBy("e").agg(F.count(F.lit(1)).alias("times")).where(F.col("times") > 1)
    # elements of one set alone come first of all, and match nothing
    inside = F.sort_array(F.collect_list(F.struct("times", "e")))
    ranked = each.join(often, "e").groupBy("id", "set", "label", "n").agg(inside.alias("x")).withColumn(
        "alone", F.col("n") - F.size("x"))
    firsts = F.floor(F.col("n") * (100 - percent) / 100) + 1 - F.col("alone")
    rows, _ = save(ranked.where(firsts > 0).select(
        "id", "label", "n", "alone", F.posexplode(F.slice("x", F.lit(1), firsts.cast("int"))).alias("at", "x")
    ).select("id", "label", "n", (F.col("alone") + F.col("at") + 1).alias("place"), "x.e"), "prefixes")
    left = rows.select("e", *[F.col(c).alias(f"a_{c}") for c in ("id", "label", "n", "place")])
    right = rows.select("e", *[F.col(c).alias(f"b_{c}") for c in ("id", "label", "n", "place")])
    least = F.ceil((F.col("a_n") + F.col("b_n")) * percent / (100 + percent))
    return left.join(right, "e").where(
        (F.col("a_id") > F.col("b_id")) & (F.col("a_label") != F.col("b_label"))
        & (F.col("a_n") - F.col("a_place") + 1 >= least) & (F.col("b_n") - F.col("b_place") + 1 >= least)
    ).select(F.col("a_id").alias("a"), F.col("b_id").alias("b")).distinct()


def without_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 80,
                            shingle: int = SHINGLE) -> DataFrame:
    """One row of each group, that with the smallest id; the columns of ``docs``.

    Rows without an id are documents of their own, after all others; texts without words all stay.
    """
    plain, back = hidden(docs)
    own, words = F.col(back[key]), F.col(back[text])
    if not plain.where(own.isNull()).isEmpty():
        # ids of their own for rows that have none; written, so that they stay
        numbered, _ = save(plain.withColumn("row", F.monotonically_increasing_id()), "dedup-rows")
        kind = numbered.schema[back[key]].dataType
        if isinstance(kind, T.IntegralType):
            spare, typed = F.lit((1 << 63) - 1) - F.col("row"), F.col(back[key]).cast("bigint")
        else:
            spare, typed = F.concat(F.lit("\U0010ffff"), F.lpad(F.col("row").cast("string"), 20, "0")), F.col(back[key]).cast("string")
        plain, named = numbered.withColumn("id", F.coalesce(typed, spare)), "id"
    else:
        named = back[key]
    kept = near_duplicates(plain, named, back[text], percent, shingle).where("kept").select(F.col("id").alias("kept_id")).distinct()
    found = plain.join(kept, F.col(named) == F.col("kept_id"))
    one = found.withColumn("n", F.row_number().over(Window.partitionBy("kept_id").orderBy(F.xxhash64(words)))).where("n = 1")
    return one.select(*[F.col(back[c]).alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")
