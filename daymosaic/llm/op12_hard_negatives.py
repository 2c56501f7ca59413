"""Hard negatives by Strassen products of int64 tiles, and heaps that merge.

Anchors are a stated query set. They are dealt into blocks of about ``ANCHORS`` by a hash; a
block is the only thing broadcast, so its size does not grow with the table. Each task runs a block's
tiles of ``ANCHOR_TILE`` anchors against tiles of ``ROW_TILE`` of its own rows: Strassen's recursion over
int64 matrices, padded with zeros to even sides, down to sides of ``LEAF``. Integer additions
wrap around, so a product that fits 64 bits is exact whatever its sums on the way are.

A first pass keeps a heap of the best positives of each anchor, from rows of the anchor's label only. The
merged heaps of a block come back to the driver, as many numbers as the block has anchors times
``POSITIVES``, and give each (anchor, positive) its window of scores. The second pass keeps a heap of the best
negatives of each window. A task gives one row a tile, with the heaps of the tile's anchors as
arrays; rows of a tile are merged one by one in a sorted stream, so no heaps are ever gathered.

Heaps order by score, largest first, then by id, smallest first. A heap is complete: a row is passed over only
when as many better ones are in it.

Defined results: rows with a null id, label or vector, or a component that is null or not finite, take no part;
of several rows with an id only the one with the smallest label, then vector, does, so repeats change
nothing; vectors of other lengths are padded with zeros, an empty one is zero; numbers beyond 64 bits are cut to
them and products are taken modulo 2**64; an anchor without positives or a window without rows gives no row; an
empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daymosaic.llm.tables import save, table

POSITIVES, NEGATIVES = 5, 3
#: per cent of the positive's score
LOW, HIGH = 50, 95
EVERY = 50
SCALE = 256
LABELS, MOVED = 10, 7

ANCHORS = 4096
ANCHOR_TILE, ROW_TILE, LEAF = 256, 1024, 32
#: score of an empty place of a heap
NOTHING = np.int64(-(2**63) + 1)
NO_ID = np.int64(2**63 - 1)

HEAPS = "tile bigint, scores array<bigint>, ids array<bigint>"


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b`` of integers with seven products of halves; odd sides get a line of zeros."""
    m, k, n = a.shape[0], a.shape[1], b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    if m % 2 or k % 2 or n % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
        b = np.pad(b, ((0, k % 2), (0, n % 2)))
        return strassen(a, b, leaf)[:m, :n]
    i, j, h = m // 2, k // 2, n // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :h], b[:j, h:], b[j:, :h], b[j:, h:]
    p1, p2, p3 = strassen(a11 + a22, b11 + b22, leaf), strassen(a21 + a22, b11, leaf), strassen(a11, b12 - b22, leaf)
    p4, p5 = strassen(a22, b21 - b11, leaf), strassen(a11 + a12, b22, leaf)
    p6, p7 = strassen(a21 - a11, b11 + b12, leaf), strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((m, n), a.dtype)
    out[:i, :h], out[:i, h:] = p1 + p4 - p5 + p7, p3 + p5
    out[i:, :h], out[i:, h:] = p2 + p4, p1 - p2 + p3 + p6
    return out


class Heaps:
    """The best ``k`` (score, id) of each of ``n`` queries, best first."""

    def __init__(self, n: int, k: int):
        self.scores, self.ids = np.full((n, k), NOTHING), np.full((n, k), NO_ID)

    def merge(self, rows, scores: np.ndarray, ids: np.ndarray) -> None:
        """Take in arrays (rows, any number) of further entries."""
        k = self.scores.shape[1]
        s, i = np.concatenate([self.scores[rows], scores], axis=1), np.concatenate([self.ids[rows], ids], axis=1)
        best = np.lexsort((i, -s), axis=1)[:, :k]
        self.scores[rows], self.ids[rows] = np.take_along_axis(s, best, 1), np.take_along_axis(i, best, 1)

    def offer(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Take in a tile: ``scores`` (rows, columns), NOTHING where there is no entry, ``ids`` (columns) in ascending order."""
        k = self.scores.shape[1]
        open_ = (scores != NOTHING) & (scores >= self.scores[rows, -1][:, None])
        if np.count_nonzero(open_) > 4 * k * len(rows) and scores.shape[1] > k:
            # no entry below the tile's own k-th best gets in
            among = np.where(open_, scores, NOTHING)
            open_ &= scores >= np.partition(among, scores.shape[1] - k, axis=1)[:, [scores.shape[1] - k]]
        r, c = np.nonzero(open_)
        if not len(r):
            return
        order = np.lexsort((c, -scores[r, c], r))
        r, c = r[order], c[order]
        place = np.arange(len(r)) - np.searchsorted(r, r)
        r, c, place = r[place < k], c[place < k], place[place < k]
        s, i = np.full((len(rows), k), NOTHING), np.full((len(rows), k), NO_ID)
        s[r, place], i[r, place] = scores[r, c], ids[c]
        touched = np.unique(r)
        self.merge(rows[touched], s[touched], i[touched])


# --- rows and anchors -------------------------------------------------------------------------

def usable_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, q): labels as moved, components as whole numbers; one row an id."""
    def finite(x: Column) -> Column:
        x = x.cast("double")
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))

    vec, label = F.col("vec_id").cast("bigint"), F.col("label").cast("bigint")
    rows = embeddings.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(
        F.forall("embedding", finite)).select(
        vec.alias("vec_id"), F.when(vec % MOVED == 0, (label + 1) % LABELS).otherwise(label).alias("label"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * F.lit(float(SCALE)))).alias("q"))
    one = rows.groupBy("vec_id").agg(F.min(F.struct("label", "q")).alias("v"))
    return one.select("vec_id", "v.label", "v.q")


def _matrix(column, width: int) -> np.ndarray:
    """Rows of a list column, padded with zeros to ``width``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), width), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


def _tiles(batches, width: int):
    """(ids, labels, vectors as columns) of tiles of a partition's rows, ids ascending within each."""
    for batch in batches:
        ids, labels = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        order, vectors = np.argsort(ids, kind="stable"), _matrix(batch.column(2), width)
        for at in range(0, len(ids), ROW_TILE):
            own = order[at: at + ROW_TILE]
            yield ids[own], labels[own], np.ascontiguousarray(vectors[own].T)


def _heap_rows(heaps: Heaps, per_anchor: int):
    """HEAPS rows: tiles of anchors, each anchor with ``per_anchor`` heaps."""
    step = ANCHOR_TILE * per_anchor
    for tile, at in enumerate(range(0, len(heaps.scores), step)):
        yield pa.RecordBatch.from_pydict({
            "tile": [tile], "scores": [heaps.scores[at: at + step].ravel()], "ids": [heaps.ids[at: at + step].ravel()]},
            pa.schema([("tile", pa.int64()), ("scores", pa.list_(pa.int64())), ("ids", pa.list_(pa.int64()))]))


def _merged(batches, k: int):
    """One row a tile from sorted HEAPS rows, merged as they come."""
    tile, heaps = None, None
    for batch in batches:
        for row in range(batch.num_rows):
            scores, ids = (batch.column(i)[row].values.to_numpy(zero_copy_only=False).reshape(-1, k) for i in (1, 2))
            if batch.column(0)[row].as_py() != tile:
                if heaps is not None:
                    yield tile, heaps
                tile, heaps = batch.column(0)[row].as_py(), Heaps(len(scores), k)
            heaps.merge(np.arange(len(scores)), scores, ids)
    if heaps is not None:
        yield tile, heaps


def _positives(block, batches):
    """Heaps of the best rows of each anchor's label but itself; anchors lie in order of their label."""
    ids, labels, vectors = block
    heaps = Heaps(len(ids), POSITIVES)
    for row_ids, row_labels, columns in _tiles(batches, vectors.shape[1]):
        for label in np.unique(row_labels):
            first, last = np.searchsorted(labels, [label, label + 1])
            of = row_labels == label
            own = np.ascontiguousarray(columns[:, of])
            for at in range(first, last, ANCHOR_TILE):
                rows = np.arange(at, min(at + ANCHOR_TILE, last))
                scores = strassen(vectors[rows], own)
                scores[ids[rows][:, None] == row_ids[of]] = NOTHING
                heaps.offer(rows, scores, row_ids[of])
    yield from _heap_rows(heaps, 1)


def windows(positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest whole score between LOW and HIGH per cent of ``positive``, without leaving 64 bits."""
    def share(percent, up):
        whole, rest = np.divmod(positive, 100)
        return whole * percent + ((rest * percent + (99 if up else 0)) // 100)

    return share(LOW, True), share(HIGH, False)


def _negatives(block, best, batches):
    """Heaps of the best rows of other labels in the window of each (anchor, positive)."""
    ids, labels, vectors = block
    low, high = windows(best.scores)
    low[best.scores == NOTHING] = NO_ID
    heaps = Heaps(len(ids) * POSITIVES, NEGATIVES)
    for row_ids, row_labels, columns in _tiles(batches, vectors.shape[1]):
        for at in range(0, len(ids), ANCHOR_TILE):
            rows = np.arange(at, min(at + ANCHOR_TILE, len(ids)))
            scores = strassen(vectors[rows], columns)
            scores[labels[rows][:, None] == row_labels] = NOTHING
            for p in range(POSITIVES):
                inside = (scores >= low[rows, p][:, None]) & (scores <= high[rows, p][:, None])
                heaps.offer(rows * POSITIVES + p, np.where(inside, scores, NOTHING), row_ids)
    yield from _heap_rows(heaps, POSITIVES)


MINED = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def _mined(block, best, batches):
    """Rows of MINED from merged heaps."""
    for tile, heaps in _merged(batches, NEGATIVES):
        query, rank = np.nonzero(heaps.scores != NOTHING)
        anchor, positive = np.divmod(query + tile * ANCHOR_TILE * POSITIVES, POSITIVES)
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (
            block[0][anchor], best.ids[anchor, positive], (rank + 1).astype(np.int32), heaps.ids[query, rank],
            best.scores[anchor, positive], heaps.scores[query, rank])], names=[c.split()[0] for c in MINED.split(", ")])


def hard_negatives(embeddings: DataFrame) -> DataFrame:
    """Rows of MINED for every anchor, each block of anchors against all rows."""
    spark = embeddings.sparkSession
    anchor = F.col("vec_id") % EVERY == 0
    rows, seen = save(usable_vectors(embeddings), "vectors", width=F.max(F.size("q")), anchors=F.count(F.when(anchor, 1)))
    blocks, width = -(-seen["anchors"] // ANCHORS), max(1, seen["width"] or 0)
    dealt = F.pmod(F.xxhash64("vec_id"), F.lit(max(1, blocks)).cast("bigint"))
    found = [spark.createDataFrame([], MINED)]
    for number in range(blocks):
        own = rows.where(anchor & (dealt == number)).toArrow()
        order = np.lexsort((own["vec_id"].to_numpy(), own["label"].to_numpy()))
        block = own["vec_id"].to_numpy()[order], own["label"].to_numpy()[order], _matrix(own["q"], width)[order]
        found.append(_mine_block(spark, rows, block))
    return found[0] if len(found) == 1 else _under_each_other(found[1:])


def _under_each_other(tables: list[DataFrame]) -> DataFrame:
    first, *rest = tables
    for other in rest:
        first = first.unionAll(other)
    return first


def _mine_block(spark: SparkSession, rows: DataFrame, block: tuple) -> DataFrame:
    def by_tile(heaps: DataFrame) -> DataFrame:
        return heaps.repartition("tile").sortWithinPartitions("tile")

    sent = spark.sparkContext.broadcast(block)
    parts = by_tile(rows.mapInArrow(lambda batches: _positives(sent.value, batches), HEAPS))

    def whole(batches):
        for tile, heaps in _merged(batches, POSITIVES):
            for made in _heap_rows(heaps, 1):
                yield made.set_column(0, "tile", pa.array([tile], pa.int64()))

    best = Heaps(len(block[0]), POSITIVES)
    for row in parts.mapInArrow(whole, HEAPS).toArrow().to_pylist():  # one row a tile of the block
        at = row["tile"] * ANCHOR_TILE
        scores = np.array(row["scores"], np.int64).reshape(-1, POSITIVES)
        best.scores[at: at + len(scores)], best.ids[at: at + len(scores)] = scores, np.array(row["ids"], np.int64).reshape(-1, POSITIVES)
    sent_best = spark.sparkContext.broadcast(best)
    parts = by_tile(rows.mapInArrow(lambda batches: _negatives(sent.value, sent_best.value, batches), HEAPS))
    mined, _ = save(parts.mapInArrow(lambda batches: _mined(sent.value, sent_best.value, batches), MINED), "mined")
    sent.destroy()
    sent_best.destroy()
    return mined


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"))


SQL = f"""
WITH e AS (SELECT vec_id, CASE WHEN vec_id % {MOVED} = 0 THEN (CAST(label AS BIGINT) + 1) % {LABELS} ELSE label END AS label,
        list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS q
    FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
 s AS (SELECT a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id, CAST(list_inner_product(a.q, c.q) AS BIGINT) AS score
    FROM e AS a JOIN e AS c ON a.vec_id % {EVERY} = 0 AND a.vec_id <> c.vec_id),
 p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES}),
 n AS (SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
        vec_id AS negative_id, positive_score, score AS negative_score FROM p JOIN s USING (anchor_id)
    WHERE NOT same AND {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score)
SELECT * FROM n WHERE rank <= {NEGATIVES}"""
