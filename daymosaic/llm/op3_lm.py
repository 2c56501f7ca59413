"""Language-model scores by a weighted backoff automaton of smoothed n-grams.

A text is its words and one end; before the first word stands a start that is
context only. The model is a Dirichlet-smoothed n-gram model: with the count c and
the context's count C, P(w | h) = (c + mu * P(w | shorter h)) / (C + mu), down to the
base (c + 0.1) / (N + 0.1 (V + 1)) over single tokens. As an automaton, every
context seen in training is a state; a seen n-gram is an arc that weighs log10 P; every state
has a failure arc to the state without its first word, weighing log10 mu / (C + mu).
Texts are traversed once, left to right: the state is carried, arcs and
failure arcs add their weights, and the sum is the text's log10 probability.

The model grows with the corpus, so it is never held in one place:

1. Documents are dealt into blocks of about ``BLOCK_BYTES`` of text. A block counts its distinct n-grams,
   with 0 for those that only texts outside the training set have, and sends them as
   sorted runs of 64-bit keys to the parts of the key space.
2. A part adds up the counts of its keys and answers each block by position: one bit for each of the
   keys the block sent, in their order, and the totals of those whose count differs from the block's own. The block makes
   its keys again anyway.
3. A block has then exactly that part of the automaton its texts can reach, and traverses them.

Keys are hashes of 62 bits. Two n-grams of a model of a billion share one with a probability of
about a tenth; a shared key would change the score of the texts with those
n-grams only.

Defined results: null and blank texts consist of the end alone; a null id is
hashed as 0, so it is held out; repeated rows count as often as they are there and are
scored each; without training texts every token has the base 1 / (V + 1) = 1;
an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymosaic.llm import texts
from daymosaic.llm.tables import id_crc, save, table

ORDER = 2
SMOOTHING = 0.1
#: weight of the shorter context, in tokens
MU = 400.0
BLOCK_BYTES = 5_000_000
PART_KEYS = 700_000
#: shortest mean stretch of bytes a token takes; only the number of parts depends on it
TOKEN_BYTES = 6

_START, _END = np.uint64(0x5354415254), np.uint64(0x454E44)


def padded(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(start, words, end of each text one after another, first of each text and the end)."""
    words, offsets = texts.word_hashes(column)
    n = len(offsets) - 1
    first = offsets + 2 * np.arange(n + 1)
    tokens = np.empty(first[-1], np.uint64)
    inside = np.ones(len(tokens), bool)
    inside[first[:-1]] = inside[first[1:] - 1] = False
    tokens[inside] = words
    tokens[first[:-1]], tokens[first[1:] - 1] = _START, _END
    return tokens, first


def gram_keys(tokens: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(key, place of the last token) of every run of ``k`` tokens; bit 1 tells single tokens, bit 0 is free."""
    _, place = texts.window_starts(first, k)
    if k == 1:
        place = np.delete(place, first[:-1])  # the start is context only
    keys = texts.sequence_hashes(tokens, place, k) & ~np.uint64(3)
    return (keys | np.uint64(2) if k == 1 else keys), place + k - 1


def counted(keys: np.ndarray, trained: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys in order, times in training texts)."""
    flagged = np.sort(keys | trained.astype(np.uint64))
    plain = flagged >> np.uint64(1)
    start = np.flatnonzero(np.append(True, plain[1:] != plain[:-1])) if len(plain) else np.zeros(0, np.int64)
    counts = np.add.reduceat((flagged & np.uint64(1)).astype(np.int64), start) if len(start) else np.zeros(0, np.int64)
    return plain[start] << np.uint64(1), counts


def block_counts(column: pa.Array, train: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of all orders in a block of texts, with their training counts."""
    keys, trained = [], []
    for a in range(0, len(column), 512):
        tokens, first = padded(column.slice(a, 512))
        of_text = np.repeat(train[a: a + 512], np.diff(first))
        for k in range(1, order + 1):
            own, last = gram_keys(tokens, first, k)
            keys.append(own)
            trained.append(of_text[last])
    return counted(np.concatenate(keys), np.concatenate(trained))


def packed(numbers: np.ndarray) -> bytes:
    """Numbers byte by byte of the same weight, compressed: of sorted keys the leading bytes vanish."""
    plain = np.ascontiguousarray(numbers).view(np.uint8).reshape(len(numbers), -1).T.tobytes()
    return len(plain).to_bytes(8, "little") + pa.compress(plain, "zstd", asbytes=True)


def unpacked(data: bytes, kind: str) -> np.ndarray:
    plain = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)
    return np.frombuffer(plain, np.uint8).reshape(np.dtype(kind).itemsize, -1).T.copy().view(kind).ravel()


def parcels(docs: DataFrame) -> DataFrame:
    """(block, parcel): the rows of ``docs`` (with a column block), those of a block packed and compressed together.

    Texts move twice, once to be counted and once to be scored; parcels take half the room of rows.
    """
    def run(batches):
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for batch in batches:
            blocks = batch.column("block").to_numpy()
            order = np.argsort(blocks, kind="stable")
            cuts = np.flatnonzero(np.append(True, blocks[order][1:] != blocks[order][:-1])) if len(order) else []
            rows = batch.drop_columns(["block"])
            names, parts = [], []
            for a, b in zip(cuts, [*cuts[1:], len(order)]):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, rows.schema, options=options) as out:
                    out.write_batch(rows.take(pa.array(order[a:b])))
                names.append(int(blocks[order[a]]))
                parts.append(sink.getvalue().to_pybytes())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(parts, pa.binary())], names=["block", "parcel"])

    return docs.mapInArrow(run, "block bigint, parcel binary")


def opened(parcels_: pa.ChunkedArray) -> pa.Table:
    return pa.concat_tables([pa.ipc.open_stream(p.as_buffer()).read_all() for p in parcels_]).combine_chunks()


def _part_edges(parts: int) -> np.ndarray:
    return np.array([(p << 64) // parts for p in range(1, parts)], np.uint64)


class Automaton:
    """States, arcs and failure arcs for the n-grams of one block.

    An entry is a distinct n-gram of the block. ``arc[e]`` is the log weight of
    reading its last word after the others, ``seen[e]`` whether that arc (and, as
    a context, the state) exists, ``failure[e]`` the log weight of the state's failure arc.
    """

    def __init__(self, keys: np.ndarray, counts: np.ndarray, total: int, distinct: int, order: int, mu: float):
        self.keys, self.counts, self.order, self.mu = keys, counts, order, mu
        self.seen = counts > 0
        self.failure = np.log10(mu / (counts + mu))
        self.base = np.log10((counts + SMOOTHING) / (total + SMOOTHING * (distinct + 1)))
        end = texts.sequence_hashes(np.array([_END]), np.zeros(1, np.int64), 1) & ~np.uint64(3) | np.uint64(2)
        where = np.searchsorted(keys, end)[0]
        #: texts seen in training: the count of the start as a context
        self.starts = int(counts[where]) if where < len(keys) and keys[where] == end[0] else 0

    def entries(self, tokens: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
        """For each order, the entry of the n-gram that ends at each place; -1 where there is none."""
        out = []
        for k in range(1, self.order + 1):
            keys, last = gram_keys(tokens, first, k)
            at = np.full(len(tokens), -1, np.int64)
            at[last] = np.searchsorted(self.keys, keys)
            out.append(at)
        return out

    def traverse(self, tokens: np.ndarray, first: np.ndarray, at: list[np.ndarray]) -> np.ndarray:
        """log10 probability of each text; all texts of the batch take a step at a time, left to right."""
        length = np.diff(first)
        turn = np.argsort(-length, kind="stable")  # the texts that still have tokens come first
        length, begin = length[turn], first[:-1][turn]
        arcs = self._arcs(at)
        n = len(turn)
        score = np.zeros(n)
        # the state: how many of the last tokens are its context; after the start, the start
        state = np.full(n, min(1, self.order - 1), np.int64)
        if not self.starts:
            state[:] = 0
        for step in range(1, int(length[0]) if n else 0):
            live = int(np.searchsorted(-length, -step, "left"))
            place, held = begin[:live] + step, state[:live].copy()
            open_ = np.arange(live)
            while len(open_):
                k = held[open_]  # try the arc of k + 1 tokens
                arc_entry, weight = np.full(len(open_), -1, np.int64), np.zeros(len(open_))
                for o in range(self.order):
                    own = np.flatnonzero(k == o)
                    if len(own):
                        p = place[open_[own]]
                        arc_entry[own], weight[own] = at[o][p], arcs[o][p]
                taken = (k == 0) | self.seen[arc_entry]
                score[open_[taken]] += weight[taken]
                held[open_[taken]] += 1
                failing = open_[~taken]
                score[failing] += self._failure(at, place[failing] - 1, held[failing], begin[failing])
                held[failing] -= 1
                open_ = failing
            # on to the longest suffix that is a state
            held = np.minimum(held, self.order - 1)
            for o in range(self.order - 1, 0, -1):
                own = np.flatnonzero(held == o)
                entry = at[o - 1][place[own]]
                gone = own[~self.seen[entry]]
                held[gone] -= 1
            state[:live] = held
        out = np.zeros(n)
        out[turn] = score
        return out

    def _failure(self, at, place, k, begin) -> np.ndarray:
        """Failure weight of the state of ``k`` tokens that ends at ``place``."""
        weight = np.zeros(len(place))
        for o in range(1, self.order):
            own = np.flatnonzero(k == o)
            entry = at[o - 1][place[own]]
            weight[own] = np.where(entry >= 0, self.failure[entry], np.log10(self.mu / (self.starts + self.mu)))
        return weight

    def _arcs(self, at: list[np.ndarray]) -> list[np.ndarray]:
        """For each order, log10 P of the token at each place after its context of that order."""
        lower = np.where(at[0] >= 0, self.base[at[0]], 0.0)
        out = [lower]
        for k in range(2, self.order + 1):
            entry, p = at[k - 1], 10.0 ** out[-1]
            context = np.full(len(entry), -1, np.int64)
            context[1:] = at[k - 2][:-1]
            count = np.where(entry >= 0, self.counts[entry], 0)
            whole = np.where(context >= 0, self.counts[context], self.starts if k == 2 else 0)
            out.append(np.where(entry >= 0, np.log10((count + self.mu * p) / (whole + self.mu)), out[-1]))
        return out


def scores(docs: DataFrame, key: str = "doc_id", text: str = "text", trains=None, order: int = ORDER, mu: float = MU) -> DataFrame:
    """(id, trained, n_tokens, n_known, train_tokens, base_score, score) of each row of ``docs``.

    ``trains`` is a boolean column: whether the model learns from the text; all by default.
    """
    train = F.lit(True) if trains is None else trains
    plain = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                        F.coalesce(train, F.lit(False)).alias("train"))
    volume = plain.agg(F.sum(F.octet_length("text").cast("bigint") + 1)).first()[0] or 1
    blocks, parts = -(-volume // BLOCK_BYTES), max(1, volume * order // TOKEN_BYTES // PART_KEYS)
    dealt = plain.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)))
    counting, scoring = parcels(dealt.select("block", "text", "train")), parcels(dealt)

    def count(batch: pa.Table) -> pa.Table:
        rows_ = opened(batch.column("parcel"))
        keys, counts = block_counts(rows_.column("text").combine_chunks(), rows_.column("train").to_numpy(), order)
        cuts = np.concatenate([[0], np.searchsorted(keys, _part_edges(parts)), [len(keys)]])
        rows = [(p, packed(keys[a:b]), packed(counts[a:b].astype(np.uint32))) for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]
        block = batch.column("block")[0].as_py()
        return pa.table({
            "part": pa.array([r[0] for r in rows], pa.int64()), "block": pa.array([block] * len(rows), pa.int64()),
            "keys": pa.array([r[1] for r in rows], pa.binary()), "counts": pa.array([r[2] for r in rows], pa.binary())})

    def answer(batch: pa.Table) -> pa.Table:
        blocks_ = batch.column("block").to_pylist()
        keys = [unpacked(k.as_py(), "<u8") for k in batch.column("keys")]
        counts = [unpacked(c.as_py(), "<u4").astype(np.int64) for c in batch.column("counts")]
        whole = np.concatenate(keys)
        known, position = np.unique(whole, return_inverse=True)
        total = np.bincount(position, weights=np.concatenate(counts), minlength=len(known)).astype(np.int64)
        single = known & np.uint64(2) != 0
        part = batch.column("part")[0].as_py()
        rows, at = [(-1, part, b"", b"", int(total[single].sum()), int((total[single] > 0).sum()))], 0
        for block, own, count_ in zip(blocks_, keys, counts):
            all_ = total[position[at: at + len(own)]]
            at += len(own)
            other = all_ != count_
            if other.any():
                rows.append((block, part, packed(np.packbits(other)), packed(all_[other]), 0, 0))
        columns = list(zip(*rows))
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64())
        return pa.table({n: pa.array(c, k) for n, c, k in zip(("block", "part", "differ", "totals", "tokens", "words"), columns, kinds)})

    runs = counting.groupBy("block").applyInArrow(
        count, "part bigint, block bigint, keys binary, counts binary")
    answers, seen = save(
        runs.groupBy("part").applyInArrow(answer, "block bigint, part bigint, differ binary, totals binary, tokens bigint, words bigint"),
        "ngrams", tokens=F.sum("tokens"), words=F.sum("words"))
    total, distinct = seen["tokens"] or 0, seen["words"] or 0
    kind = plain.schema["id"].dataType.simpleString()

    def traverse(block: pa.Table, answered: pa.Table) -> pa.Table:
        batch = opened(block.column("parcel"))
        column, train_ = batch.column("text").combine_chunks(), batch.column("train").to_numpy()
        keys, counts = block_counts(column, train_, order)
        cuts = np.concatenate([[0], np.searchsorted(keys, _part_edges(parts)), [len(keys)]])
        for p, d, t in zip(answered.column("part").to_pylist(), answered.column("differ"), answered.column("totals")):
            own = counts[cuts[p]: cuts[p + 1]]  # a view of the part's keys, in the order they were sent
            own[np.unpackbits(unpacked(d.as_py(), "u1"))[: len(own)] != 0] = unpacked(t.as_py(), "<i8")
        model = Automaton(keys, counts, total, distinct, order, mu)
        n, known, base, score = [], [], [], []
        for a in range(0, len(column), 1024):
            tokens, first = padded(column.slice(a, 1024))
            at = model.entries(tokens, first)
            each = at[0] >= 0
            known.append(np.add.reduceat(np.where(each, model.seen[at[0]], False).astype(np.int64), first[:-1]))
            base.append(np.add.reduceat(np.where(each, model.base[at[0]], 0.0), first[:-1]))
            n.append(np.diff(first) - 1)
            score.append(model.traverse(tokens, first, at))
        return pa.table({
            "id": batch.column("id"), "trained": batch.column("train"), "n_tokens": np.concatenate(n),
            "n_known": np.concatenate(known), "train_tokens": np.full(len(column), total, np.int64),
            "base_score": np.concatenate(base), "score": np.concatenate(score)})

    return scoring.groupBy("block").cogroup(answers.where("block >= 0").select("block", "part", "differ", "totals").groupBy("block")).applyInArrow(
        traverse, f"id {kind}, trained boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = id_crc(F.col("doc_id")) % 10 == 0
    found = scores(table(spark, sf_dir, "documents"), trains=~held_out)
    return found.select(F.col("id").alias("doc_id"), (~F.col("trained")).alias("held_out"), "n_tokens", "n_known",
                        "train_tokens", "base_score", "score")
