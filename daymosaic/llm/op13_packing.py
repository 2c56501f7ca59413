"""Bound-certified packing of tokenised documents into sequences of a fixed length.

Documents are tokenised once; one longer than a sequence is cut into pieces of that length and a rest. Only
the pieces' numbers go on: no ids, no texts. The vocabulary's words never reach across blanks, nor from a plain letter to
a plain sign after it, so each different stretch between those is given to the tokenizer once and its ids are looked up
for the others; a test compares that with whole texts. Strings of special tokens are ordinary text.

Pieces are dealt by a hash of their written row into groups of about ``GROUP`` pieces. A group is packed by best-fit
decreasing, and dual feasible functions of its lengths give a lower bound of its number of sequences. A
function maps lengths to shares such that whatever fits a sequence adds up to one at most; the sum over
all pieces is a bound. A group whose number of sequences equals the bound, unrounded, is certified
and stays. A group with a gap hands on the pieces of its emptiest sequences, and of full ones with many
small pieces, ``EXCHANGED`` pieces at most: ``FAN`` groups throw theirs together and run
best-fit decreasing again; the former sequences are kept where that gains nothing. So rounds end after as many steps as
the number of groups has digits to the base ``FAN``, and at once when the sequences so far equal the
bound of all pieces: then no packing is shorter. No task holds more than a group, or ``FAN * EXCHANGED`` pieces.

The bound of all pieces needs how many there are of each length, ``capacity`` numbers at most.

Defined results: null and empty texts are documents of one token, the end; a null doc_id is one like any other;
repeated rows are packed each; pieces of equal length are interchangeable; an empty table gives no rows;
other columns are not looked at.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymosaic.llm.tables import save, table

CAPACITY = 4096
TOKENIZER = "word_bpe_49k.json"
END = 1

GROUP = 1 << 17
FAN = 8
EXCHANGED = 1 << 16
#: bytes of texts tokenised at a time
BATCH_BYTES = 1 << 23
#: stretches a worker remembers, none longer than this
REMEMBERED, LONGEST = 600_000, 64

PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PACKED = f"{PIECE}, row bigint, round int, grp bigint, bin bigint, offset bigint, open boolean, gap double"


# --- pieces -----------------------------------------------------------------------------------

def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


class Stretches:
    """Ids of the stretches of texts a tokenizer treats apart, each tokenised once."""

    def __init__(self, path: str):
        import os

        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self._forget()

    def _forget(self):
        self.places: dict[str, int] = {}
        self.ids, self.ends = np.zeros(0, "<u4"), np.zeros(1, np.int64)

    def _encoded(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids under each other, number of each)."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(stretches, add_special_tokens=False)]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((i for ids in found for i in ids), "<u4", int(counts.sum())), counts

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order, first of each text and the end)."""
        apart = pc.replace_substring_regex(texts, r"([A-Za-z])([!-/:-@\[-`{-~])", r"\1 \2")
        lists = pc.ascii_split_whitespace(apart)
        coded = lists.flatten().dictionary_encode()
        # upper and lower case are alike, but composed letters may not be
        names = [w.lower() if w.isascii() else w for w in coded.dictionary.to_pylist()]
        if len(self.places) > REMEMBERED:
            self._forget()
        fresh = list(dict.fromkeys(w for w in names if w not in self.places and len(w) <= LONGEST))
        long = [w for w in names if len(w) > LONGEST]
        ids, counts = self._encoded(fresh + long)
        kept = len(self.ends) - 1 + len(fresh)
        self.places.update(zip(fresh, range(len(self.ends) - 1, kept)))
        # long ones come last and are known to this call only
        bank, ends = np.concatenate([self.ids, ids]), np.concatenate([self.ends, self.ends[-1] + np.cumsum(counts)])
        self.ids, self.ends = bank[: ends[kept]], ends[: kept + 1]
        later = iter(range(kept, kept + len(long)))
        place = np.fromiter((next(later) if len(w) > LONGEST else self.places[w] for w in names), np.int64, len(names))
        begins, sizes = ends[:-1][place], np.diff(ends)[place]
        codes = coded.indices.to_numpy(zero_copy_only=False)
        size = sizes[codes]
        after = np.cumsum(size)
        out = bank[np.repeat(begins[codes] - after + size, size) + np.arange(after[-1] if len(after) else 0)]
        return out, np.concatenate([[0], after])[lists.offsets.to_numpy() - lists.offsets[0].as_py()]


_stretches: dict = {}


def stretches_of(path: str) -> Stretches:
    """One for each worker process."""
    if path not in _stretches:
        _stretches[path] = Stretches(path)
    return _stretches[path]


def _runs(sizes: np.ndarray):
    """Runs of texts of about BATCH_BYTES."""
    first, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        total += size
        if total >= BATCH_BYTES:
            yield first, i + 1
            first, total = i + 1, 0
    if first < len(sizes):
        yield first, len(sizes)


def _cut(path: str, capacity: int, batches):
    """Rows of PIECE of rows (doc_id, text)."""
    stretches = stretches_of(path)
    for batch in batches:
        docs, texts = batch.column(0).to_pylist(), batch.column(1)
        for first, last in _runs(pc.binary_length(texts).to_numpy(zero_copy_only=False)):
            ids, offsets = stretches.of(texts.slice(first, last - first))
            out = []
            for doc, begin, end in zip(docs[first:last], offsets[:-1].tolist(), offsets[1:].tolist()):
                own = np.append(ids[begin:end], np.array([END], "<u4"))
                for piece, start in enumerate(range(0, len(own), capacity)):
                    part = own[start: start + capacity]
                    out.append((doc, piece, start, len(part), zlib.crc32(part.tobytes())))
            columns = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int32() if name == "piece int" else pa.int64()) for c, name in zip(columns, PIECE.split(", "))],
                names=[c.split()[0] for c in PIECE.split(", ")])


def pieces_of(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents: PIECE."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return texts.mapInArrow(lambda batches: _cut(tokenizer, capacity, batches), PIECE)


# --- bounds -----------------------------------------------------------------------------------

def bound(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> float:
    """The largest sum of dual feasible shares over ``counts`` pieces of each of ``lengths``; no packing has fewer sequences.

    Three kinds: the length itself; lengths below a limit count nothing and those that leave less
    than the limit count whole; steps of 1/k, which round lengths up past each step. The steps are
    also taken of what the limits leave.
    """
    if not len(lengths):
        return 0.0
    x, n = lengths.astype(np.int64), counts.astype(np.int64)

    def steps(shares: np.ndarray, whole: int) -> float:
        """Largest over k of the sum of u(x): x where (k+1) x is a multiple of the whole, else floor((k+1) x) / k."""
        best = 0.0
        for k in range(1, 33):
            times, rest = np.divmod(shares * (k + 1), whole)
            best = max(best, float((n * np.where(rest == 0, shares / whole, times / k)).sum()))
        return best

    best = max(float((n * x).sum()) / capacity, steps(x, capacity))
    limits = np.unique(np.concatenate([x[x <= capacity // 2], capacity - x[x > capacity // 2] + 1]))
    limits = limits[(limits > 0) & (limits <= capacity // 2)]
    below, order = np.concatenate([[0], np.cumsum((n * x)[np.argsort(x)])]), np.argsort(x)
    many, ordered = np.concatenate([[0], np.cumsum(n[order])]), x[order]
    # limits: pieces above capacity - limit count whole, those below limit count nothing
    high, low = np.searchsorted(ordered, capacity - limits, "right"), np.searchsorted(ordered, limits)
    sums = (many[-1] - many[high]) + (below[high] - below[low]) / capacity
    if len(sums):
        best = max(best, float(sums.max()))
        for limit in limits[np.argsort(-sums)[:4]]:
            shares = np.where(x > capacity - limit, capacity, np.where(x < limit, 0, x))
            best = max(best, steps(shares, capacity))
    return best


def whole_bound(share: float) -> int:
    """A bound as a number of sequences; sums of shares may be off by rounding."""
    return int(np.ceil(share - 1e-6))


# --- best-fit decreasing ----------------------------------------------------------------------

def best_fit(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The sequence of each piece: longest piece first, each to the fullest sequence with room for it."""
    place = np.empty(len(lengths), np.int64)
    rooms: list[int] = []  # free lengths that some sequence has, in order
    having: dict[int, list[int]] = {}
    opened = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        at = bisect_left(rooms, length)
        if at == len(rooms):
            number, room = opened, capacity
            opened += 1
        else:
            room = rooms[at]
            number = having[room].pop()
            if not having[room]:
                del having[room], rooms[at]
        place[i] = number
        room -= length
        if room:
            if room not in having:
                having[room] = []
                insort(rooms, room)
            having[room].append(number)
    return place


def repack(lengths: np.ndarray, former: np.ndarray | None, capacity: int, exchanged: int):
    """(sequence of each piece, whether the piece is handed on, gap) for one group; ``former`` sequences are kept unless beaten."""
    place = best_fit(lengths, capacity)
    if former is not None:
        _, kept = np.unique(former, return_inverse=True)
        if len(place) and kept.max() <= place.max():
            place = kept
    sequences = int(place.max()) + 1 if len(place) else 0
    kinds, counts = np.unique(lengths, return_counts=True)
    gap = max(0.0, sequences - bound(kinds, counts, capacity))
    filled = np.bincount(place, lengths, sequences).astype(np.int64)
    handed = np.zeros(sequences, bool)
    if gap > 1e-6:  # the emptiest, then those that offer most pieces for their room
        pieces = np.bincount(place, minlength=sequences)
        order = np.lexsort((-pieces, filled))
        handed[order[np.cumsum(pieces[order]) <= exchanged]] = True
    return place, handed[place], gap


def offsets(place: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Where each piece begins in its sequence, gapless from 0."""
    order = np.argsort(place, kind="stable")
    ends = np.cumsum(lengths[order])
    begins = ends - lengths[order]
    first = np.searchsorted(place[order], place[order])
    out = np.empty(len(place), np.int64)
    out[order] = begins - begins[first]
    return out


# --- rounds -----------------------------------------------------------------------------------

def _pack(number: int, capacity: int, exchanged: int):
    """PACKED rows of one group."""
    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("row")
        lengths = group["length"].to_numpy()
        former = None
        if number:
            keys = np.stack([group["was_grp"].to_numpy(), group["bin"].to_numpy()])
            _, former = np.unique(keys, axis=1, return_inverse=True)
            former = former.ravel()
        place, handed, gap = repack(lengths, former, capacity, exchanged)
        out = group.select([c.split()[0] for c in PIECE.split(", ")] + ["row"])
        n = len(lengths)
        for name, values in (("round", pa.array(np.full(n, number, np.int32))), ("grp", group["grp"]), ("bin", pa.array(place)),
                             ("offset", pa.array(offsets(place, lengths))), ("open", pa.array(handed)), ("gap", pa.array(np.full(n, gap)))):
            out = out.append_column(name, values)
        return out

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP, fan: int = FAN, exchanged: int = EXCHANGED) -> DataFrame:
    """``pieces`` (PIECE) with sequence_id and offset."""
    numbered, seen = save(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    lengths = numbered.groupBy("length").agg(F.count(F.lit(1)).alias("n")).toArrow()  # one row a length
    least = whole_bound(bound(lengths["length"].to_numpy(), lengths["n"].to_numpy(), capacity))
    groups = max(1, -(-seen["rows"] // group))
    waiting = numbered.withColumn("grp", F.pmod(F.xxhash64("row"), F.lit(groups).cast("bigint")))
    names, settled, sequences, number = [c.split()[0] for c in PIECE.split(", ")], [], 0, 0
    while True:
        packed, seen = save(
            waiting.groupBy("grp").applyInArrow(_pack(number, capacity, exchanged), PACKED), f"packed-{number}",
            handed=F.count(F.when(F.col("open"), 1)), stay=F.count(F.when((F.col("offset") == 0) & ~F.col("open"), 1)),
            all=F.count(F.when(F.col("offset") == 0, 1)))
        done = groups == 1 or not seen["handed"] or sequences + seen["all"] <= least
        kept = packed if done else packed.where(~F.col("open"))
        settled.append(kept.select(*names, "round", "grp", "bin", "offset"))
        if done:
            break
        sequences += seen["stay"]
        groups, number = -(-groups // fan), number + 1
        waiting = packed.where("open").select(
            *names, "row", "bin", F.col("grp").alias("was_grp"), F.floor(F.col("grp") / fan).alias("grp"))
    first, *rest = settled
    for other in rest:
        first = first.unionAll(other)
    # a group has fewer than 2**20 sequences, there are fewer than 16 rounds
    return first.select(*names, ((F.col("grp") * 16 + F.col("round")) * (1 << 20) + F.col("bin")).alias("sequence_id"), "offset")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(pieces_of(table(spark, sf_dir, "documents"), default_tokenizer()))
