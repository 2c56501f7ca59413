"""Benchmark decontamination: a broadcast hash set of normalised test n-grams.

Words are runs of a-z (A-Z lower-cased), digits and non-ASCII characters. The
windows of a benchmark item are its runs of ``n`` words; an item of fewer
words is one window. Token windows of every document are looked up by hash in
the broadcast set, each hit is verified word by word, and the words it covers
are marked. Spans or whole documents can then be removed.

Benchmarks of more than ``MAX_WINDOWS`` characters are taken in blocks of items, one pass over the documents
each, and the spans of the passes are put together. A block holds whole items, so one item
larger than that is a block of its own size, and a large benchmark costs many passes: this is made for
benchmarks, which are small beside a corpus.

Defined results: null, empty and wordless texts have no words and no hits; a
wordless or null item has no window; repeated items each count; repeated rows
of a document give repeated rows; an empty benchmark hits nothing; a null
item_id marks words but is left out of the list of items.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymosaic.functions.sizing import materialise
from daymosaic.llm import texts
from daymosaic.llm.tables import hidden, table

WINDOW = 10
#: characters of benchmark items that one pass broadcasts; a window takes some hundred bytes in a task
MAX_WINDOWS = 1_000_000

SPANS = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType())]))
HITS = "__hits"
_SPLIT = bytes(b if b else 32 for b in texts.PLAIN_WORDS.tolist())


def words_of(text: str | bytes | None) -> list[bytes]:
    """Normalised words, as UTF-8."""
    raw = text.encode() if isinstance(text, str) else text or b""
    return [w for w in raw.translate(_SPLIT).split(b" ") if w]


def _n_windows(text) -> F.Column:
    return F.length(F.coalesce(text, F.lit(""))).cast("bigint")  # a text has no more windows than characters


def item_blocks(benchmark: DataFrame, item: str, text: str, max_windows: int) -> Iterator[list]:
    """Blocks of (item id, text) of at most ``max_windows`` characters, one at a time."""
    kept = benchmark.select(F.col(item).alias("item"), F.col(text).alias("text")).where(F.length("text") > 0)
    total = kept.agg(F.sum(_n_windows(F.col("text")))).first()[0] or 0
    blocks = -(-total // max_windows)
    if blocks <= 1:
        yield [tuple(r) for r in kept.collect()]
        return
    numbered = kept.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks * 2)))
    for b in range(blocks * 2):
        yield [tuple(r) for r in numbered.where(F.col("block") == b).select("item", "text").collect()]


def window_index(items: list, n: int) -> dict[int, tuple[np.ndarray, dict]]:
    """By window length: (sorted hashes, words of a window to the items that have it)."""
    by_length: dict[int, dict] = {}
    for item, text in items:
        words = words_of(text)
        size = min(n, len(words))
        for k in range(len(words) - size + 1 if size else 0):
            by_length.setdefault(size, {}).setdefault(tuple(words[k: k + size]), set()).add(item)
    index = {}
    for size, windows in by_length.items():
        flat = pa.array([b" ".join(w) for w in windows], pa.binary())
        hashes, offsets = texts.word_hashes(flat, texts.PLAIN_WORDS)
        index[size] = np.unique(texts.sequence_hashes(hashes, offsets[:-1], size)), windows
    return index


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def scan(column: pa.Array, index: dict) -> tuple[np.ndarray, list, list]:
    """(words, spans of hit words, items) of each text."""
    hashes, offsets = texts.word_hashes(column, texts.PLAIN_WORDS)
    spans: list = [[] for _ in range(len(column))]
    items: list = [set() for _ in range(len(column))]
    words: dict[int, list[bytes]] = {}
    for size, (known, windows) in index.items():
        text, place = texts.window_starts(offsets, size)
        if not len(text):
            continue
        found = np.flatnonzero(np.isin(texts.sequence_hashes(hashes, place, size), known))
        for i in found:
            t = int(text[i])
            if t not in words:
                words[t] = words_of(column[t].as_py())
            k = int(place[i] - offsets[t])
            own = windows.get(tuple(words[t][k: k + size]))
            if own is not None:  # the hash alone does not decide
                spans[t].append((k, k + size))
                items[t] |= own
    return np.diff(offsets), [_joined(s) for s in spans], items


def mark(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", n: int = WINDOW,
         max_windows: int = MAX_WINDOWS) -> DataFrame:
    """``docs`` with a column ``__hits``: words, spans [first, last) of hit words, items hit (as text, sorted)."""
    spark = docs.sparkSession
    out_type = T.StructType([
        T.StructField("n_words", T.LongType()), T.StructField("spans", SPANS),
        T.StructField("items", T.ArrayType(T.StringType())),
    ])
    schema = T.StructType([*docs.schema.fields, T.StructField(HITS, out_type)])
    arrow = pa.struct([("n_words", pa.int64()),
                       ("spans", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
                       ("items", pa.list_(pa.string()))])
    marked, first = docs, True
    for block in item_blocks(benchmark, item, "text", max_windows):
        shared = spark.sparkContext.broadcast(window_index(block, n))

        def run(batches, shared=shared, earlier=not first):
            for batch in batches:
                n_words, spans, items = scan(batch.column(text), shared.value)
                if earlier:
                    before = batch.column(HITS).to_pylist()
                    spans = [_joined(s + [(x["first"], x["last"]) for x in b["spans"]]) for s, b in zip(spans, before)]
                    items = [i | set(b["items"]) for i, b in zip(items, before)]
                hits = pa.array([
                    {"n_words": int(w), "spans": [{"first": a, "last": b} for a, b in s],
                     "items": sorted(str(i) for i in own if i is not None)}
                    for w, s, own in zip(n_words, spans, items)], arrow)
                kept = [batch.column(k) for k, name in enumerate(batch.schema.names) if name != HITS]
                names = [name for name in batch.schema.names if name != HITS]
                yield pa.RecordBatch.from_arrays([*kept, hits], names=[*names, HITS])

        marked = marked.mapInArrow(run, schema)
        if not first:  # one set of windows in memory at a time
            marked = materialise(marked, "decontaminate")[0]
        first = False
    return marked


def without_hits(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """Documents no benchmark window occurs in; the columns of ``docs``."""
    plain, back = hidden(docs)
    return mark(plain, benchmark, back[text], **options).where(F.size(f"{HITS}.spans") == 0).select(
        *[F.col(back[c]).alias(c) for c in docs.columns])


def without_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with the hit words cut from their texts, together with what stands between them."""
    names_, (plain, back) = docs.columns, hidden(docs)
    marked, text = mark(plain, benchmark, back[text], **options), back[text]

    def cut(batches):
        to = texts.PLAIN_WORDS
        for batch in batches:
            out = []
            for value, hits in zip(batch.column(text), batch.column(HITS)):
                value, spans = value.as_py(), hits.as_py()["spans"]
                if value and spans:
                    raw = value.encode()
                    data = np.frombuffer(raw, np.uint8)
                    begin, end = [], []
                    for _, at, starts, ends in texts.word_places(data, np.array([0, len(data)]), to):
                        begin.append(starts + at)
                        end.append(ends + at)
                    begin, end, kept, at = np.concatenate(begin), np.concatenate(end), [], 0
                    for s in spans:
                        kept.append(raw[at: begin[s["first"]]])
                        at = int(end[s["last"] - 1])
                    value = b"".join([*kept, raw[at:]]).decode()
                out.append(value)
            names = [x for x in batch.schema.names if x != HITS]
            columns = [pa.array(out, pa.string()) if x == text else batch.column(x) for x in names]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return marked.mapInArrow(cut, plain.schema).toDF(*names_)


def _digest(items) -> F.Column:
    return F.sha2(F.array_join(items, ","), 256)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hits = mark(docs, table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate(F.col(f"{HITS}.spans"), F.lit(0).cast("bigint"), lambda s, x: s + x["last"] - x["first"])
    return hits.select(
        "doc_id", F.col(f"{HITS}.n_words").alias("n_words"), n_hit.alias("n_hit"),
        F.size(f"{HITS}.items").cast("bigint").alias("n_items"), _digest(F.col(f"{HITS}.items")).alias("items_sha256"),
        (F.size(f"{HITS}.spans") > 0).alias("contaminated"),
    )


#: windows of both sides by equality join; a hit marks the words it covers
SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
    list_filter(string_split_regex(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' '), lambda x: x <> '') AS w FROM documents),
 b AS (SELECT item_id,
    list_filter(string_split_regex(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' '), lambda x: x <> '') AS w FROM benchmark),
 bw AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS g
    FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
 sizes AS (SELECT DISTINCT n FROM bw),
 dw AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
    FROM (SELECT r, w, n, unnest(range(1, greatest(len(w) - n + 2, 1))) AS i FROM d, sizes)),
 h AS (SELECT r, i, n, item_id FROM dw JOIN bw USING (n, g)),
 c AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM h)) GROUP BY r),
 t AS (SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM h) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN t USING (r)
"""
