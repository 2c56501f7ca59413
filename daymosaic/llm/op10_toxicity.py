"""Toxicity: a counterfactual-regularised linear classifier.

A text's features are its words and their first 4 to 7 bytes (insults are
inflected), each once when it occurs and once more when it occurs at least
twice, hashed to ``DIMENSIONS`` places. Logistic regression is fitted to
labelled texts; every labelled text that names a group of people is paired with a
counterfactual, the same text with each identity term swapped for another
term of its kind, and the squared change of the score between the two is
added to the loss. The mention of a group then cannot carry the score, which
keeps neutral mentions from being taken for toxic ones.

The fit uses at most ``MAX_TRAINING`` labelled texts, those with the smallest
hash of their id; this is the only bounded sample. Their features are made on
the executors; the driver gathers those features and nothing else. Scoring is one
pass over all whole texts.

Defined results: null, empty and wordless texts get the score of no features;
when no text or only one of the two labels is there to learn from, every score
is ``PRIOR``; null labels are ignored; ids labelled twice count twice; repeated
rows get equal scores.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymosaic.llm import texts
from daymosaic.llm.tables import hidden, id_crc, table

DIMENSIONS = 1 << 18
PREFIXES = (4, 5, 6, 7)
MAX_TRAINING = 8_000
THRESHOLD = 0.3
PRIOR = 0.1
#: a feature is used when it divides toxic from other texts by this chi-square at least
LEAST_CHI_SQUARE = 15.0
LEAST_TEXTS = 3
RIDGE = 0.5
COUNTERFACTUAL = 4.0
STEPS = 300
SCORE = "__score"

#: words are runs of letters: a-z and all that is not ASCII
LETTER_WORDS = texts.letters(bytes(b for b in range(128) if not chr(b).isalpha()))

#: identity terms by kind; terms of one kind are swapped for each other within a language
IDENTITY_TERMS = {
    "en": {
        "gender": "women men woman man girls boys girl boy female male transgender",
        "religion": "muslims christians jews hindus buddhists atheists muslim christian jewish hindu buddhist atheist",
        "origin": "africans europeans asians americans immigrants refugees african european asian american foreign native",
        "colour": "black white brown",
        "orientation": "gay straight lesbian bisexual heterosexual homosexual",
        "age and health": "old young elderly disabled blind deaf",
    },
    "de": {
        "gender": "frauen männer frau mann mädchen jungen",
        "religion": "muslime christen juden hindus buddhisten atheisten",
        "origin": "afrikaner europäer asiaten amerikaner ausländer flüchtlinge",
        "orientation": "schwule lesben bisexuelle heterosexuelle",
    },
    "fr": {
        "gender": "femmes hommes femme homme filles garçons",
        "religion": "musulmans chrétiens juifs hindous bouddhistes athées",
        "origin": "africains européens asiatiques américains immigrés réfugiés",
        "orientation": "homosexuels lesbiennes bisexuels hétérosexuels",
    },
    "es": {
        "gender": "mujeres hombres mujer hombre niñas niños",
        "religion": "musulmanes cristianos judíos hindúes budistas ateos",
        "origin": "africanos europeos asiáticos americanos inmigrantes refugiados",
        "orientation": "homosexuales lesbianas bisexuales heterosexuales",
    },
}


def word_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit features of all words, text of each); a word gives itself and its prefixes."""
    data, offsets = texts.buffers(column)
    features, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for mapped, first, starts, ends in texts.word_places(data, offsets, LETTER_WORDS):
        text = np.searchsorted(offsets, starts + first, "right") - 1
        features.append(texts.hashes_of(mapped, starts, ends))
        owners.append(text)
        for k in PREFIXES:
            longer = np.flatnonzero(ends - starts > k)
            features.append(texts.mix(texts.hashes_of(mapped, starts[longer], starts[longer] + k) + np.uint64(k)))
            owners.append(text[longer])
    return np.concatenate(features), np.concatenate(owners)


def counted(features: np.ndarray, owners: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashed places, first of each text and the end): one place for a feature, a second one for a repeated one."""
    place = (features % np.uint64(DIMENSIONS)).astype(np.int64)
    keys = np.sort(owners * DIMENSIONS + place)
    start = np.ones(len(keys), bool)
    start[1:] = keys[1:] != keys[:-1]
    once = keys[start]
    twice = once[np.diff(np.append(np.flatnonzero(start), len(keys))) > 1]
    again = texts.mix((twice % DIMENSIONS).astype(np.uint64) + np.uint64(0x5851F42D4C957F2D)) % np.uint64(DIMENSIONS)
    both = np.sort(np.concatenate([once, twice // DIMENSIONS * DIMENSIONS + again.astype(np.int64)]))
    return both % DIMENSIONS, np.searchsorted(both, np.arange(n + 1) * DIMENSIONS)


def places(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return counted(*word_features(column), len(column))


def swaps() -> dict[str, str]:
    """Each identity term to the next one of its kind and language."""
    out: dict[str, str] = {}
    for kinds in IDENTITY_TERMS.values():
        for terms in kinds.values():
            words = terms.split()
            out.update({a: b for a, b in zip(words, words[1:] + words[:1]) if a not in out})
    return out


def counterfactual(text: str, to: dict[str, str]) -> str:
    """``text`` with every identity term swapped; letters only make words."""
    out, word = [], []
    for c in [*text, " "]:
        if c.isalpha():
            word.append(c)
            continue
        if word:
            w = "".join(word)
            out.append(to.get(w.lower(), w))
            word = []
        out.append(c)
    return "".join(out)[:-1]


def _sums(weights: np.ndarray, where: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(weights[where])])
    return total[first[1:]] - total[first[:-1]]


def training_rows(column: pa.Array) -> tuple[list, list]:
    """(places, places of the counterfactual or None) of each text; a slice of texts at a time."""
    own, swapped, to = [], [], swaps()
    for k in range(0, len(column), 256):
        part = column.slice(k, 256)
        where, first = places(part)
        own += [where[a:b].astype(np.int32) for a, b in zip(first[:-1], first[1:])]
        other = [counterfactual(t, to) if t else t for t in part.to_pylist()]
        changed = [i for i, t in enumerate(part.to_pylist()) if t != other[i]]
        where, first = places(pa.array([other[i] for i in changed], pa.string()))
        found = dict(zip(changed, (where[a:b].astype(np.int32) for a, b in zip(first[:-1], first[1:]))))
        swapped += [found.get(i) for i in range(len(part))]
    return own, swapped


def _select(own: list, y: np.ndarray) -> np.ndarray:
    """Places that divide toxic from other texts."""
    total, toxic = np.zeros(DIMENSIONS), np.zeros(DIMENSIONS)
    for where, label in zip(own, y):
        total[where] += 1  # a text has a place once
        toxic[where] += label
    n, positive = len(y), float(y.sum())
    expected = total * positive / n
    spread = expected * (1 - total / n) * (1 - positive / n)
    chi = np.where(spread > 0, (toxic - expected) ** 2 / np.maximum(spread, 1e-9), 0)
    return np.flatnonzero((chi >= LEAST_CHI_SQUARE) & (total >= LEAST_TEXTS))


def fit(own: list, swapped: list, labels: np.ndarray, strength: float = COUNTERFACTUAL) -> tuple[np.ndarray, float]:
    """(weight of each place, constant) from ``training_rows`` and labels 0 or 1."""
    weights, n = np.zeros(DIMENSIONS), len(labels)
    floor = float(np.log(PRIOR / (1 - PRIOR)))
    if not n or labels.min() == labels.max():
        return weights, floor
    y = labels.astype(np.float32)
    used = _select(own, y)
    number = np.full(DIMENSIONS, -1)
    number[used] = np.arange(len(used))

    def dense(rows):
        x = np.zeros((len(rows), len(used)), np.float32)
        for i, where in enumerate(rows):
            kept = number[where]
            x[i, kept[kept >= 0]] = 1
        return x

    x, pairs = dense(own), [i for i, s in enumerate(swapped) if s is not None]
    change = x[pairs] - dense([swapped[i] for i in pairs])
    change = change[np.abs(change).sum(axis=1) > 0]
    rate = float(y.mean())
    w, b = np.zeros(len(used), np.float32), float(np.log(rate / (1 - rate)))
    # Nesterov steps no longer than the largest curvature allows
    size = np.float32(1.0 / (0.25 * (_largest(x) + n) + RIDGE + 2 * strength * _largest(change)))
    v, vb, t = w, b, 1.0
    for _ in range(STEPS if len(used) else 0):
        error = 1 / (1 + np.exp(-(x @ v + np.float32(vb)))) - y
        gradient = x.T @ error + RIDGE * v + 2 * strength * (change.T @ (change @ v))
        w_new, b_new, t_new = v - size * gradient, vb - float(size) * float(error.sum()), (1 + (1 + 4 * t * t) ** 0.5) / 2
        v, vb = w_new + np.float32((t - 1) / t_new) * (w_new - w), b_new + (t - 1) / t_new * (b_new - b)
        w, b, t = w_new, b_new, t_new
    weights[used] = w
    return weights, float(b)


def _largest(x: np.ndarray) -> float:
    """Largest eigenvalue of x'x, by power iteration."""
    if not x.size:
        return 0.0
    v = np.ones(x.shape[1], np.float32)
    for _ in range(30):
        v = x.T @ (x @ v)
        norm = np.linalg.norm(v)
        if not norm:
            return 0.0
        v /= norm
    return float(np.linalg.norm(x @ v) ** 2) * 1.05


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
          max_training: int = MAX_TRAINING) -> tuple[np.ndarray, float]:
    """Fit to at most ``max_training`` labelled texts; see ``fit``."""
    marked = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).select(
        F.col(key).alias("__id"), (F.col(label) > 0).cast("int").alias("__y"))
    kept = marked.orderBy(F.xxhash64("__id"), "__id", "__y").limit(max_training)  # a top-k: each task keeps that many at most
    hint = "broadcast" if max_training <= 1_000_000 else "merge"
    rows = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text")).join(
        kept.hint(hint), F.col("__key") == F.col("__id")).select("__text", "__y")

    def features(batches):
        kind = pa.list_(pa.int32())
        for batch in batches:
            own, swapped = training_rows(batch.column(0))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(own, kind), pa.array(swapped, kind)], names=["y", "own", "swapped"])

    found = rows.mapInArrow(features, "y int, own array<int>, swapped array<int>").toArrow()
    as_arrays = [[None if x.as_py() is None else np.asarray(x.values) for x in found.column(k)] for k in (1, 2)]
    return fit(*as_arrays, found.column(0).to_numpy())


def score(docs: DataFrame, model: tuple[np.ndarray, float], text: str = "text") -> DataFrame:
    """``docs`` with a column ``__score`` between 0 and 1."""
    weights, constant = model
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    def run(batches):
        for batch in batches:
            scores = []
            column = batch.column(text)
            for k in range(0, max(len(column), 1), 512):
                part = column.slice(k, 512)
                scores.append(constant + _sums(shared.value, *places(part)))
            out = 1 / (1 + np.exp(-np.concatenate(scores)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.float64())], names=[*batch.schema.names, SCORE])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(SCORE, T.DoubleType())]))


def without_toxic(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """Documents whose score is below ``threshold``; the columns of ``docs``."""
    plain, back = hidden(docs)
    scored = score(plain, train(docs, labels, key, text), back[text])
    return scored.where(F.col(SCORE) < threshold).select(*[F.col(back[c]).alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = id_crc(F.col("doc_id")) % 4 == 2
    labels = table(spark, sf_dir, "labels").where(~held_out)
    scored = score(docs, train(docs, labels))
    return scored.select(
        "doc_id", held_out.alias("held_out"), F.col(SCORE).alias("score"),
        (F.col(SCORE) >= THRESHOLD).cast("int").alias("predicted"))
