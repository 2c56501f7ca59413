"""Licence scans: Dice coefficient of word bigrams with licence templates.

A text is its normalised words: comment signs, line breaks and punctuation are gone, so a licence may be wrapped,
commented or spread over paragraphs. A template is compared to every window of words by 2 * shared / (own +
template's) over sets of bigrams, at any place and of any length; the best windows are found exactly:

- Dice can reach the threshold t only when the smaller set has at least t / (2 - t) times as many bigrams as the larger
  one. So a template needs that share of its own bigrams in the text, and at least one of its rarest; hardly any text
  has them of hardly any template. The same bound ends a window.
- The best window begins with a shared bigram after one that is not shared, as a longer run of shared ones is only better.
  From each such place all ends are weighed at once by running counts of distinct bigrams.

Windows that mostly lie on each other count once, for the licence that is nearest.

Defined results: null, empty and wordless texts have no licence; a text of one word has the word itself instead of
bigrams; of equal coefficients the first licence by name is the best; a licence found several times counts once; repeated rows
give repeated results; other columns are not looked at.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymosaic.llm.licence_texts import STATEMENTS
from daymosaic.llm.tables import table

LEAST_DICE = 0.85

_NO_WORD = re.compile(r"[\W_]+")
_NOTICE = re.compile(r"(?im)^[^\w\n]*(?:copyright|\(c\)|©)[^\n]*$")
FOUND = T.ArrayType(T.StructType([T.StructField("licence", T.StringType()), T.StructField("dice", T.DoubleType())]))


def normalised(text: str) -> list[str]:
    """Lower-case words without punctuation, copyright notices or spelling variants of licence."""
    words = _NO_WORD.sub(" ", _NOTICE.sub(" ", text).lower()).split()
    return [w.replace("licence", "license") for w in words]


def bigrams(words: list[str]) -> set:
    return set(zip(words, words[1:])) if len(words) > 1 else set(words)


def dice(a: set, b: set) -> float:
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 0.0


def sequence(words: list[str]) -> list:
    """The bigrams of a text in order; a lone word is itself."""
    return list(zip(words, words[1:])) if len(words) > 1 else list(words)


class Templates:
    """Templates by the number of their bigrams."""

    def __init__(self, statements: dict[str, tuple[str, ...]], least: float):
        self.least = least
        rows = [(name, bigrams(normalised(t))) for name, texts in statements.items() for t in texts]
        self.rows = sorted(((len(b), name, b) for name, b in rows if b), key=lambda r: r[:2])
        self.sizes = [r[0] for r in self.rows]
        self.shrink = least / (2 - least)
        #: bigrams of each template that a window needs
        self.needed = [ceil(size * self.shrink - 1e-9) for size in self.sizes]
        times = Counter(g for _, _, grams in self.rows for g in grams)
        #: of so many of its rarest bigrams a window has at least one
        self.rare: dict = defaultdict(list)
        for i, ((size, _, grams), needed) in enumerate(zip(self.rows, self.needed)):
            for gram in sorted(grams, key=lambda g: (times[g], g))[: size - needed + 1]:
                self.rare[gram].append(i)

    def candidates(self, size: int) -> list:
        """Templates whose size lets the coefficient with a set of ``size`` reach the threshold."""
        low = bisect_left(self.sizes, size * self.shrink - 1e-9)
        return self.rows[low: bisect_right(self.sizes, size / self.shrink + 1e-9)]

    def windows(self, words: list[str]) -> list[tuple[float, str, int, int, int]]:
        """(coefficient, licence, first, end, template) of the best window from each place where one reaches the threshold."""
        grams = sequence(words)
        present, out, earlier = set(grams), [], None
        for i in sorted({i for g in present & self.rare.keys() for i in self.rare[g]}):
            size, name, known = self.rows[i]
            if len(present & known) < self.needed[i]:
                continue
            if earlier is None:  # where each bigram was last seen before
                seen: dict = {}
                earlier = np.empty(len(grams), np.int64)
                for k, g in enumerate(grams):
                    earlier[k] = seen.get(g, -1)
                    seen[g] = k
            shared = np.fromiter((g in known for g in grams), bool, len(grams))
            begins = np.flatnonzero(shared & ~np.append(False, shared[:-1]))
            rest = np.cumsum(shared[::-1])[::-1]
            for k in begins[rest[begins] >= self.needed[i]].tolist():
                out += self._from(k, i, name, size, earlier, shared)
        return out

    def _from(self, k: int, i: int, name: str, size: int, earlier: np.ndarray, shared: np.ndarray) -> list:
        limit, length = size / self.shrink + 1e-9, 2 * size + 8
        while True:
            new = earlier[k: k + length] < k  # not seen in the window before
            own = np.cumsum(new)
            if own[-1] > limit or k + length >= len(earlier):
                break
            length *= 2
        both = np.cumsum(new & shared[k: k + length])
        coefficients = np.where(own <= limit, 2 * both / (own + size), 0.0)
        best = int(np.argmax(coefficients))
        return [(float(coefficients[best]), name, k, k + best + 1, i)] if coefficients[best] >= self.least else []

    def scan(self, text: str | None) -> list[tuple[str, float]]:
        """(licence, best coefficient) of all licences found, best first."""
        best: dict[str, float] = {}
        taken: list[tuple[int, int]] = []
        for d, name, first, end, _ in sorted(self.windows(normalised(text or "")), key=lambda w: (-w[0], w[1], w[2])):
            if all(2 * (min(end, b) - max(first, a)) <= min(end - first, b - a) for a, b in taken):
                taken.append((first, end))
                best.setdefault(name, d)
        return sorted(best.items(), key=lambda x: (-x[1], x[0]))


def licences(docs: DataFrame, key: str = "doc_id", text: str = "text", statements: dict | None = None,
             least: float = LEAST_DICE) -> DataFrame:
    """(id, found): the licences of each text with their coefficients, best first."""
    given = statements or STATEMENTS

    def run(batches):
        known = Templates(given, least)
        kind = pa.list_(pa.struct([("licence", pa.string()), ("dice", pa.float64())]))
        for batch in batches:
            found = [[{"licence": a, "dice": d} for a, d in known.scan(t.as_py())] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], names=["id", "found"])

    plain = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    return plain.mapInArrow(run, T.StructType([plain.schema["id"], T.StructField("found", FOUND)]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences(table(spark, sf_dir, "documents"))
    first = F.get("found", 0)
    return found.select(
        F.col("id").alias("doc_id"), first["licence"].alias("licence"), first["dice"].alias("dice"),
        F.size("found").cast("bigint").alias("n_licences"), F.array_join("found.licence", ",").alias("licences"))
