"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by (source, exact length). A source's target is its share
of the budget by weight, at most ``MAX_REPEATS`` times its size; what is cut
off goes to the other sources by weight. Whole passes over a source are taken
first. For the rest, every length gives the same fraction of its documents,
rounded down; a bounded-knapsack dynamic programme over the remaining counts
by length fits what is then left of the budget (all of it, when that is a few long
documents); and of each length as many documents as the plan says are selected, in the order of a seeded hash.

A plan needs one row for each (source, length) and reads nothing else, so it
is made by one task a source from counts whose number depends on the
longest document, not on the number of documents. The programme's table is as
long as ``4 * longest document`` words at most.

Selecting needs no large group in one task either: documents of one source and length are ranked by
their hash through a sort by ranges, which spreads a source, a length or an id with any share of all rows.

Defined results: null and empty texts have size 0 and are taken as often as
there are whole passes; a null source is a source, the last one; repeated
rows are documents of their own, equal ones are interchangeable; a source
without words has target 0; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daymosaic.functions.sizing import materialise
from daymosaic.llm.tables import BLANK_CLASS, hidden, table, trimmed, with_places

WEIGHTS = (5.0, 2.0, 1.0)
MAX_REPEATS = 3
SEED = 17

PLAN = "source string, has_source boolean, size bigint, source_size bigint, target double, passes bigint, extra bigint"


def word_count(text: Column) -> Column:
    """Runs of anything but blanks; 0 for null."""
    t = trimmed(text)
    return F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, f"{BLANK_CLASS}+"))).cast("bigint")


def targets(sizes: list[int], weights: list[float], budget: float, max_repeats: int = MAX_REPEATS) -> list[float]:
    """Shares of ``budget`` by weight, none above ``max_repeats`` times its size; the excess is shared again."""
    out, free = [0.0] * len(sizes), list(range(len(sizes)))
    left = float(budget)
    while free:
        total = sum(weights[i] for i in free)
        full = [i for i in free if left * weights[i] / total > max_repeats * sizes[i]]
        if not full:
            for i in free:
                out[i] = left * weights[i] / total
            break
        for i in full:
            out[i] = float(max_repeats * sizes[i])
        left -= sum(out[i] for i in full)
        free = [i for i in free if i not in full]
    return out


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many of each length sum up to ``budget``, or as near below it as can be; all lengths above 0.

    Bounded knapsack over a table of sums: each length extends the sums reached
    so far by up to its count of copies; a sum remembers the length that
    first reached it. Stops when the budget itself is reached.
    """
    taken = np.zeros(len(lengths), np.int64)
    if budget <= 0 or not len(lengths):
        return taken
    by = np.full(budget + 1, -1, np.int64)  # the length a sum was first reached with; -2 at 0
    by[0] = -2
    for i, (length, count) in enumerate(zip(lengths.tolist(), counts.tolist())):
        if length > budget or count <= 0:
            continue
        rows = -(-(budget + 1) // length)
        reached = np.zeros(rows * length, bool)
        reached[: budget + 1] = by != -1
        reached = reached.reshape(rows, length)  # a column holds sums that differ by this length
        steps = np.arange(rows)[:, None]
        last = np.maximum.accumulate(np.where(reached, steps, -count - 1), axis=0)
        new = (~reached & (steps - last <= count)).ravel()[: budget + 1]
        by[new] = i
        if by[budget] != -1:
            break
    at = int(np.flatnonzero(by != -1)[-1])
    while at:
        taken[by[at]] += 1
        at -= int(lengths[by[at]])
    return taken


def plan_source(lengths: np.ndarray, counts: np.ndarray, target: float, seed: int, max_repeats: int = MAX_REPEATS):
    """(whole passes, further copies of each length) for one source."""
    total = int((lengths * counts).sum())
    extra = np.zeros(len(lengths), np.int64)
    if total == 0:
        return 0, extra
    wanted = min(int(round(target)), max_repeats * total)
    passes, left = divmod(wanted, total)
    if not left:
        return passes, extra
    order = np.random.default_rng(seed).permutation(len(lengths))
    order = order[lengths[order] > 0]
    window = int(lengths.max())
    if left <= 4 * window:  # a few long documents decide: all counts go into the programme
        extra[order] = fit(lengths[order], counts[order], left)
        return passes, extra
    # as exact integers: counts and budgets may be large
    extra = np.array([int(c) * left // total for c in counts], np.int64)
    extra[lengths == 0] = 0
    left -= int((lengths * extra).sum())
    for i in order:  # one more of some lengths, until the table of sums is short
        if extra[i] < counts[i] and lengths[i] <= left - window:
            extra[i] += 1
            left -= int(lengths[i])
    while left > 2 * window:  # lengths with several spare copies
        spare = np.flatnonzero((extra < counts) & (lengths > 0))
        if not len(spare):
            break
        i = spare[np.argmax(lengths[spare])]
        more = min(int(counts[i] - extra[i]), max(1, (left - window) // int(lengths[i])))
        extra[i] += more
        left -= more * int(lengths[i])
    extra[order] += fit(lengths[order], (counts - extra)[order], left)
    return passes, extra


def mix_plan(counts: DataFrame, weights: tuple, max_repeats: int, seed: int) -> DataFrame:
    """Rows of ``PLAN`` for rows (source, has_source, size, n)."""
    per_source = counts.groupBy("source", "has_source").agg(F.sum(F.col("size") * F.col("n")).alias("words"))
    # one row a source; their targets depend on each other
    sources = sorted(per_source.collect(), key=lambda r: (not r["has_source"], r["source"] or ""))
    own = [weights[i % len(weights)] for i in range(len(sources))]
    sizes = [int(r["words"] or 0) for r in sources]
    goal = dict(zip([(r["source"], r["has_source"]) for r in sources], targets(sizes, own, sum(sizes), max_repeats)))

    def plan(pdf):
        pdf = pdf.sort_values("size", kind="stable").reset_index(drop=True)
        name = pdf["source"].iloc[0] if pdf["has_source"].iloc[0] else None
        lengths, n = pdf["size"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64)
        target = goal[(name, name is not None)]
        passes, extra = plan_source(lengths, n, target, seed, max_repeats)
        pdf["source_size"], pdf["target"] = int((lengths * n).sum()), float(target)
        pdf["passes"], pdf["extra"] = passes, extra
        return pdf[["source", "has_source", "size", "source_size", "target", "passes", "extra"]]

    return counts.groupBy("source", "has_source").applyInPandas(plan, PLAN)


def mix(docs: DataFrame, key: str, source: str, text: str, weights: tuple = WEIGHTS, max_repeats: int = MAX_REPEATS,
        seed: int = SEED, drawn_by: str | None = None) -> DataFrame:
    """One row a document: (key, source, size, source_size, target, copies).

    ``copies`` is how often the mix takes the document. ``drawn_by`` is the column
    whose hash orders the documents, ``key`` unless given.
    """
    rows = docs.select(
        F.col(key).alias("key"), F.col(source).cast("string").alias("source"), F.col(source).isNotNull().alias("has_source"),
        word_count(F.col(text)).alias("size"), F.col(drawn_by or key).cast("string").alias("by"),
    )
    sized = materialise(rows.withColumn("draw", F.xxhash64(F.lit(seed), "by")).drop("by"), "mix-sizes")[0]
    same = ["source", "has_source", "size"]
    counts = sized.groupBy(*same).agg(F.count(F.lit(1)).alias("n"))
    plan = materialise(mix_plan(counts, weights, max_repeats, seed), "mix-plan")[0]
    ranked = with_places(sized, same, ["draw"], "mix-ranks")
    quotas = plan.select(*[F.col(c).alias(f"p_{c}") for c in ("source", "size")], "source_size", "target", "passes", "extra")
    chosen = ranked.join(quotas, F.col("source").eqNullSafe(F.col("p_source")) & (F.col("size") == F.col("p_size")))
    return chosen.select(
        "key", "source", "size", "source_size", "target",
        (F.col("passes") + (F.col("place") < F.col("extra")).cast("bigint")).alias("copies"))


def mixed_documents(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", **options) -> DataFrame:
    """The rows of the mix with the columns of ``docs``: a document taken twice is there twice.

    Rows that share an id or have none are told apart by their own number, given when they are written.
    """
    plain, back = hidden(docs)
    numbered = materialise(plain.withColumn("row", F.monotonically_increasing_id()), "mix-rows")[0]
    copies = mix(numbered, "row", back[source], back[text], drawn_by=back[key], **options).where(F.col("copies") > 0).select(
        F.col("key").alias("taken"), "copies")
    taken = numbered.join(copies, F.col("row") == F.col("taken"))
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))).select(
        *[F.col(back[c]).alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"), "doc_id", "source", "text")
    return mixed.select(
        F.col("key").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
