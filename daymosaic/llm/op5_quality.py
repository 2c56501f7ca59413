"""Quality rules as a short-circuit cascade in the order of rejection per cost.

A rule is a boolean expression that is true for texts it rejects. On a sample of about
``SAMPLE_ROWS`` texts every rule is run alone and timed, which gives its cost, and
its rejections are counted on the texts earlier rules have left. The rule with the most
rejections per second goes first, and so on. All rules then make one
CASE expression in that order; Spark stops at the first branch that holds, so a costly rule is
computed only for texts that all cheaper or more selective ones let pass. The order
changes the work, never the verdict.

Everything is DataFrame functions: no Python on the executors, no shuffle.

Measures of whole texts: ``n_words``, ``word_chars``, ``n_symbols``, ``n_lines``, ``n_dup_lines`` and
``n_repeat_words``, the words in runs of three that occur twice or more in the text.
Runs are hashed first; only a text in which two hashes agree has its runs
sorted as text and compared exactly.

Defined results: null, empty and blank texts have no words or lines, all
measures 0, and fail the word count; ratios of nothing are 0; an empty table or sample keeps
the rules' given order; repeated rows give repeated results; columns of ``docs``
must not be named like a measure.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daymosaic.llm.tables import BLANK_CLASS, BLANKS, let, save, table, word_array

SAMPLE_ROWS = 2_000
SYMBOLS = "[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    name: str
    #: SQL text over the measures and ``text``; true rejects, null passes
    rejects: str


#: fails the contract's base; the others follow published heuristics for web text
BASE_RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_runs", "100 * n_repeat_words > 50 * n_words"),
)
RULES = (
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("duplicate_lines", "2 * n_dup_lines > n_lines"),
    Rule("word_length", "word_chars < 2 * n_words or word_chars > 15 * n_words"),
    Rule("capitals", r"2 * length(regexp_replace(text, '[^A-Z]+', '')) > word_chars"),
    Rule("exclamations", "2 * (length(text) - length(replace(text, '!', ''))) > n_words"),
)


def _repeated(words: Column) -> Column:
    """Words inside runs of three that occur at least twice; ``words`` must be a column or bound by ``let``."""
    n = F.size(words)
    places = F.sequence(F.lit(0), n - F.lit(3))
    hashes = F.transform(places, lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2]))
    runs = F.sort_array(F.transform(places, lambda i: F.struct(
        F.concat_ws(" ", words[i], words[i + 1], words[i + 2]).alias("run"), i.alias("at"))))
    repeated = let(runs, lambda s: F.sort_array(F.transform(F.filter(
        F.transform(s, lambda x, k: F.struct(
            x["at"].alias("at"),
            (F.get(s, k - 1)["run"].eqNullSafe(x["run"]) | F.get(s, k + 1)["run"].eqNullSafe(x["run"])).alias("twice"))),
        lambda x: x["twice"]), lambda x: x["at"])))
    covered = let(repeated, lambda p: F.aggregate(
        F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3)))),
        F.lit(0).cast("bigint"), lambda total, x: total + x))
    collide = let(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return F.when(n < 4, F.lit(0).cast("bigint")).when(collide, covered).otherwise(F.lit(0).cast("bigint"))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``text`` null as empty and the measures as columns.

    A column of ``docs`` named like a measure stays as ``given_<name>``.

    Every measure binds its own words or lines, so the optimizer may move or repeat
    it, as it does below a filter, without making them for each word again.
    """
    t = F.col("text")
    lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    measures = {
        "n_words": F.size(word_array(t)).cast("bigint"),
        "word_chars": F.length(F.regexp_replace(t, f"{BLANK_CLASS}+", "")).cast("bigint"),
        "n_symbols": (F.length(t) - F.length(F.regexp_replace(t, SYMBOLS, ""))).cast("bigint"),
        "n_lines": F.size(lines).cast("bigint"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint"),
        "n_repeat_words": let(word_array(t), _repeated),
    }
    given = docs.withColumnsRenamed({c: f"given_{c}" for c in docs.columns if c.lower() in measures})
    return given.withColumn("text", F.coalesce(F.col(text), F.lit(""))).withColumns(measures)


def rejected(rule: Rule) -> Column:
    return F.coalesce(F.expr(rule.rejects), F.lit(False))


def _seconds(df: DataFrame) -> float:
    start = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def ordered(sample: DataFrame, rules: tuple[Rule, ...]) -> list[Rule]:
    """``rules`` by rejection per cost on ``sample``, each on what those before it have left."""
    flags = [rejected(r).alias(f"r{k}") for k, r in enumerate(rules)]
    nothing = min(_seconds(sample.select(F.lit(1).alias("x"))) for _ in range(2))
    cost = [max(min(_seconds(sample.select(f)) for _ in range(2)) - nothing, 1e-4) for f in flags]
    # the pattern of verdicts: at most 2 ** rules rows, of a bounded sample
    patterns = [(tuple(r)[:-1], r["n"]) for r in
                sample.select(flags).groupBy([f"r{k}" for k in range(len(rules))]).agg(F.count(F.lit(1)).alias("n")).collect()]
    order, left = [], set(range(len(rules)))
    while left:
        def gain(k):
            return sum(n for p, n in patterns if p[k] and not any(p[j] for j in order)) / cost[k]

        best = max(sorted(left), key=gain)
        order.append(best)
        left.discard(best)
    return [rules[k] for k in order]


def sampled(docs: DataFrame, rows: int = SAMPLE_ROWS, text: str = "text") -> DataFrame:
    """About ``rows`` rows of ``docs`` by a hash of the text, written to the shared folder."""
    share = min(1.0, rows / max(docs.count(), 1))
    kept = F.pmod(F.xxhash64(F.lit(5), F.col(text)), F.lit(1_000_000)) < int(share * 1_000_000 + 1)
    return save(docs.where(kept).limit(4 * rows), "quality-sample")[0]  # repeated texts share a hash


def first_rejection(order: list[Rule]) -> Column:
    """Name of the first rule in ``order`` that rejects; null when all pass."""
    verdict = F.lit(None).cast("string")
    for rule in reversed(order):
        verdict = F.when(rejected(rule), F.lit(rule.name)).otherwise(verdict)
    return verdict


def cascade(docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + RULES, text: str = "text") -> DataFrame:
    """``docs`` with measures and ``rejected_by``: the first rule to reject in the estimated order, or null."""
    order = ordered(measured(sampled(docs, text=text), text), rules)
    return measured(docs, text).withColumn("rejected_by", first_rejection(order))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = cascade(docs)
    base_failed = rejected(BASE_RULES[0]) | rejected(BASE_RULES[1])
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"), F.col("rejected_by").isNull().alias("kept"))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
 w AS (SELECT r, doc_id, text,
    list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
 g AS (SELECT r, i, w[i:i + 2] AS g FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 1, 1))) AS i FROM w)),
 t AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g) WHERE n > 1),
 p AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 3)) AS p FROM t) GROUP BY r),
 m AS (SELECT doc_id, text, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, len(l) AS n_lines,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(p.n, 0) AS BIGINT) AS n_repeat_words
    FROM w LEFT JOIN p USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > n_words OR 2 * n_dup_lines > n_lines
        OR word_chars < 2 * n_words OR word_chars > 15 * n_words
        OR 2 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > word_chars
        OR 2 * (length(text) - length(replace(text, '!', ''))) > n_words) AS kept
FROM m"""
