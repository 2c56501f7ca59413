import collections
import re

import pytest

from daymosaic.llm import op5_quality as quality


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = collections.Counter(zip(w, w[1:], w[2:]))
    covered = {p for i in range(len(w) - 2) if runs[tuple(w[i:i + 3])] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines), len(lines) - len(set(lines)), len(covered))


MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


def test_measures_equal_brute_force(spark, awkward, documents):
    more = documents([(20 + i, t, None, None, 0) for i, t in enumerate([
        "a b c a b c", "a a a a", "a a a", "x y", "a b a b a b a", "#a **b\n#a **b\n\n \n#a **b", "ä$ö 日本 ä$ö 日本 ä$ö 日本"])])
    rows = quality.measured(awkward.unionByName(more)).select("doc_id", "text", *MEASURES).collect()
    for r in rows:
        assert tuple(r[m] for m in MEASURES) == brute(r["text"]), r["doc_id"]


@pytest.fixture
def few_rules():
    return (quality.Rule("never", "n_words < 0"), quality.Rule("short", "n_words < 3"),
            quality.Rule("costly", "length(regexp_replace(text, '[aeiou]+', '')) < 0"), quality.Rule("unknown", "null"))


def test_order_puts_rejection_per_cost_first(spark, awkward, few_rules):
    order = quality.ordered(quality.measured(awkward), few_rules)
    assert order[0].name == "short" and set(order) == set(few_rules)


def test_verdict_does_not_depend_on_the_order(spark, awkward, documents):
    rules = quality.BASE_RULES + quality.RULES
    measured = quality.measured(awkward.unionByName(documents([(30, " ".join(f"good{i}" for i in range(80)), None, None, 0)])))
    kept = [sorted(str(r["doc_id"]) for r in measured.where(quality.first_rejection(list(o)).isNull()).collect())
            for o in (rules, rules[::-1])]
    assert kept[0] == kept[1] == ["30"]


def test_later_rules_are_not_evaluated(spark, awkward):
    trap = quality.Rule("trap", "raise_error('reached') = ''")
    row = quality.measured(awkward.where("doc_id = 6")).select(
        quality.first_rejection([quality.BASE_RULES[0], trap]).alias("by")).first()
    assert row["by"] == "few_words"


def test_empty_table(spark, awkward):
    assert quality.cascade(awkward.limit(0)).count() == 0


def test_main_path_has_no_python(spark, data, plan):
    text = plan(quality.query(spark, data))
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text


def test_columns_named_like_measures_stay(spark, awkward):
    from daymosaic.llm import op5_quality as quality

    got = quality.measured(awkward.withColumnRenamed("n_chars", "n_words")).collect()
    assert {r["given_n_words"] for r in got} == {r["n_chars"] for r in awkward.collect()} and max(r["n_words"] for r in got) == 60_000
