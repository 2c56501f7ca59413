import random
import textwrap

from hypothesis import given, settings, strategies as st

from daymosaic.llm import op6_licence as licence
from daymosaic.llm.licence_texts import STATEMENTS


def test_full_and_altered_texts():
    known = licence.Templates(STATEMENTS, licence.LEAST_DICE)
    mit = STATEMENTS["MIT"][2]
    assert known.scan(f"Copyright (c) 2020 Someone\n\n{mit}")[0] == ("MIT", 1.0)
    changed = known.scan(mit.replace("sublicense", "rent").upper())
    assert changed[0][0] == "MIT" and licence.LEAST_DICE <= changed[0][1] < 1
    assert known.scan("words\nReleased under the MIT licence.\nmore words and more") == [("MIT", 1.0)]
    assert known.scan("Some text. Licensed under CC BY-NC 4.0. Other text.") == [("CC-BY-NC-4.0", 1.0)]
    assert known.scan("the license of the dog was under the table") == [] == known.scan(None) == known.scan("")
    both = known.scan("Licensed under the Apache License, Version 2.0.\nReleased under the MIT License.")
    assert [x[0] for x in both] == ["Apache-2.0", "MIT"]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from("a b c d e f".split()), max_size=12), st.lists(st.lists(st.sampled_from("a b c d e f".split()), min_size=1, max_size=9), min_size=1, max_size=6))
def test_size_bounds_lose_nothing(words, templates):
    given_ = {f"L{i}": (" ".join(t),) for i, t in enumerate(templates)}
    known = licence.Templates(given_, 0.7)
    own = licence.bigrams(words)
    full = {n for n, (t,) in given_.items() if own and licence.dice(own, licence.bigrams(licence.normalised(t))) >= 0.7}
    if own:
        assert full == {n for _, n, g in known.candidates(len(own)) if licence.dice(own, g) >= 0.7}


WORDS = st.sampled_from("a b c d e f".split())


@settings(max_examples=150, deadline=None)
@given(st.lists(WORDS, max_size=30), st.lists(st.lists(WORDS, min_size=1, max_size=12), min_size=1, max_size=5), st.sampled_from([0.6, 0.7, 0.85]))
def test_windows_equal_a_scan_of_every_window(words, templates, least):
    given_ = {f"L{i}": (" ".join(t),) for i, t in enumerate(templates)}
    known = licence.Templates(given_, least)
    found = {}
    for d, name, first, end, _ in known.windows(words):
        own = set(licence.sequence(words)[first:end])
        assert licence.dice(own, licence.bigrams(given_[name][0].split())) == d
        found[name] = max(d, found.get(name, 0))
    grams, every = licence.sequence(words), {}
    for name, (t,) in given_.items():
        best = max((licence.dice(set(grams[a:b]), licence.bigrams(t.split())) for a in range(len(grams)) for b in range(a + 1, len(grams) + 1)), default=0)
        if best >= least:
            every[name] = best
    assert found == every


def filler(rng, n):
    return " ".join(rng.choice("stone river light garden winter paper music under the of and to in house morning silver".split()) for _ in range(n))


def laid_out(text, how):
    lines = textwrap.wrap(" ".join(text.split()), 58)
    if how == "commented":
        return "/*\n" + "\n".join(" * " + line for line in lines) + "\n */"
    if how == "paragraphs":
        return "\n\n".join("\n".join(lines[k: k + 4]) for k in range(0, len(lines), 4))
    return "\n".join("# " + line for line in lines) if how == "hashes" else text


def test_every_template_is_found_alone_and_inside_long_texts():
    """Recall over all templates and layouts is 1."""
    known, rng = licence.Templates(STATEMENTS, licence.LEAST_DICE), random.Random(2)
    right = total = 0
    for name, texts in STATEMENTS.items():
        for text in texts:
            for how in ("plain", "paragraphs", "commented", "hashes"):
                for around in (0, 60, 6000):
                    body = f"{filler(rng, around // 2)}\n\n{laid_out(text, how)}\n\n{filler(rng, around // 2)}"
                    found = known.scan(body)
                    total += 1
                    right += any(n == name and d > 0.95 for n, d in found)  # wrapping may put words on a copyright line
    assert total == 720 == right
    assert not any(known.scan(filler(rng, 3000)) for _ in range(20))


def test_two_licences_and_a_mention_in_a_sentence():
    known, rng = licence.Templates(STATEMENTS, licence.LEAST_DICE), random.Random(3)
    mit, apache = STATEMENTS["MIT"][2], STATEMENTS["Apache-2.0"][1]
    found = dict(known.scan(f"{filler(rng, 500)}\n{mit}\n{filler(rng, 500)}\n{laid_out(apache, 'commented')}"))
    assert found["MIT"] == 1.0 and found["Apache-2.0"] > 0.95
    assert known.scan("The code, as always, is released under the MIT License. Enjoy!") == [("MIT", 1.0)]


def test_table(spark, awkward):
    rows = licence.licences(awkward.withColumnRenamed("lang", "found")).collect()
    assert len(rows) == 11 and all(r["found"] == [] for r in rows)
    assert licence.licences(awkward.limit(0)).count() == 0
