import os

import pytest

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def data():
    if not os.path.isdir(DATA):
        pytest.skip("needs the test tables")
    return DATA


@pytest.fixture
def documents(spark):
    """Documents with every awkward case: nulls, empties, ties, repeats, a long text, clashing columns."""
    def make(rows, extra=""):
        return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint" + extra)

    return make


@pytest.fixture
def awkward(documents):
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    return documents([
        (1, "alpha beta gamma delta epsilon zeta", "en", "a", 1), (2, None, None, None, None), (3, "", "en", "a", 0),
        (4, " \t\n ", "en", "b", 4), (None, "alpha beta gamma delta epsilon zeta", "en", "a", 1),
        (5, "alpha beta gamma delta epsilon zeta", "en", "a", 1), (5, "alpha beta gamma delta epsilon zeta", "en", "a", 1),
        (6, "one two", "en", "b", 7), (7, "One  TWO", "en", None, 8), (8, long, "en", "a", len(long)), (9, "été là 日本語  x", "fr", "b", 9),
    ])
