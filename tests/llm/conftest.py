import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, did string, n string, pos string"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (id, text) pairs, with further columns whose names the operators use."""

    def make(pairs, lang="en", source="s"):
        rows = [(i, t, lang, source, len(t or ""), "k", "d", "n", None) for i, t in pairs]
        return spark.createDataFrame(rows, SCHEMA)

    return make


@pytest.fixture
def words():
    def make(n, seed=0, vocabulary=5000):
        r = random.Random(seed)
        return [f"w{r.randrange(vocabulary)}" for _ in range(n)]

    return make
