import random

import pytest

WORDS = ["alpha", "beta", "gamma", "delta", "und", "the", "of", "été", "ño", "zeta", "eta", "theta", "iota", "kappa"]


@pytest.fixture
def rng():
    return random.Random(7)


@pytest.fixture(scope="session")
def make_docs(spark):
    """documents with the columns of the table (and one clashing with results)."""
    def make(rows, extra=False):
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        full = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows]
        if extra:
            return spark.createDataFrame([(*r, "x", "y", "z", 1) for r in full],
                                         schema + ", fp string, score string, shard string, size int")
        return spark.createDataFrame(full, schema)

    return make


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture
def odd_rows(rng):
    """Null and empty texts, null ids and sources, ties, repeated rows, a very long text."""
    a, b = prose(rng, 40), prose(rng, 60)
    return [(1, a, "s1"), (2, a, "s1"), (3, b, "s2"), (3, b, "s2"), (4, None, "s2"), (5, "", None), (6, " \n\t ", None),
            (None, a, "s1"), (7, prose(rng, 30_000), "s3"), (8, "x", "s3"), (9, "Ünïcödé 漢字   \x1c end", "s3")]
