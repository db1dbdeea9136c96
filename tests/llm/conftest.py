"""Small tables with awkward rows, shared by the tests of this folder."""

import random

import pytest
from pyspark.sql import functions as F

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, count string, value string"


def words(rng, n, vocab=400):
    return " ".join(f"w{rng.randrange(vocab)}" for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and long texts, repeated rows, extra columns with clashing names."""
    rng = random.Random(5)
    base = [words(rng, 60) for _ in range(12)]
    rows = [(i, t, "en", "a", len(t)) for i, t in enumerate(base)]
    rows += [(20 + i, base[0], "en", "b", None) for i in range(6)]                 # copies
    rows += [(30, base[1].replace("w1", "x1", 1), "en", None, 1), (31, base[1].upper(), None, "b", 2)]
    rows += [(40, None, None, None, None), (41, "", "de", "a", 0), (42, " \t\n ", "fr", "c", 4), (43, "é日本 ß", "de", "c", 4)]
    rows += [(50, words(rng, 9000), "en", "a", 1), (51, "same " * 300, "en", "a", 1), (52, "x" * 40000, "en", "a", 1)]
    rows += [(7, base[7], "en", "a", 60), (None, base[2], "en", "a", 1), (None, None, None, None, None)]
    return spark.createDataFrame([(*r, "extra", "more") for r in rows], DOC_SCHEMA).repartition(5, F.col("text"))


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
