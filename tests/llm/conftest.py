import random

import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def shared(spark):
    """The session; tables that cut lineage go to a temporary folder, as no shared one is set."""
    return spark


@pytest.fixture(scope="session")
def make(shared):
    """Documents from ``(doc_id, text)`` pairs, with further columns of clashing names."""
    from pyspark.sql import functions as F

    def build(rows, **columns):
        df = shared.createDataFrame([(i, t, None, None, None if t is None else len(t)) for i, t in rows], DOC)
        for name in ("row", "node", "path", "kept", "n_words", "taken", "hits", "copy"):
            df = df.withColumn(name, F.lit(1))
        for name, value in columns.items():
            df = df.withColumn(name, F.lit(value))
        return df

    return build


@pytest.fixture
def rng():
    return random.Random(5)


@pytest.fixture(scope="session")
def words():
    r = random.Random(1)
    return ["".join(r.choice("aeiounrstlé") for _ in range(r.randint(2, 7))) for _ in range(400)]
