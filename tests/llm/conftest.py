import pytest

DOC = "doc_id long, text string"


@pytest.fixture
def frame(spark):
    """rows, DDL -> DataFrame."""
    return lambda rows, ddl=DOC: spark.createDataFrame(rows, ddl)


@pytest.fixture
def sentence():
    """Reproducible invented prose: sentence(seed, words)."""
    import random

    def make(seed, n):
        rng = random.Random(seed)
        return " ".join("".join(rng.choice("aeioubcdlmnrst") for _ in range(rng.randint(2, 8))) for _ in range(n))
    return make
