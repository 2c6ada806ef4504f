import pytest


@pytest.fixture
def docs(spark):
    """Rows (doc_id, text) with columns whose names operators use inside."""
    def build(rows):
        full = [(i, t, "x", 1.0, "n", 7) for i, t in rows]
        return spark.createDataFrame(full, "doc_id long, text string, id string, score double, start string, n int")
    return build


@pytest.fixture(scope="session")
def prose():
    """Distinct texts, the same in every run."""
    import random

    def build(n_words, seed):
        r = random.Random(seed)
        return " ".join("".join(r.choice("aeioubcdlmnrst") for _ in range(r.randint(2, 9))) for _ in range(n_words))
    return build
