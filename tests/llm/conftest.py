import random

import pytest


@pytest.fixture
def prose():
    """Texts of made-up words from a seed."""

    def make(n, seed=0, size=4000):
        rng = random.Random(seed)
        pool = ["".join(rng.choice("abcdefghijklmnopqrst") for _ in range(rng.randint(2, 9))) for _ in range(size)]
        return " ".join(rng.choice(pool) for _ in range(n))

    return make


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    def make(rows, extra=()):
        """rows: (id, text) or (id, text, source)."""
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS).repartition(3)

    return make
