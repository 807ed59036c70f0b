import random

import pytest

SYLLABLES = "an er on in the re ou ti st ed es ha nd to is or".split()


@pytest.fixture(scope="session")
def prose():
    """Invented words from a seed."""

    def build(seed, words):
        draw = random.Random(seed)
        return " ".join("".join(draw.choice(SYLLABLES) for _ in range(draw.randint(1, 3))) for _ in range(words))

    return build


@pytest.fixture(scope="session")
def documents(spark):
    """(doc_id, text) rows with columns whose names clash with those that operators use inside."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, id long, part int, run string, key string, n int, node string, label int, score double, mean double, size long, gram long, anchor long"

    def build(rows):
        full = [(i, t, "en", "s", None if t is None else len(t), 1, 2, "r", "k", 3, "x", 4, 42.0, 5.0, 6, 7, 8) for i, t in rows]
        return spark.createDataFrame(full, schema)

    return build
