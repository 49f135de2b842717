import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, score double, bands int, row int"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text), with columns whose names operators use inside."""
    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", None, "k", 0.5, 1, 2) for i, t in rows], DOCS)

    return make


def prose(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


@pytest.fixture(scope="session")
def hard_rows():
    """Nulls, empty and blank texts, one word, a long text without a blank, near and exact copies, repeated rows, periodic bytes,
    one id with two texts, a null id, characters of several bytes."""
    rng = random.Random(4)
    base = prose(rng, 120)
    near = base.split()
    near[60] = "changed"
    return [(0, None), (1, ""), (2, " \n\t "), (3, "word"), (4, "x" * 300_000), (5, base), (6, base), (6, base), (7, " ".join(near)),
            (8, "ab" * 400), (9, "é" * 300 + prose(rng, 30) + "é" * 300), (10, base[:200] + "!" + base[200:]), (None, base),
            (11, "one text"), (11, "another text " + base), (12, prose(rng, 5000, 100_000)), (13, "word")]
