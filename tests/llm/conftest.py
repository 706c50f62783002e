import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def documents(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source) rows, with a
    further column whose name operators use themselves."""

    def make(rows):
        full = [(*r, *("en", "a")[len(r) - 2 :], len(r[1] or ""), "x") for r in rows]
        return spark.createDataFrame(full, SCHEMA + ", row string")

    return make


def vocabulary(seed, n):
    import random

    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(n)]


@pytest.fixture()
def prose():
    """``prose(seed, words)``: a line of made-up words."""
    import random

    words = vocabulary(5, 3000)

    def make(seed, n):
        rng = random.Random(seed)
        return " ".join(rng.choice(words) for _ in range(n))

    return make
