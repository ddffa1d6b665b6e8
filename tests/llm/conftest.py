import random

import pytest

SYLLABLES = ["ka", "ro", "mi", "tel", "un", "sor", "ve", "dan", "qui", "pha", "lo", "ber"]


@pytest.fixture(scope="session")
def prose():
    """prose(n, seed): n invented words."""

    def make(n, seed):
        r = random.Random(seed)
        return " ".join("".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 4))) for _ in range(n))

    return make


@pytest.fixture(scope="session")
def documents(spark):
    """documents(rows): the driver's columns and one extra column with an awkward name."""

    def make(rows):
        full = [(i, t, lang, src, None if t is None else len(t), "x") for i, t, lang, src in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars long, `key` string"
        return spark.createDataFrame(full, schema)

    return make
