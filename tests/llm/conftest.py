import random

import pytest
from pyspark.sql import Row

from tallyfold.session import ship_package

_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, words string, _t string, _id int"


@pytest.fixture(scope="session")
def session(spark):
    ship_package(spark)
    return spark


def _words(rng, n, size=400):
    return [f"w{rng.randrange(size)}{'é' if rng.random() < 0.05 else ''}" for _ in range(n)]


@pytest.fixture(scope="session")
def corpus():
    """Texts with exact and near copies, shared passages, repeats, odd
    spaces, nulls, empty ones and a very long one."""
    rng = random.Random(5)
    passage = _words(rng, 70)
    texts = [None, "", "   \t\n", "one two three", "ONE Two three", "a b c d e", "x"]
    for i in range(60):
        w = _words(rng, rng.randrange(1, 160))
        if i % 4 == 0:
            at = rng.randrange(len(w))
            w[at:at] = passage[rng.randrange(0, 15) :]
        if i % 9 == 0:
            w = w + w[: len(w) // 2] + ["###"] * 3
        texts.append(rng.choice([" ", "\n", "  ", " \x0b"]).join(w))
    base = _words(rng, 120)
    for i in range(14):  # near copies of one text
        w = list(base)
        for _ in range(i // 3):
            w[rng.randrange(len(w))] = f"edit{i}"
        texts.append(" ".join(w))
    texts += [texts[10]] * 5 + [" ".join(_words(rng, 6000))]
    return [(i * 3 % 997, t) for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def docs(session, corpus):
    rows = [Row(i, t, "en" if i % 2 else None, None if i % 5 == 0 else f"s{i % 3}", None, "clash", "clash", 7) for i, t in corpus]
    return session.createDataFrame(rows, _SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def empty(session):
    return session.createDataFrame([], _SCHEMA)
