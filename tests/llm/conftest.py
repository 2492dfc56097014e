from __future__ import annotations

import random

import pytest


def words(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randint(0, vocabulary)}" for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """Texts with copies, near copies, shared passages, nulls, empty and very long texts, periodic bytes and ties."""
    rng = random.Random(11)
    rows = [(i, words(rng, rng.choice([1, 3, 8, 40, 120, 300]))) for i in range(60)]
    base = words(rng, 150)
    for i in range(60, 80):
        w = base.split()
        for _ in range(rng.randint(0, 8)):
            w[rng.randrange(len(w))] = f"x{rng.randint(0, 99)}"
        rows.append((i, " ".join(w)))
    passage = words(rng, 60)
    rows += [(i, f"{words(rng, 20)} {passage}\n{words(rng, 30)}") for i in range(80, 100)]
    rows += [(100, None), (101, ""), (102, " \t\n"), (103, "é" * 400), (104, "ab" * 300), (105, words(rng, 60_000, 5000)), (106, rows[3][1]), (106, rows[3][1]), (107, "Ü " + passage), (None, base), (108, "A b C d"), (109, "a B c D"), (110, "solo"), (111, "\x00" * 250)]
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, "doc_id long, text string").repartition(5)
