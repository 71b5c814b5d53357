import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, q int, key string, mark string, many int, "
          "ll string, size string, taken string, ids string, p string, posterior double")
SYL = ["the", "an", "ing", "or", "re", "st", "ou", "ble", "nd", "ti", "ha", "wh", "ed", "es"]


def words(rng, n):
    return ["".join(rng.choice(SYL) for _ in range(rng.randint(1, 4))) for _ in range(n)]


def edit(rng, text, share):
    return " ".join(rng.choice(SYL) if rng.random() < share else w for w in text.split(" "))


@pytest.fixture(scope="session")
def texts():
    """Originals, exact copies, near copies, shared passages, odd texts."""
    rng = random.Random(5)
    out = []
    passage = " ".join(words(rng, 60))
    for k in range(12):
        base = " ".join(words(rng, rng.choice([3, 6, 30, 120, 400])))
        if k % 3 == 0:
            base = f"{base} {passage}"
        out.append(base)
        out += [edit(rng, base, 0.01) for _ in range(k % 4)]
        out += [base.upper()] * (k % 2)
    many = " ".join(words(rng, 80))
    out += [edit(rng, many, 0.02) for _ in range(25)]
    out += [None, "", "   \n\t ", "one", "one", "two words", "a b c d", "A B C D", "a b c d e", "a b", "é" * 30,
            " ".join(words(rng, 5000)), "the the the the the the the the"]
    return out


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts with ids, a null id, a repeated row, and columns whose names clash."""
    rows = [(k, t, ["en", "fr", None][k % 3], ["s0", "s0", "s1", "é", None][k % 5], None, 1, "k", "m", 2, "l", "s", "t", "i", "p", 0.5)
            for k, t in enumerate(texts)]
    rows += [rows[0], rows[-1], (None, *rows[1][1:]), (None, "x " * 30, "en", "s0", *rows[0][4:])]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
