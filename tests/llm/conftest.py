import random

import pytest

WORDS = ["alpha", "beta", "gamma", "delta", "omega", "sigma", "theta", "kappa", "lambda", "rho", "tau", "phi", "Ünï", "zé"]


def prose(seed, words):
    pick = random.Random(seed)
    return " ".join("".join(pick.choices(WORDS, k=2)) for _ in range(words))


@pytest.fixture(scope="session")
def odd_rows():
    """Rows with every awkward text: null, empty, blank, tiny, very long, repeated, near copies, null id."""
    long = prose(1, 20_000)
    base = prose(2, 200)
    near = base.replace(base.split()[50], "changed", 1)
    rows = [
        (1, None), (2, ""), (3, "  \n\t "), (4, "a"), (5, long), (6, base), (7, base), (7, base), (8, near),
        (9, "x" * 5000), (10, prose(3, 60) + "\n" + base), (None, base), (None, None), (11, "Ünïcode é ü 漢字 🙂"), (12, "ab ab ab"),
    ]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    """The awkward rows with columns that are called like those that operators make."""
    rows = [(i, t, "s", None, k, "c", -1.0, "b") for k, (i, t) in enumerate(odd_rows)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, score double, row long, kept string, c0 double, block string"
    ).repartition(3)
