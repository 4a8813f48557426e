import random

import pytest

WORDS = "the of and a to in is that it was for on are as with his they at be this from have or by one had not but what all".split()


@pytest.fixture(scope="session")
def prose():
    """Random words, some of them common: prose(seed, n)."""
    def make(seed, n):
        r = random.Random(seed)
        return " ".join(r.choice(WORDS) if r.random() < 0.3 else "".join(r.choice("bcdfglmnprst") + r.choice("aeiou") for _ in range(3)) for _ in range(n))

    return make


@pytest.fixture(scope="session")
def odd_docs(spark, prose):
    """Nulls in any column, empty, long and repeated rows, ties, and columns whose names clash with internal ones."""
    long = prose(1, 30_000)
    same = prose(2, 80)
    rows = [
        (1, same, "en", "a"), (2, None, "en", "a"), (3, "", None, None), (4, long, "en", "b"), (5, same, "de", "b"),
        (6, "word", "en", None), (7, "!!! ???", "en", "a"), (None, same, "en", "a"), (8, same + " more", "en", "c"), (8, same + " more", "en", "c"),
        (9, "É" * 70, None, "c"), (10, long + " tail", "en", "a"),
    ]
    return spark.createDataFrame(
        [(*r, 0, 1.5, "x", [1], "y", 3, "z") for r in rows],
        "doc_id long, text string, lang string, source string, n_chars long, position double, id string, bands array<int>, label string, part int, size string")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
