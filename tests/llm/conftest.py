import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty and long texts, repeated rows and ids, one text in many rows."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    sentence = lambda n: " ".join(word() for _ in range(n))
    rows = [(i, sentence(30 + i), rng.choice(["en", "de"]), f"s{i % 3}", 1) for i in range(40)]
    copy = sentence(60)
    rows += [(100 + i, copy, "en", "s0", 2) for i in range(25)]
    rows += [(1, rows[1][1], "en", "s1", 1), (1, "other text", None, None, None), (200, None, None, None, None),
             (201, "", "en", "s2", 0), (202, " \n\t ", "de", "s2", 3), (203, "Ünïcödé " * 30, None, "s1", 9),
             (None, "a row without id " * 5, "en", "s0", 4), (None, None, None, None, None),
             (204, sentence(20000), "en", "s0", 5), (205, "x" * 30000, "de", "s1", 6)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
