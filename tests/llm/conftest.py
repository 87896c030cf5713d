import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, size string, items string"


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, columns with clashing names."""
    rng = random.Random(1)
    words = [f"w{i}" for i in range(400)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    long = prose(60_000)
    rows = [
        (0, prose(80), "en", "a", 1, "x", "y", "z"),
        (1, None, None, None, None, None, None, None),
        (2, "", "en", "a", 0, None, None, None),
        (3, " \t\n", "de", "b", 3, None, None, None),
        (4, long, "en", "a", len(long), None, None, None),
        (5, long + " one more", "en", "b", 0, None, None, None),
        (None, prose(50), "en", "c", 0, None, None, None),
        (None, None, None, None, None, None, None, None),
        (6, "One Two", "fr", "c", 7, None, None, None),
        (7, "one two", "fr", None, 7, None, None, None),
        (8, "x" * 50_000, "es", "c", 0, None, None, None),
        (9, "é中😀 word", "es", "", 0, None, None, None),
        (-3, prose(30), "en", "a", 0, None, None, None),
    ]
    rows += [(10, "the same row again and again", "en", "a", 1, None, None, None)] * 3
    rows += [(11, prose(40), "en", "a", 1, None, None, None), (11, prose(40), "en", "b", 1, None, None, None)]
    rows += [(100 + i, "copied text of many documents here", "en", "a", 1, None, None, None) for i in range(300)]
    return spark.createDataFrame(rows, DOCS).repartition(5).cache()
