import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that operators use for columns of their own.
CLASHING = "n_lines size score target key node kind block part hash stratum copies start rejected _word".split()


def words(seed: int, n: int, vocabulary: int = 400) -> str:
    pick = random.Random(seed)
    return " ".join(f"w{pick.randrange(vocabulary)}x" for _ in range(n))


BASE = words(1, 300)
ROWS = [
    (1, "One line\n  shared LINE \nlast", "en", "a", 1),
    (2, None, "en", "a", None),
    (3, "", "de", None, 0),
    (None, "a text without id\nshared line", None, None, 7),
    (5, "shared line\nshared line\n" + BASE, "en", "b", 9),
    (5, "shared line\nshared line\n" + BASE, "en", "b", 9),
    (6, words(6, 20_000), "fr", "b", None),
    (7, BASE, "en", "b", 1),
    (8, BASE, "en", None, 1),
    (9, BASE + " tail", "xx", "b", 1),
    (10, " \t \n ", "en", "c", 3),
    (11, "two words", "en", "c", 3),
    (12, "Two  WORDS", "en", "c", 3),
    (13, "É schön 漢字 🙂 naïve x", "fr", "c", 3),
    (-4, "x", None, "c", None),
    (15, None, None, None, None),
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    frame = spark.createDataFrame(ROWS, SCHEMA)
    return frame.withColumns({name: F.lit("clash") for name in CLASHING})


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
