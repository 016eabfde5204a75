import random

import pytest

LONG = "lorem ipsum " * 20_000 + "x" * 50_000


def awkward_rows():
    """Nulls in each column, empty and very long texts, ties and repeated rows."""
    return [
        (1, None, "en", "a", 0),
        (2, "", "en", "a", 0),
        (3, " \n\t ", None, "a", 4),
        (4, "One two three. MIT License", "en", None, None),
        (4, "One two three. MIT License", "en", None, None),
        (None, "One two three. MIT License", "en", "b", 26),
        (5, "One two three. MIT License", "de", "b", 26),
        (6, LONG, "en", "b", len(LONG)),
        (7, "mail ann@example.com or ann@example.com 😀 café İstanbul", None, None, None),
        (8, "123 456 ...", "en", "b", 11),
    ]


AWKWARD = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside or return.
CLASHES = (
    "node", "sig", "root", "_text", "_id", "_hash", "kind", "raw", "canon", "score", "labels",
    "n_words", "start", "offset", "sequence_id", "ids", "id", "half", "head", "cell", "v", "accepted",
)


@pytest.fixture(scope="session")
def awkward(spark):
    df = spark.createDataFrame(awkward_rows(), AWKWARD)
    return df.selectExpr("*", *(f"'clash' AS {c}" for c in CLASHES)).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], AWKWARD)


@pytest.fixture(scope="session")
def words():
    chance = random.Random(5)
    return ["".join(chance.choice("abcdefghij") for _ in range(chance.randint(1, 6))) for _ in range(400)]
