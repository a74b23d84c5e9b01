"""Small documents with every awkward case, for all corpus operators."""

from __future__ import annotations

import random

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int, words: str = "alpha beta gamma delta epsilon zeta eta theta iota kappa") -> str:
    rnd = random.Random(seed)
    return " ".join(rnd.choice(words.split()) + str(rnd.randint(0, 300)) for _ in range(n))


@pytest.fixture(scope="session")
def awkward_rows():
    """Nulls in every column, empty and very long texts, repeated rows, copies, white space of all kinds, special strings."""
    passage = prose(1, 60)
    rows = [
        (1, passage, "en", "a", 1),
        (2, f"{prose(2, 30)} {passage} {prose(3, 30)}", "en", "a", 1),
        (3, None, None, None, None),
        (4, "", "en", "a", 0),
        (5, " \t\n\r\x0b\x0c ", "en", None, 7),
        (6, prose(4, 20_000), "en", "a", 1),
        (7, passage, "en", "a", 1),
        (7, passage, "en", "a", 1),
        (None, passage, "en", "a", 1),
        (8, "x" * 5000, "de", "a", 1),
        (9, "<|endoftext|> in a text <|startoftext|> and odd space \U0001f600 İstanbul 1/2 \x00", "fr", "a", 1),
        (10, "spam " * 300, "en", "a", 1),
        (11, "Don't we'll l'été Straße é naïve 2024's 中文 !!??", None, "a", 1),
        (12, f"{prose(5, 40)}\n{prose(5, 40)}\n\n{prose(5, 40)}", "es", "a", 1),
        (-13, prose(6, 200), "en", "a", 1),
        (14, prose(6, 200).replace("alpha", "alfa", 1), "en", "a", 1),
        (15, "one", "en", "a", 1),
        (16, "one two", "en", "a", 1),
        (17, "ONE two", "en", "a", 1),
    ]
    return rows


@pytest.fixture
def awkward(spark, awkward_rows):
    """The rows with extra columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(awkward_rows, DOCUMENTS)
    extra = ["id", "score", "cut", "found", "label", "block", "row", "fp", "gone_id", "trusted", "length", "rank", "ids", "kept"]
    return df.withColumns({name: F.lit(name) for name in extra})


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)


def text_of(row) -> str:
    return row[1] or ""


def by_key(df, *keys):
    return sorted((tuple(r) for r in df.select(*keys).collect()), key=repr)
