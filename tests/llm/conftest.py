from __future__ import annotations

import random

import pytest

#: Columns that operators use for themselves, given to them as extra columns of the input.
CLASHING = "id fingerprint component score shard slot size length piece uid y x a b lines hits key label term path licence kind own similarity words start p language node root".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (id, text[, lang[, source]]), with extra columns whose names clash."""

    def make(rows):
        full = [(*r, *[None] * (4 - len(r)))[:4] for r in rows]
        return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), *["7"] * len(CLASHING)) for r in full], SCHEMA)

    return make


@pytest.fixture(scope="session")
def labels(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id long, quality int, toxic int").selectExpr("*", "'7' AS text", "'7' AS y", "'7' AS _order")


def odd_rows():
    """Nulls, empty and blank texts, one very long text, repeated rows and ids."""
    long = " ".join(random.Random(3).choice(["lorem", "ipsum", "dolor", "sit", "the", "amet.\n"]) for _ in range(60_000))
    return [
        (1, None, None, None), (2, "", "en", "s1"), (3, " \n\t ", "en", None), (4, "one", "en", "s1"), (4, "one", "en", "s1"), (5, long, "en", "s2"),
        (None, "one two three four five six seven", None, "s1"), (None, None, None, None), (6, "one two three four five six seven", "en", "s3"),
        (7, "Ünï cödé 日本語 🙂 \u0000 ퟿", "xx", "s3"), (7, "the other text of seven", "en", "s3"),
    ]


def prose(rng: random.Random, n: int, words: list[str]) -> str:
    return " ".join(rng.choice(words) for _ in range(n))
