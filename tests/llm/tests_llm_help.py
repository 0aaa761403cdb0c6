"""Inputs that several tests share."""

import random

import pytest


def prose(seed, words=40):
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("bcdfglmnrst") + draw.choice("aeiou") for _ in range(draw.randint(1, 4))) for _ in range(words))


ODD = "doc_id long, text string, lang string, source string, n_chars long, shard string, _h string, kept string, a long, `x.y` int"


def rare(doc_id, text, source="s1", n=0):
    return (doc_id, text, "en", source, n, "mine", "mine", "mine", 1, 2)


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, ties and columns whose names clash."""
    rows = [
        rare(1, prose(1)), rare(1, prose(1)), rare(2, None), rare(3, ""), rare(4, " \n\t "), rare(None, prose(5)),
        rare(6, prose(6, 30_000), None), rare(7, prose(1)), rare(8, "One"), rare(9, prose(9), None), rare(None, None, None),
        *[rare(i, prose(i), f"s{i % 3}") for i in range(20, 60)],
    ]
    return spark.createDataFrame(rows, ODD)


@pytest.fixture(scope="session")
def none(spark, odd):
    return spark.createDataFrame([], odd.schema)
