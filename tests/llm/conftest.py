from __future__ import annotations

import random

import pytest

WORDS = "the of and to in that is was for on are with as be this have from or had by but some what there we".split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "er", "ing", "ly"]) for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows and columns whose names clash with internal ones."""
    base = prose(1, 80)
    rows = [(1, base), (2, base), (2, base), (3, "  " + base.replace(" ", "\n\t")), (4, None), (5, ""), (6, " \n "),
            (7, base.replace(base.split()[40], "changed", 1)), (8, prose(2, 30_000)), (9, "one two"), (10, "ONE two"),
            (11, "mail a.b@c.example.com now"), (None, base), (None, None), (12, "été ñandú <|endoftext|>  x\x1cy ́z"),
            (13, prose(3, 60) + " Licensed under CC BY-NC 4.0. " + prose(4, 60)), (14, "12345 678 ###")]
    clash = [(i, t, "en" if t else None, None, 0, i, "t", "n", True, "h", 1, 0.5, "w") for i, t in rows]
    return spark.createDataFrame(clash, "doc_id long, text string, lang string, source string, n_chars long, id long, "
                                        "node string, n string, kept boolean, h string, rid int, score double, words string")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
