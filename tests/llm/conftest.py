from __future__ import annotations

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars int, row string, size long, key string, fp long, gone string"


@pytest.fixture
def docs(spark):
    """Documents from (id, text) pairs, with extra columns whose names operators use inside."""

    def make(*pairs):
        rows = [(i, t, "en", "s", len(t or ""), "r", 1, "k", 2, "g") for i, t in pairs]
        return spark.createDataFrame(rows, DOCS)

    return make


@pytest.fixture
def edge_rows():
    """Nulls, empty and blank texts, a long text, ties, repeated rows and a null id."""
    rnd = random.Random(4)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(1, 7))) for _ in range(400)]
    text = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    base = text(120)
    rows = [(1, None), (2, ""), (3, "  \n\t "), (4, base), (5, base), (5, base), (6, base + " tail"), (None, base), (None, None)]
    rows += [(7, "\n".join(text(60) for _ in range(150))), (8, "Ünïcode ÀÉ <|endoftext|> 5 x"), (9, "one"), (10, "two words")]
    return rows + [(20 + k, text(rnd.randint(1, 300))) for k in range(30)]


def random_words(rnd, vocabulary, n):
    return " ".join(rnd.choice(vocabulary) for _ in range(n))
