from __future__ import annotations

import random

import pytest

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, kept string, "
    "n_tokens string, key string, n string, shard string, word string, c string, _row string, _made string, "
    "held_out string, block string, label string, a string, b string, id string"
)
EXTRA = len(SCHEMA.split(",")) - 5


def sentence(draw: random.Random, n: int, syllables: list[str]) -> str:
    return " ".join("".join(draw.choices(syllables, k=draw.randint(1, 3))) for _ in range(n))


ENGLISH = ["the", "ing", "tion", "ou", "ly", "wh", "sh", "and"]
GERMAN = ["sch", "ung", "ein", "keit", "ü", "ä", "ver", "der"]


def awkward_rows() -> list[tuple]:
    """Texts that are null, empty, blank, without letters, long, repeated, or nearly equal; ids
    that are null or repeated; languages that are null; columns whose names operators use."""
    draw = random.Random(1)
    texts = [None, "", "   \n", "1 2 3 ... !!!", "é", "a", "one two three"]
    texts += [sentence(draw, 60, ENGLISH) for _ in range(12)]
    texts += [sentence(draw, 60, GERMAN) for _ in range(12)]
    base = sentence(draw, 80, ENGLISH)
    texts += [base, base, base.upper(), base + " tail", "head " + base]
    texts += [sentence(draw, 6000, ENGLISH), "x" * 9000, "word " * 3000]
    rows = []
    for number, text in enumerate(texts):
        lang = None if number % 9 == 4 else "de" if text and "sch" in text.lower() else "en"
        rows.append((number, text, lang, None, None))
    rows += [rows[10], rows[10], (None, texts[8], "en", "s", 1), (None, None, None, None, None)]
    return [row + ("?",) * EXTRA for row in rows]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
