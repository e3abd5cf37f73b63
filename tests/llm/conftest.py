import random

import pytest

SYLLABLES = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve".split()


@pytest.fixture(scope="session")
def make_text():
    def make(seed: int, words: int) -> str:
        r = random.Random(seed)
        return " ".join("".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 4))) for _ in range(words))

    return make


@pytest.fixture(scope="session")
def odd_docs(spark, make_text):
    """Documents with nulls in every column, empty and long texts, ties, repeated rows and columns whose names clash."""
    long = make_text(5, 30_000)
    rows = [
        (1, make_text(1, 60), "en", 7, "a"), (1, make_text(1, 60), "en", 7, "a"), (2, None, None, None, None), (3, "", "en", 0, "b"), (4, "  \n\t ", "de", 4, "c"),
        (None, make_text(2, 40), "en", 1, "d"), (None, None, None, None, None), (5, long, "fr", len(long), "e"), (6, make_text(1, 60), "en", 7, "f"), (7, "word", "en", 4, "g"),
        (8, "ünïcødé ß 日本語 😀 <|endoftext|> end", "es", 9, "h"), (9, long + " x", "fr", 3, "i"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, h int, words string")
