"""Small tables with every awkward case that the operators define a result for."""

import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # names that operators use inside
    "id long, key long, `print` long, node long, n long, size long, score double, ids binary, bucket int"
)
WORDS = "the of and weather river stone house children morning letters number water paper market".split()


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + draw.choice(["", "s", "ly", "ing", str(draw.randint(0, 9))]) for _ in range(words))


def edge_rows() -> list[tuple]:
    base = prose(1, 150)
    shared = prose(2, 90)
    texts = [
        base,
        base,
        base.replace("river", "rivers", 1),
        base.upper(),
        None,
        "",
        "   \t\n ",
        "one two",
        "One  two",
        "one two three four",
        "é" * 500,
        "x" * 3000,
        "ab " * 400,
        prose(3, 40) + " " + shared + " " + prose(4, 30),
        prose(5, 60) + " " + shared + " " + prose(6, 10),
        prose(7, 9000),
        "日本語 текст ελληνικά " * 30,
        prose(8, 60),
        "12 345 !!",
    ]
    rows = [(i, t, ["en", "fr", None][i % 3], ["a", "b", None][i % 3], None if t is None else len(t)) for i, t in enumerate(texts)]
    rows.append(rows[7])  # a repeated row
    rows.append((None, "a text without an id but with words", "en", "a", None))
    rows.append((2000, base, "en", "hot", 7))
    rows += [(3000 + i, base, "en", "hot", len(base)) for i in range(12)]  # a group of copies
    return [(*row, 1, 2, 3, 4, 5, 6, 0.5, b"x", 7) for row in rows]


@pytest.fixture(scope="session")
def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
