import random

import pytest

CLASHING = ["slot", "ids", "line", "key", "h", "fingerprint", "score", "tokens", "row", "lang_pred", "kept", "label", "x"]


def words(seed: int, n: int, pool: int = 400) -> str:
    pick = random.Random(seed)
    return " ".join("".join(pick.choice("abcdefghij") for _ in range(pick.randint(2, 8))) for _ in range(n)) if pool else ""


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and long texts, repeated rows, ties and a row without id."""
    return [
        (1, None),
        (2, ""),
        (3, " \n\t\x0b "),
        (4, "hello world"),
        (4, "hello world"),
        (5, "hello world"),
        (None, "no id but a text of some words"),
        (6, words(1, 30_000)),
        (7, "a" * 50_000),
        (8, "Ünïcödé 漢字 😀 text\r\nwith lines\n\nand more"),
        (9, "hello   world  \n hello   world"),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The odd rows with the columns of documents and others whose names operators use themselves."""
    extra = ", ".join(f"{name} string" for name in CLASHING)
    rows = [(i, t, "en", "s", len(t or ""), *["?"] * len(CLASHING)) for i, t in odd_rows]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {extra}")


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.filter("false")


@pytest.fixture(scope="session")
def corpus(spark, sf):
    return {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
