"""Small frames with the awkward cases that every operator has to bear."""

import random

from tests.conftest import SF_SMALL

LONG = "lorem " * 4000 + "x" * 5000
TEXTS = [
    None, "", "   ", "\n\n", "one", "a b c", LONG, LONG + " end",
    "same text here with a few words", "same text here with a few words",
    "Ünïcödé tëxt 漢字 \U0001f600 and <|endoftext|> inside", "tabs\tand\r\nline ends \x0b\x0c x",
    "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17 18 19 20 21 22",
]


def awkward(spark, extra: str = "n int"):
    """(doc_id, text, plus a clashing extra column) with null and repeated ids."""
    rows = [(i, t, i) for i, t in enumerate(TEXTS)]
    rows += [(None, "same text here with a few words", 1), (None, None, None),
             (8, TEXTS[8], 8), (1000, "one", None)]
    return spark.createDataFrame(rows, f"doc_id long, text string, {extra}")


def empty(spark, extra: str = "n int"):
    return spark.createDataFrame([], f"doc_id long, text string, {extra}")


def documents(spark, n: int | None = None):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    return df if n is None else df.filter(f"doc_id < {n}")


def texts_of(df) -> dict:
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def words(rng: random.Random, vocab: int, n: int) -> str:
    return " ".join(f"w{rng.randrange(vocab)}" for _ in range(n))
