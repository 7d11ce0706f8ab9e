"""Rows that the operators must all bear, and small helpers."""

import hashlib

SCHEMA = "doc_id long, text string"

# Nulls in every column, empty and blank texts, ties, repeated rows, a long text.
ODD_ROWS = [
    (1, "alpha beta gamma delta epsilon zeta eta"),
    (2, None),
    (3, ""),
    (4, " \t\n "),
    (5, "alpha  beta\tgamma delta epsilon zeta eta"),
    (5, "alpha  beta\tgamma delta epsilon zeta eta"),
    (None, "alpha beta gamma delta epsilon zeta eta"),
    (None, None),
    (6, "one two"),
    (7, "ONE Two"),
    (8, "long " * 40_000 + "end"),
    (9, "x" * 120_000),
    (10, "été ÉTÉ 日本語 🎉 \x00 <|endoftext|> ▁"),
]


def clashing(docs):
    """The documents with further columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    names = ("id", "sha", "kept", "keep_id", "mark", "words", "n", "digest", "root", "at", "payload", "held", "__id",
             "word", "__bad", "__bad_mark", "bad", "row", "score", "probability_toxic", "rejected", "group_size", "a.b")
    return docs.select("*", *[F.lit("other").alias(n) for n in names])


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
