"""Small tables for the edge cases that every operator has to take."""

from __future__ import annotations

from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

LONG = " ".join(f"word{i % 977} of line{i % 53}" for i in range(60_000))

EDGE_ROWS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away from here.", "en", "a", 1),
    (1, "The quick brown fox jumps over the lazy dog and runs away from here.", "en", "a", 1),  # repeated row
    (2, "The quick brown fox jumps over the lazy dog and runs away from here.", "en", "a", 1),  # tie: equal text
    (3, None, None, None, None),
    (4, "", "", "", 0),
    (5, "   \n\t ", "en", "b", 6),
    (None, "Ein Text ohne Kennung mit vielen kleinen Wörtern und Sätzen.", "de", None, 3),
    (6, "x", "en", "b", 1),
    (7, LONG, "en", "b", len(LONG)),
    (8, "12345 !!! ???", None, "c", 4),
    (9, "a" * 200_000, "en", "c", 200_000),
    (10, "été à la plage, ça va très bien merci beaucoup mes amis", "fr", "é", 10),
]

#: Names that the operators use inside.
CLASHES = ("fp", "root", "score", "u", "v", "at", "row", "held_out", "position", "size", "text_hash", "key", "hits", "id", "_hash", "r", "n")


def edge_docs(spark):
    return spark.createDataFrame(EDGE_ROWS, DOCS)


def clashing(df):
    return df.withColumns({c: F.lit("clash") for c in CLASHES if c not in df.columns})


def empty(df):
    return df.limit(0)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
