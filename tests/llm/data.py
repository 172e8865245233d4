"""Small tables with the cases that every operator has to take."""

from __future__ import annotations

AWKWARD = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank."), (2, None), (3, ""), (4, "   \n\t "), (5, "a"),
    (6, "The quick brown fox jumps over the lazy dog near the river bank."), (6, "The quick brown fox jumps over the lazy dog near the river bank."),
    (None, "no id here, mail me at a.b@c.org"), (8, "x" * 70_000), (9, "word " * 20_000), (10, "Größe ÅÉ 日本語 🙂 İ ſ ﬁ \x1c \x85 end"), (11, "1" * 5_000), (12, "@" * 300 + "+" * 300),
]


def documents(spark, rows=AWKWARD):
    """doc_id and text with extra columns whose names operators use themselves."""
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, hits string, spans string, n bigint"
    return spark.createDataFrame([(i, t, None if t is None else "en", "s", len(t or ""), "x", "y", "z", 1) for i, t in rows], schema)


def no_documents(spark):
    return documents(spark).filter("false")
