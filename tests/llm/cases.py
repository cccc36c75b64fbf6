"""Small tables with everything that may go wrong in a text column."""

from __future__ import annotations

LONG = "alpha beta gamma delta " * 9000 + "z" * 40_000
TEXTS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "Two words"), (6, "same text here"), (7, "same text here"),
    (8, "SAME text here"), (9, "same text here"), (9, "same text here"), (None, "no id"), (None, None), (None, "no id"),
    (10, LONG), (11, LONG + "!"), (12, "naïve café 中文 😀 \x00 ▁▁ x"), (13, "a  b   c "), (14, "<|endoftext|> </s>"),
    (15, "All rights reserved. CC BY, all   rights\nRESERVED"), (16, "ab " * 700),
]
CLASHING = "h int, kept string, recipe int, code int, node int, row int, component_id int, item int, score int, again int, size int"


def documents(spark, rows=TEXTS):
    """doc_id, text, and columns whose names the operators use inside."""
    names = [c.split()[0] for c in CLASHING.split(", ")]
    values = [(i, t, *["7" if n == "kept" else 7 for n in names]) for i, t in rows]
    return spark.createDataFrame(values, f"doc_id long, text string, {CLASHING}").repartition(3)


def nothing(spark):
    return documents(spark, [])


def pairs(frame, *columns):
    """Rows as a sorted list of tuples; nulls first."""
    key = lambda row: tuple((v is not None, v) for v in row)
    return sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=key)
