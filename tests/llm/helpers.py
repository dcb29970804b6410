"""What the tests of the operators share."""

from __future__ import annotations

SF = "/root/testdata/sf0.001"

#: Null, empty, blank, very short, long, repeated and odd texts.
TEXTS = [
    None,
    "",
    " \t\n",
    "One",
    "the quick brown fox jumps over the lazy dog " * 3,
    "the quick brown fox jumps over the lazy dog " * 3,
    "Ünïcödé Straße ΑΣΣ 東京   x\x1cy 😀 <|endoftext|> end",
    "word " * 60_000,
    "x" * 50_000,
]


def documents(spark, texts=TEXTS, extra=True):
    """Documents with a repeated row, a null id and columns named like those of the operators' own results."""
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "One"), (None, "no id")]
    frame = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    if extra:
        frame = frame.selectExpr("*", *(f"'mine' AS {c}" for c in ("id", "score", "fp", "n", "key", "label", "spans", "ids", "_salt", "lang")))
    return frame


def empty(spark):
    return spark.createDataFrame([], "doc_id LONG, text STRING")


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)
