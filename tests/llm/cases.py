"""Rows that every operator must stand."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LONG = " ".join(f"word{i % 977} and line{i}" for i in range(20_000))
PASSAGE = " ".join(f"shared{i}" for i in range(60))

DOCUMENTS = [
    (1, "Plain words of a first text that goes on for a while. " * 3, "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, "a"),
    (4, " \t\n \x0b ", "de", None),
    (5, LONG, "en", "b"),
    (6, f"before {PASSAGE} after", "en", "b"),
    (7, f"other {PASSAGE} words", "en", "b"),
    (7, f"other {PASSAGE} words", "en", "b"),
    (8, "Same id, one text.", "fr", "b"),
    (8, "Same id, another text with ▁ and \U0001f600 and é.", "fr", "b"),
    (None, "No id but words, quite a few of them, here and there.", None, None),
    (None, None, None, None),
    (9, "a", "en", "a"),
    (10, "*** ### $$$ " * 50, "en", "a"),
]
SCHEMA = "doc_id long, text string, lang string, source string"
#: Names that clash with what operators might use inside.
CLASHES = ("_id", "_row", "_text", "_s", "_gone", "_leak", "_group", "kept", "fp", "keys", "n_chars",
           "n_words", "text_hash", "_host", "size", "window", "_cut_id", "_gone_id", "hits", "item")


def documents(spark: SparkSession, rows=None) -> DataFrame:
    made = spark.createDataFrame(DOCUMENTS if rows is None else rows, SCHEMA)
    return made.selectExpr("*", *[f"'x' as `{name}`" for name in CLASHES])
