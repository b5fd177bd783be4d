"""Tables with the cases that every operator has to bear."""

from pyspark.sql import types as T

#: Extra columns bear names that the operators use inside.
DOCUMENTS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType())]
    + [T.StructField(c, T.StringType()) for c in ("id", "mark", "fp", "score", "tokens", "p", "sha", "norm", "row", "host", "path", "node", "n")]
)

TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog again and again"),
    (2, "The quick brown fox jumps over  the lazy dog again and again"),
    (2, "The quick brown fox jumps over  the lazy dog again and again"),
    (3, ""),
    (4, None),
    (5, " \t\n"),
    (None, "a row without an id"),
    (7, "▁ ▁ é漢\U0001f600\x00 " * 3),
    (8, "word " * 30_000),
    (9, "x" * 50_000),
    (10, "The quick brown fox jumps over the lazy dog again and again"),
]


def documents(spark, texts=TEXTS, lang="en"):
    """Documents with nulls, empty and long texts, repeated rows, ties, and clashing extra columns."""
    return spark.createDataFrame([(i, t, lang, *["x"] * 13) for i, t in texts], DOCUMENTS)
