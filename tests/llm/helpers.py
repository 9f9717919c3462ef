"""Small tables with awkward rows."""

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])

LONG = " ".join(f"word{k % 977}x{k % 31}" for k in range(60_000))


def documents(spark, texts, lang="en", source="a"):
    """Documents of a list of texts or of ``(doc_id, text)``."""
    rows = [t if isinstance(t, tuple) else (k, t) for k, t in enumerate(texts)]
    return spark.createDataFrame([(i, t, lang, source, None if t is None else len(t)) for i, t in rows], DOCS)


def awkward(spark):
    """Nulls in every column, blank and very long texts, repeats, and columns of clashing names."""
    rows = [
        (1, "one two three four five six", "en", "a", 27), (2, None, "en", "a", None), (3, "", None, "b", 0), (4, " \t\n ", "fr", None, 4),
        (5, LONG, "en", "a", len(LONG)), (6, LONG, "en", "a", len(LONG)), (7, "one two three four five six", None, None, None), (7, "one two three four five six", None, None, None),
        (None, "sans identité", "fr", "b", 13), (8, "é", "fr", "b", 1), (9, "12 34 !!", "en", "b", 8), (10, "<|endoftext|> \x01 ok", "en", "a", 18),
    ]
    df = spark.createDataFrame(rows, DOCS)
    extra = "row _near_row key fp size shard place position label score component node rank word words hits lang_pred bytes".split()
    return df.selectExpr("*", *[f"'x' AS `{c}`" for c in extra])
