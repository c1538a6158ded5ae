import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use themselves
        T.StructField("digest", T.StringType()),
        T.StructField("row_key", T.StringType()),
        T.StructField("score", T.DoubleType()),
    ]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text, lang) tuples, with further columns of clashing names."""

    def make(rows, parts=3):
        full = [
            (i, text, lang, "s1" if i else None, len(text) if text else None, "x", "y", 0.0)
            for i, text, lang in rows
        ]
        return spark.createDataFrame(full, SCHEMA).repartition(parts)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, ties and repeated rows."""
    long = " ".join(f"word{i % 977} stands{i % 13}" for i in range(30_000))
    return [
        (1, None, "en"),
        (2, "", None),
        (None, "no id here at all, but some words", "en"),
        (None, None, None),
        (3, long, "en"),
        (4, long, "en"),
        (5, "the same text", "en"),
        (5, "the same text", "en"),
        (6, "the  same\ttext", "de"),
        (7, "12 34 !!", None),
        (8, "x", "fr"),
        (9, "\n \t ", "fr"),
        (10, "Ünïcödé 中文 text \U0001f600 here", "de"),
    ]
