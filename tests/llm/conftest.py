import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])

LONG = " ".join(f"word{i % 977} and{i % 31}," for i in range(60_000))

# Null and empty texts, blanks of every kind, control strings, other scripts, one very long text, ties.
TEXTS = [
    "The first document is plain, and short.", None, "", " ", "\n", "  two  blanks \n\n and lines\t tab ", "a", "don't we'll I'm",
    "<|endoftext|> inside <|startoftext|> a text", "naïve café Straße ÆØÅ ñandú œuvre", "日本語のテキスト と 漢字", "emoji 😀 and nbsp",
    "x" * 5000, "1234567890 12 3.14 50%", "line one\nline two\nline three", LONG, "The first document is plain, and short.",
    "The first document is plain, and short.", "​zero width﻿", "tab\tsep\tvalues\r\nwindows", "ends with space ", " led by space",
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with every awkward case; ids unordered, one row repeated whole, a null source and language."""
    rows = [(7 * i % 101 + 1, t, None if i % 5 == 0 else "en" if i % 2 else "fr", None if i % 7 == 3 else f"s{i % 3}", len(t or ""))
            for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}
