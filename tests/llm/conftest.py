import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"

#: Names that the operators use themselves, as extra columns of a documents table.
EXTRA = ["id", "score", "kept", "n", "digest", "holder", "fp", "start", "end", "length", "ids", "rank", "shard",
         "hashes", "batch", "lines", "removed_spans", "predicted", "held_out", "raw", "y", "words", "offset"]


def documents_frame(spark, rows, extra=()):
    """rows: (doc_id, text, lang, source)."""
    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()), *[T.StructField(c, T.StringType()) for c in extra],
    ])
    data = [(i, t, la, s, None if t is None else len(t), *[f"x{k}" for k in range(len(extra))]) for i, t, la, s in rows]
    return spark.createDataFrame(data, schema)


def odd_rows():
    line = "The cat sat on the mat with a hat and looked at the moon"
    long = " ".join(f"word{i % 977}" for i in range(60_000))
    return [
        (1, line, "en", "a"), (2, line, "en", "a"), (2, line, "en", "a"),  # a copy, and a repeated row
        (3, None, "en", None), (4, "", None, "b"), (4, "", None, "b"), (None, line, None, None),
        (None, None, None, None), (5, long, "en", "b"), (6, long + " tail", "fr", "b"),
        (7, "Zwölf Boxkämpfer jagen Viktor quer über den großen Sylter Deich 🙂 日本語", "de", "b"),
        (8, "\n\n \t\n", "de", "c"), (9, "!!! ??? 123 456", "fr", "c"), (10, "x", "fr", "c"),
        (11, "a\nb\nc\na\nb\nc\na", "fr", "c"), (12, "<|endoftext|> end <|endoftext|>", "en", "c"),
    ]


@pytest.fixture(scope="session")
def odd_docs(spark):
    return documents_frame(spark, odd_rows(), EXTRA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return documents_frame(spark, [], EXTRA)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, i % 2, 0) for i in range(1, 13)] + [(1, 1, 0), (None, 1, 1), (99, None, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
