import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty, blank and long texts, ties, whole repeats, clashing extra columns."""
    long = " ".join(f"word{i % 977}x{i}" for i in range(20_000))
    rows = [
        (1, "One small text of seven plain words.", "en", "a", 36),
        (1, "One small text of seven plain words.", "en", "a", 36),
        (2, "One small text of seven plain words.", "en", "a", 36),
        (2, "Another text under the same number.", "en", "b", 35),
        (3, None, None, None, None),
        (4, "", "de", "a", 0),
        (5, " \n\t ", "fr", None, 4),
        (6, long, "en", "b", len(long)),
        (7, "x" * 50_000, "en", "b", 50_000),
        (8, "\x00 é ﬁ 日本 😀 ▁ <s> tail", None, "c", 20),
        (None, "A text without a number.", "en", "c", 24),
        (None, "A text without a number.", "en", "c", 24),
        (None, None, None, None, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    clash = ("size", "row", "digest", "fp", "score", "kept", "block", "key", "ids", "root", "shard", "copies", "target")
    return docs.withColumns({c: F.lit(c) for c in clash})


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)
