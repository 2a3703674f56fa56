"""The document pipeline: quality filter, exact and near deduplication, mixing, encoding."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.llm import digest_index, mixing, pieces, quality, simhash
from starmill.llm.queries import labels, piece_model
from starmill.session import materialise

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_only(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality ranker rejects go. Every label is learned from; the fold that `op7_quality` holds out is that query's alone.

    Null text counts as empty; a row is judged by its text alone, so repeats share a fate. Without labels of both kinds all stay.
    """
    return quality.keep_good(docs, quality.learn(docs, labels(spark, sf_dir), F.lit(True)))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays.

    Null text equals empty text; a null doc_id is smaller than any other; of rows that tie in both one stays.
    """
    return digest_index.keep(docs, digest_index.new_index(spark))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked at 3 or fewer fingerprint bits, the one with the smallest doc_id stays.

    Texts without words have fingerprint zero and are linked like any other.
    """
    return simhash.keep(docs, words=3, radius=3)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document appears as often as it is drawn.

    A null source is one of its own. Texts without words have size 0. The columns are those of the input, whatever their names.
    """
    return mixing.mixed(docs, mixing.plan(docs)).select(*(f"`{c}`" for c in docs.columns))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded text, per row of the mix; null text counts as empty.

    Of an empty table every stage returns an empty one.
    """
    return pieces.digests(docs, piece_model())


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_only),
    ("exact dedup", exact_dedup),
    ("simhash near-dedup", near_dedup),
    ("mixing", mix),
    ("sentencepiece", encode),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage on what the one before it kept, written and read again in between."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
