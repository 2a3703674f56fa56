"""The operators applied to the given tables, one query each, and SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.llm import (
    alignment,
    digest_index,
    fingerprints,
    language,
    licenses,
    mixing,
    pieces,
    pii,
    quality,
    sharding,
    simhash,
    toxicity,
    whitening,
)
from starmill.llm.common import held_out

Query = Callable[[SparkSession, str], DataFrame]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def _predicted(scored: DataFrame, modulus: int, remainder: int, cut: float, *more: str) -> DataFrame:
    """doc_id, whether its label was held out, score, and the label at the cut."""
    out = held_out("doc_id", modulus, remainder).alias("held_out")
    return scored.select("doc_id", out, "score", (F.col("score") >= cut).cast("int").alias("predicted"), *more)


def model_file(name: str, path: str | None = None) -> bytes:
    """Content of a model file; by default that of this name among the installed public tokenizers."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(name)
    return Path(path).read_bytes()


def piece_model(path: str | None = None) -> bytes:
    return model_file("piece_bpe_32k.model", path)


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(documents(spark, sf_dir), piece_model())


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.with_neighbours(documents(spark, sf_dir))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(documents(spark, sf_dir))
    counts = [f"n_{kind}" for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2("base", 256).alias("base_sha256"), "spans")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided = digest_index.decide(documents(spark, sf_dir), digest_index.new_index(spark))
    return decided.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from labels whose crc32 of the doc_id does not leave 2 when divided by 4."""
    docs = documents(spark, sf_dir)
    field = toxicity.learn(docs, labels(spark, sf_dir), ~held_out("doc_id", 4, 2))
    tagged = toxicity.tag(docs, field)
    offsets = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return _predicted(tagged.withColumn("offsets", offsets), 4, 2, toxicity.CUT, "offsets")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", simhash.hex16().alias("fingerprint"), "component_id")


def quality_ranker(docs: DataFrame, labelled: DataFrame) -> quality.Ranker | None:
    """Learned from labels whose crc32 of the doc_id does not divide by 5."""
    return quality.learn(docs, labelled, ~held_out("doc_id", 5, 0))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return _predicted(quality.scores(docs, quality_ranker(docs, labels(spark, sf_dir))), 5, 0, quality.CUT)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.taken(mixing.plan(documents(spark, sf_dir)))
    words = (F.col("size") * F.col("copies")).alias("taken")
    return rows.select("doc_id", "size", "source_size", "target", words)


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its confirmed families, the paragraphs with them, and how many windows stayed unconfirmed."""
    docs = documents(spark, sf_dir)
    found = licenses.scan(docs, licenses.learn(docs))
    sure = F.filter("matches", lambda m: m["confirmed"])
    return found.select(
        "doc_id",
        F.array_join(F.array_sort(F.array_distinct(F.transform(sure, lambda m: m["family"]))), ",").alias("families"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(sure, lambda m: m["paragraph"]))).cast("array<string>"), ",").alias("paragraphs"),
        F.size(F.filter("matches", lambda m: ~m["confirmed"])).cast("long").alias("n_unconfirmed"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["probability"])), F.lit(0.0)).alias("score"),
    )


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from documents whose crc32 of the doc_id does not leave 1 when divided by 3."""
    docs = documents(spark, sf_dir)
    model = language.learn(docs, ~held_out("doc_id", 3, 1))
    return language.predict(docs, model).select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "lang_pred", "score")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.scored(documents(spark, sf_dir), model_file("byte_bpe_50k.json"), piece_model())


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """24 shards of near equal bytes; by this law one more shard would move every cut."""
    rows = sharding.shard(documents(spark, sf_dir), 24)
    crc = F.crc32(F.coalesce(F.col("row.text"), F.lit(""))).alias("text_crc32")
    law = F.lit("bytes").alias("law")
    return rows.select("row.doc_id", "size", crc, law, "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per vector and component. A deviation beyond 64 bits, as of some ten million vectors, is null."""
    found = whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("place", "of")
    long = found.select("vec_id", "n", F.expr("try_cast(deviation AS bigint)").alias("deviation"), "identity_error", each)
    component = (F.col("place") + 1).alias("component")
    return long.select("vec_id", component, "n", "deviation", "of.whitened", "of.explained", "identity_error")


QUERIES: dict[str, Query] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_fingerprints": op2_fingerprints,
    "op3_pii": op3_pii,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_toxicity": op5_toxicity,
    "op6_simhash": op6_simhash,
    "op7_quality": op7_quality,
    "op8_mixing": op8_mixing,
    "op9_licenses": op9_licenses,
    "op10_language": op10_language,
    "op11_alignment": op11_alignment,
    "op12_sharding": op12_sharding,
    "op13_whitening": op13_whitening,
}

ORACLE: dict[str, str] = {
    "op4_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
}
