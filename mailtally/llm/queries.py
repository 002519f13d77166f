"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailtally.llm import (
    embedding_dedup,
    licenses,
    lz_fingerprint,
    merkle,
    mixing,
    packing,
    quality,
    resampling,
    simhash,
    substring_dedup,
    suffix_dedup,
    toxicity,
    url_filter,
)
from mailtally.llm.common import held_out, table
from mailtally.llm.oracles import ORACLES  # noqa: F401


def word_tokenizer() -> str:
    """Path of the word-level vocabulary, installed beside the libraries on every machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _scored(docs: DataFrame, score, cut: float) -> DataFrame:
    return docs.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), score(F.col("text")).alias("score")
    ).withColumn("predicted", (F.col("score") >= cut).cast("int"))


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("begins").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return _scored(docs, lambda text: quality.quality_score(model, text), 0.3)


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), word_tokenizer())


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return _scored(docs, lambda text: toxicity.toxicity_score(model, text), 0.5)


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op9_lz_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lz_fingerprint.fingerprint(table(spark, sf_dir, "documents"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return resampling.resample(docs, target)


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), url_filter.RULES).drop("score")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    small = F.translate("text", ascii_uppercase, ascii_lowercase)
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        merkle.digest(*fields, F.col("text")).alias("leaf"),
        F.when(changed, merkle.digest(*fields, small)).alias("tampered"),
    )
    manifest = merkle.build(rows)
    root = F.lit(manifest.root)
    folded = merkle.fold(F.coalesce("tampered", "leaf"), F.col("path"))
    return merkle.prove(manifest).select(
        "doc_id",
        "leaf",
        "subroot",
        root.alias("root"),
        merkle.proof_digest(F.col("path")).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == root)


QUERIES = {
    f.__name__: f
    for f in (
        op1_suffix_dedup,
        op2_quality,
        op3_embedding_dedup,
        op4_packing,
        op5_mixing,
        op6_toxicity,
        op7_licenses,
        op8_simhash,
        op9_lz_fingerprint,
        op10_substring_dedup,
        op11_resampling,
        op12_url_filter,
        op13_merkle_manifest,
    )
}
