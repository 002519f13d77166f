"""From raw documents to packed sequences: five stages over all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a frame; all but the last give back the
columns of ``documents``. ``run`` writes each result to the shared folder and reads it again.

Defined cases, beside those of the operators: rows that repeat an id or have none are
documents of their own in near-duplicates, of which one row of each group stays; in mixing a
document is a row's id, text, language and source, so rows that share an id or have none
are taken each for itself; documents that substring dedup empties go on as empty ones until
mixing, which takes nothing from them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailtally.llm import mixing, packing, quality, shingle_sets, substring_dedup
from mailtally.llm.common import stage, table
from mailtally.llm.queries import word_tokenizer

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
QUALITY_CUT = 0.3
RADIUS = 4

#: No stage after the first can be written in SQL: models, fingerprints, knapsacks.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores at ``QUALITY_CUT`` or above."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality.quality_score(model, F.col("text")) >= QUALITY_CUT).select(COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles: similarity 0.8 or more, or SimHash
    fingerprints at most ``RADIUS`` bits apart), one row: the one with the smallest id."""
    return shingle_sets.first_rows(docs.select(COLUMNS), radius=RADIUS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that stand earlier in the corpus."""
    rest = substring_dedup.remove_repeats(docs, own_space=True, carry=("lang", "source"))
    return rest.select(
        "doc_id",
        F.col("kept").alias("text"),
        "lang",
        "source",
        F.length("kept").cast("long").alias("n_chars"),
    )


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    own = F.xxhash64("doc_id", "text", "lang", "source")
    times = (
        mixing.mix(docs.withColumn("doc_id", own))
        .where("taken > 0")
        .groupBy(F.col("doc_id").alias("mixed"))
        .agg(F.max((F.col("taken") / F.col("size")).cast("int")).alias("times"))
    )
    return (
        docs.select(*COLUMNS, own.alias("own"))
        .join(times, F.col("own") == F.col("mixed"))
        .select(*COLUMNS, F.explode(F.array_repeat(F.lit(True), F.col("times"))))
        .select(COLUMNS)
    )


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their places in sequences."""
    return packing.pack(docs, word_tokenizer())


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
