"""Small helpers that the operators share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailtally.session import shared_dir

#: ASCII white space, as the contracts write it.
WORDS = r"[^\x20\x09-\x0D]+"
FOLDS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id's text leaves no remainder; a null id is not held out."""
    rest = F.crc32(doc_id.cast("string").cast("binary")) % F.lit(FOLDS)
    return F.coalesce(rest == 0, F.lit(False))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: lost executors then cost a reread only."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/mailtally-llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, target: str, per_class: int, seed: int = 7
) -> DataFrame:
    """At most ``per_class`` training rows of either class, as (doc_id, text, label).

    Rows come in the order of a seeded hash of their id. Only rows outside of the held-out
    fold with label 0 or 1 count; an id labelled twice takes its larger label. The ids of
    the sample are bounded by ``2 * per_class``, so the join is a broadcast. Of the rows that
    share an id, the one with the least text is in the sample.
    """
    ids = (
        labels.select("doc_id", F.col(target).cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    order = F.xxhash64(F.lit(seed), F.col("doc_id"))
    picked = [
        ids.where(F.col("label") == c).orderBy(order, "doc_id").limit(per_class) for c in (0, 1)
    ]
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(
        F.broadcast(picked[0].union(picked[1])), "doc_id"
    )
    return found.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label"))
