"""Profiles from stored statistics: one row per partition and column, made once.

Counts, bounds and sketches of partitions can be merged, so the profile of a table after a
new partition reads that partition and the small table of statistics, and nothing else.
"""

from __future__ import annotations

import time
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from mailtally.operators.latest import comparable
from mailtally.operators.profile import SKETCH_BITS
from mailtally.operators.upsert import among

#: Items of a quantile sketch; its error of rank is about 1.7 / k ** 0.9, here 0.7 %.
QUANTILE_K = 400


def partition_statistics(
    df: DataFrame, by: Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """Per partition ``by`` and column: rows, nulls, bounds, distinct and quantile sketches.

    One aggregate that combines before its shuffle. Bounds and quantiles are of numeric columns.
    """
    columns = [c for c in df.columns if c not in by] if columns is None else list(columns)
    aggs: list[Column] = [F.count(F.lit(1)).alias("_n")]
    rows = []
    for i, c in enumerate(columns):
        col, numeric = F.col(f"`{c}`"), isinstance(df.schema[c].dataType, T.NumericType)
        hashed = F.when(col.isNotNull(), F.xxhash64(comparable(df, c)))
        value = col.cast("double") if numeric else F.lit(None).cast("double")
        aggs += [
            F.count_if(col.isNull()).alias(f"nulls_{i}"),
            F.hll_sketch_agg(hashed, F.lit(SKETCH_BITS)).alias(f"distinct_{i}"),
            F.min(value).alias(f"min_{i}"),
            F.max(value).alias(f"max_{i}"),
        ]
        if numeric:
            aggs.append(F.kll_sketch_agg_double(value, F.lit(QUANTILE_K)).alias(f"values_{i}"))
        rows.append(
            F.struct(
                F.lit(c).alias("column"),
                F.col("_n").alias("total_rows"),
                F.col(f"nulls_{i}").alias("null_count"),
                F.col(f"min_{i}").alias("min_value"),
                F.col(f"max_{i}").alias("max_value"),
                F.col(f"distinct_{i}").alias("distinct_sketch"),
                (F.col(f"values_{i}") if numeric else F.lit(None).cast("binary")).alias("value_sketch"),
            )
        )
    return df.groupBy(*by).agg(*aggs).select(*by, F.inline(F.array(*rows)))


def profile_from(stats: DataFrame) -> DataFrame:
    """The profile of all partitions: rows, nulls, bounds, approximate distinct count and median."""
    median = F.kll_sketch_get_quantile_double("values", F.lit(0.5))
    return (
        stats.groupBy("column")
        .agg(
            F.sum("total_rows").alias("total_rows"),
            F.sum("null_count").alias("null_count"),
            F.min("min_value").alias("min_value"),
            F.max("max_value").alias("max_value"),
            F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("distinct_count"),
            F.kll_merge_agg_double("value_sketch", F.lit(QUANTILE_K)).alias("values"),
        )
        .withColumn("median_value", F.when(F.col("min_value").isNotNull(), median))
        .drop("values")
    )


def stored_statistics(spark: SparkSession, path: str, by: Sequence[str]) -> DataFrame | None:
    """The newest statistics of every partition and column, None if there are none yet."""
    try:
        stats = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    newest = F.max("made").over(Window.partitionBy(*by))
    return stats.withColumn("_newest", newest).where("made = _newest").drop("made", "_newest")


def refresh_statistics(
    table: DataFrame,
    by: Sequence[str],
    path: str,
    columns: Sequence[str] | None = None,
    again: Iterable[tuple] = (),
) -> DataFrame:
    """Add the statistics of partitions that have none, and of those named by ``again``.

    ``by`` are the table's partition columns; the others are pruned by literals. The number
    of partitions bounds what the driver holds, as in the catalog itself.
    """
    spark = table.sparkSession
    stats = stored_statistics(spark, path, by)
    if stats is not None:
        done = {tuple(r) for r in stats.select(*by).distinct().collect()} - set(again)
        if done:
            table = table.where(~F.coalesce(among(by, sorted(done, key=str)), F.lit(False)))
    made = F.lit(time.time_ns())
    partition_statistics(table, by, columns).withColumn("made", made).write.mode("append").parquet(path)
    return stored_statistics(spark, path, by)
