"""Table profiles in one pass: one aggregate, then a reshape of its single row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from mailtally.operators.latest import comparable

# --- fixed value: relative error of the distinct counts ---
DISTINCT_RSD = 0.01
# --- end of fixed values ---

# Sketch size for that error: 1.04 / sqrt(2**14) is 0.8 %.
SKETCH_BITS = 14


def _nulls(col: str) -> Column:
    return F.count_if(F.col(col).isNull())


def approx_distinct(col: str, hashed: Column | None = None) -> Column:
    """Approximate distinct count within DISTINCT_RSD, nulls left out.

    A sketch of the value's 64-bit hash: one binary buffer per column and any type. The
    built-in approximate count keeps its registers as 1,639 columns at this error, which
    makes the plan of a wide table slow to compile.
    """
    hashed = F.col(col) if hashed is None else hashed  # a form of the column that has a hash
    value = F.when(F.col(col).isNotNull(), F.xxhash64(hashed))
    return F.hll_sketch_estimate(F.hll_sketch_agg(value, F.lit(SKETCH_BITS)))


def _unnest(stats: DataFrame, rows: list[Column]) -> DataFrame:
    """One output row per struct of the single statistics row."""
    return stats.select(F.inline(F.array(*rows)))


def profile(df: DataFrame, distinct: bool = True) -> DataFrame:
    """Per column: rows, nulls, null percent, approximate distinct count, skewness."""
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(df.columns):
        aggs.append(_nulls(c).alias(f"nulls_{i}"))
        if distinct:
            aggs.append(approx_distinct(c, comparable(df, c)).alias(f"distinct_{i}"))
        if c in numeric:
            aggs.append(F.skewness(c).alias(f"skew_{i}"))
    rows = []
    for i, c in enumerate(df.columns):
        nulls = F.col(f"nulls_{i}")
        skew = F.round(f"skew_{i}", 4) if c in numeric else F.lit(None).cast("double")
        items = [
            F.lit(c).alias("column"),
            F.col("n").alias("total_rows"),
            nulls.alias("null_count"),
            F.when(F.col("n") > 0, F.round(nulls / F.col("n") * 100, 2)).alias("null_pct"),
        ]
        if distinct:
            items.append(F.col(f"distinct_{i}").alias("distinct_count"))
        items += [skew.alias("skewness"), F.lit(c in numeric).alias("is_numeric")]
        rows.append(F.struct(*items))
    return _unnest(df.agg(*aggs), rows)


def null_profile(df: DataFrame) -> DataFrame:
    """Per column: share of nulls from 0 to 1; 0 for an empty table."""
    rates = [
        F.coalesce(F.avg(F.when(F.col(c).isNull(), 1.0).otherwise(0.0)), F.lit(0.0)).alias(f"r_{i}")
        for i, c in enumerate(df.columns)
    ]
    return _unnest(
        df.agg(*rates),
        [
            F.struct(F.lit(c).alias("column"), F.col(f"r_{i}").alias("null_pct"))
            for i, c in enumerate(df.columns)
        ],
    )


def numeric_profile(df: DataFrame, cols: Sequence[str], kind: str | None = None) -> DataFrame:
    """Per KPI column: min, max, avg, sum.

    Values are profiled as they are, or cast to ``kind``. Sums of whole numbers and decimals
    are exact, with the largest scale among the columns (six digits next to floating ones).
    """
    typed = df.select(*[(F.col(c).cast(kind) if kind else F.col(c)).alias(c) for c in cols])
    scales = [
        6 if isinstance(f.dataType, (T.FloatType, T.DoubleType)) else getattr(f.dataType, "scale", 0)
        for f in typed.schema.fields
    ]
    total = f"decimal(38,{max(scales, default=0)})"
    df = typed
    aggs = []
    for i, c in enumerate(cols):
        value = F.col(c)
        aggs += [
            F.min(value).cast("double").alias(f"min_{i}"),
            F.max(value).cast("double").alias(f"max_{i}"),
            F.avg(value).cast("double").alias(f"avg_{i}"),
            F.sum(value).cast(total).alias(f"sum_{i}"),
        ]
    return _unnest(
        df.agg(*aggs),
        [
            F.struct(
                F.lit(c).alias("column"),
                *[F.col(f"{s}_{i}").alias(f"{s}_value") for s in ("min", "max", "avg", "sum")],
            )
            for i, c in enumerate(cols)
        ],
    )


def grain_check(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Do the keys identify rows? Groups, duplicate groups and rows, null keys. One row."""
    any_null = F.lit(False)
    for key in keys:
        any_null = any_null | F.col(key).isNull()
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("key_groups"),
        F.count_if(F.col("_n") > 1).alias("duplicate_groups"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"),
        F.coalesce(F.max("_n"), F.lit(0)).alias("largest_group"),
        F.coalesce(F.sum(F.when(any_null, F.col("_n")).otherwise(0)), F.lit(0)).alias("null_key_rows"),
    ).withColumn("is_unique", F.col("duplicate_groups") == 0)


def grain_candidates(df: DataFrame, candidates: Sequence[Sequence[str]]) -> DataFrame:
    """Rank key sets by the share of rows they tell apart; 1.0 means unique.

    Each candidate is a two-step aggregate that combines before its shuffle; several
    distinct counts in one aggregate would copy every row once per candidate.
    """
    result = None
    for keys in candidates:
        groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        row = groups.agg(
            F.lit(", ".join(keys)).alias("key_set"),
            F.lit(len(keys)).alias("key_count"),
            F.count(F.lit(1)).alias("distinct_keys"),
            F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
        )
        result = row if result is None else result.unionByName(row)
    if result is None:
        raise ValueError("no candidate key sets")
    return result.withColumn(
        "distinctness",
        F.when(F.col("total_rows") > 0, F.round(F.col("distinct_keys") / F.col("total_rows"), 6)),
    )


def dq_counts(
    df: DataFrame, required: str, keys: Sequence[str] = ()
) -> DataFrame:
    """Error rows, clean rows and clean keys (what the latest-per-key step keeps). One row."""
    clean = F.col(required).isNotNull()
    if not keys:
        return df.agg(
            F.count_if(~clean).alias("dq_errors"), F.count_if(clean).alias("clean_rows")
        )
    per_key = df.groupBy(*keys).agg(
        F.count_if(~clean).alias("_bad"), F.count_if(clean).alias("_ok")
    )
    return per_key.agg(
        F.coalesce(F.sum("_bad"), F.lit(0)).alias("dq_errors"),
        F.coalesce(F.sum("_ok"), F.lit(0)).alias("clean_rows"),
        F.count_if(F.col("_ok") > 0).alias("latest_rows"),
    )


def dq_split(
    df: DataFrame, condition: Column, keep_duplicates: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Rows that meet the condition, and the rest.

    The rest is a set difference by default, so equal rows count once. With
    ``keep_duplicates`` it is the plain complement, which needs no shuffle.
    """
    ok = df.filter(condition)
    complement = df.filter(~F.coalesce(condition, F.lit(False)))
    # A row that fails the condition cannot equal one that meets it, so the difference
    # is the distinct complement: one scan and one shuffle.
    return ok, complement if keep_duplicates else complement.distinct()
