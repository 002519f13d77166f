"""Places of rows in a total order, without a window over all of them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailtally.llm.common import stage


def ranked(df: DataFrame, group: list[str], order: list[Column], name: str = "ranks") -> DataFrame:
    """``df`` with ``rank``, a row's place from 0 in the order of its group, and ``size``, the
    group's number of rows.

    Rows are dealt to ranges of group and order and sorted there, so a group with a third of
    all rows is spread over a third of the ranges, and so are rows that tie in everything (they
    carry a number). A place is the place within the range plus the group's rows in the ranges
    before; those come from one row for each range and group. Null groups are one group; ``df``
    may not hold ``rank``, ``size`` or names that end in an underscore, and should be a cheap
    scan, since the ranges are found by a pass of their own.
    """
    keys = [*map(F.col, group), *order, F.col("tie_")]
    dealt = stage(
        df.withColumn("tie_", F.monotonically_increasing_id())
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .drop("tie_")
        .withColumn("at_", F.monotonically_increasing_id())  # range << 33 | place
        .withColumn("range_", F.shiftrightunsigned("at_", 33)),
        name,
    )
    of = Window.partitionBy(*group)
    before = of.orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (
        dealt.groupBy(*group, "range_")
        .agg(F.min("at_").alias("first_"), F.count("*").alias("n_"))
        .select(
            *[F.col(c).alias(f"{c}_") for c in group],
            F.col("range_").alias("of_"),
            (F.coalesce(F.sum("n_").over(before), F.lit(0)) - F.col("first_")).alias("shift_"),
            F.sum("n_").over(of).alias("size"),
        )
    )
    same = reduce(
        lambda x, c: x & F.col(c).eqNullSafe(F.col(f"{c}_")), group, F.col("range_") == F.col("of_")
    )
    return dealt.join(ranges, same).select(
        *df.columns, (F.col("at_") + F.col("shift_")).alias("rank"), "size"
    )
