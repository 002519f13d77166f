"""Connected components by alternating star contractions (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailtally.llm.common import stage


def _least(edges: DataFrame) -> DataFrame:
    """Each node next to the least of itself and its neighbours ``b``."""
    return edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); root is the least node reachable.

    Each round moves links to smaller nodes until only stars are left; rounds grow with the
    logarithm of the longest path. A round is two joins on nodes with aggregates of one row
    per node, written to the shared folder; no neighbour list and no component is gathered.
    Nulls link nothing; loops and repeated links do no harm.
    """
    now = stage(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a is not null and b is not null and a != b")
        .distinct(),
        "links",
    )
    seen = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if mark == seen or mark[0] == 0:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                now.select("b", "b").distinct()
            )
        seen = mark
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = (
            both.join(_least(both), "a")
            .where("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        small = large.join(_least(large), "a").select(
            F.explode(
                F.array(
                    F.struct(F.col("a"), F.col("m").alias("b")),
                    F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                )
            ).alias("e")
        )
        now = stage(small.select("e.a", "e.b").where("a != b").distinct(), "links")
