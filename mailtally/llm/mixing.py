"""Mixing sources to target weights: subset-sum fitting of each source's word budget.

Sizes are word counts. Every source has a target; whole passes over the source come first,
and what is left of the target is a subset-sum problem over its length histogram: a
proportional share of every length, then the longest lengths that still fit, and for the
last ``dp_budget`` words an exact bounded-knapsack table. The answer is a number of
documents for each length; which ones is decided by a seeded hash of id and text.

Only histograms meet in one task. Documents of one source and length are ranked in slices
of their hash, so that a length which holds a third of all rows is spread over ``SLICES``
tasks; slices before the cut are taken whole.

Defined cases: a null text has size 0 and takes nothing; null is a source of its own, after
all others; a source without words has target 0. Rows that repeat an id are documents of
their own (equal ones tie, and any of them may be taken). An empty table gives no rows.
Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mailtally.llm.common import WORDS, stage

SLICES = 256
#: No document is used more often than this, and no target exceeds so many source sizes.
MOST = 3


def targets(sizes: DataFrame, shares: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """(source, source_size, target) from rows with ``source`` and ``size``.

    With the caps ``MOST * source_size``, sharing the excess anew until nobody is above his
    cap ends at a level L with target = min(cap, weight * L): sorted by cap / weight, the
    sources before some point are at their caps and the rest shares what they leave.
    The windows run over one row per source.
    """
    by_source = Window.orderBy(F.col("source").asc_nulls_last())
    by_level = Window.orderBy("level", F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(0, Window.unboundedFollowing)
    weights = F.array(*map(F.lit, shares))
    place = (F.row_number().over(by_source) - 1) % len(shares)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sources = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("weight", F.get(weights, place.cast("int")).cast("double"))
        .withColumn("cap", F.lit(float(MOST)) * F.col("source_size"))
        .withColumn("level", F.col("cap") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything).cast("double"))
        .withColumn("used", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("open", F.sum("weight").over(after))
    )
    capped = F.col("level") * F.col("open") <= F.col("total") - F.col("used")
    # the candidates fall from the first open source on, so its own is the largest of them
    level = F.max(F.when(~capped, (F.col("total") - F.col("used")) / F.col("open"))).over(everything)
    return sources.withColumn("water", level).select(
        "source",
        "source_size",
        F.when(F.col("water").isNull(), F.col("cap"))
        .otherwise(F.least("cap", F.col("weight") * F.col("water")))
        .alias("target"),
    )


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: int, dp_budget: int) -> np.ndarray:
    """How many documents of each length to take so that their lengths sum up to ``budget``.

    Never above the budget, and exactly at it where the last table finds a sum.
    """
    total = int(lengths @ counts)
    if budget >= total:
        return counts.copy()
    take = np.floor(counts * (budget / max(1, total))).astype(np.int64)
    rest = budget - int(take @ lengths)
    for i in np.argsort(-lengths, kind="stable"):
        if rest <= dp_budget:
            break
        if lengths[i] > 0:
            more = min(counts[i] - take[i], max(0, rest - dp_budget // 2) // lengths[i])
            take[i] += more
            rest -= int(more * lengths[i])
    # reached[s] tells the item by which the sum s was first made; -1: not at all, -2: nothing
    reached = np.full(rest + 1, -1, np.int32)
    reached[0] = -2
    items = []
    for i in np.flatnonzero((lengths > 0) & (lengths <= rest) & (take < counts)):
        left, n = int(counts[i] - take[i]), 1
        while left > 0 and n * lengths[i] <= rest:  # counts in powers of two
            n_now = min(n, left)
            size = int(n_now * lengths[i])
            if size <= rest:
                new = (reached[size:] == -1) & (reached[: rest + 1 - size] != -1)
                reached[size:][new] = len(items)
                items.append((i, n_now, size))
            left -= n_now
            n *= 2
    at = int(np.flatnonzero(reached != -1)[-1])
    while reached[at] >= 0:
        i, n, size = items[reached[at]]
        take[i] += n
        at -= size
    return take


def mix(docs: DataFrame, seed: int = 11, dp_budget: int = 1 << 16) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, taken."""
    sizes = stage(
        docs.select(
            "doc_id",
            "source",
            F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("long").alias("size"),
            # by the text as well: rows without an id, or of one, are not all in one slice
            F.xxhash64(F.lit(seed), "doc_id", "text").alias("order"),
        ),
        "sizes",
    ).withColumn("slice", F.pmod(F.shiftright("order", 40), F.lit(SLICES)).cast("int"))
    wanted = targets(sizes)
    hist = sizes.groupBy("source", "size").agg(F.count("*").alias("n"))
    joined = hist.join(wanted, hist.source.eqNullSafe(wanted.source)).select(
        hist.source, "size", "n", "source_size", "target"
    )

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("size", ignore_index=True)
        target, size = float(pdf["target"][0]), int(pdf["source_size"][0])
        passes = min(MOST, int(target // size)) if size else 0
        budget = int(round(target - passes * size)) if size and passes < MOST else 0
        more = fit_budget(pdf["size"].to_numpy(), pdf["n"].to_numpy(), budget, dp_budget)
        return pdf[["source", "size", "source_size", "target"]].assign(passes=passes, more=more)

    plan = joined.groupBy("source").applyInPandas(
        fit,
        "source string, size long, source_size long, target double, passes long, more long",
    )
    # documents before each slice, from one row per source, length and slice
    key = ["source", "size"]
    slices = sizes.groupBy(*key, "slice").agg(F.count("*").alias("n_slice"))
    ahead = Window.partitionBy(*key).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("ahead", F.coalesce(F.sum("n_slice").over(ahead), F.lit(0)))
    same = slices.source.eqNullSafe(plan.source) & (slices["size"] == plan["size"])
    cuts = slices.join(plan, same).select(
        slices.source, slices["size"], "slice", "ahead", "source_size", "target", "passes", "more"
    )
    rank = F.row_number().over(
        Window.partitionBy("source", "size", "slice").orderBy("order", "doc_id")
    )
    ranked = sizes.withColumn("rank", rank)
    same = (
        ranked.source.eqNullSafe(cuts.source)
        & (ranked["size"] == cuts["size"])
        & (ranked["slice"] == cuts["slice"])
    )
    extra = (F.col("ahead") + F.col("rank") <= F.col("more")).cast("long")
    return ranked.join(cuts, same).select(
        "doc_id",
        ranked.source,
        ranked["size"],
        "source_size",
        "target",
        (ranked["size"] * (F.col("passes") + extra)).alias("taken"),
    )
