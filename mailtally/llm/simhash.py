"""SimHash near-duplicates by tiled exact comparison.

Fingerprints: one bit per position of the XXH64 values of a document's word shingles, set if
more than half of them have it. Links: fingerprints at most ``radius`` bits apart.

The distinct fingerprints are dealt into tiles by the population counts of their four
16-bit parts. Two fingerprints differ in at least as many bits as the counts of their parts
differ, summed up; so a pair of tiles whose counts differ by more than the radius is skipped,
and all others are compared in full, by numpy exclusive-or and bit counts. Tiles are cut
into blocks of about ``block`` fingerprints. From each comparison only a spanning star of
what it links goes on, so a cluster of thousands costs as many rows as it has members.

Defined cases: null texts and texts without words have fingerprint zero and link like any
other; fewer words than a shingle make one shingle. Rows that repeat an id are rows of their
own; a null id is never the smallest of a component that has another. Empty tables give no
rows; other columns are not read.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailtally.llm.common import stage
from mailtally.llm.components import components

SEED = 42
PARTS, PART_BITS = 4, 16
BASE = PART_BITS + 1


def word_hashes(text: str | None, words: int) -> np.ndarray:
    """The hashes of a text's word shingles, in their order; repeats stay."""
    split = (text or "").encode("utf-8", "replace").lower().split()
    if not split:
        return np.zeros(0, np.uint64)
    joined = b" ".join(split)
    ends = np.cumsum(np.fromiter(map(len, split), np.int64, len(split)) + 1)
    starts = np.concatenate([[0], ends[:-1]])
    k = min(words, len(split))
    cuts = zip(starts[: len(split) - k + 1].tolist(), (ends[k - 1 :] - 1).tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    return np.fromiter(
        (digest(joined[a:b], SEED) for a, b in cuts), np.uint64, len(split) - k + 1
    )


def majority(hashes: np.ndarray) -> int:
    """The bits that more than half of the hashes have, as a signed 64-bit number."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at : at + 65536].astype(">u8").view(np.uint8)
        ones += np.unpackbits(part).reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(">i8")[0])


def simhash(text: str | None, words: int) -> int:
    """Fingerprint as a signed 64-bit number."""
    return majority(word_hashes(text, words))


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """(doc_id, fp) for every row."""

    @F.pandas_udf("long")
    def one(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(t, words) for t in texts], dtype="int64")

    return docs.select("doc_id", one("text").alias("fp"))


def star(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """For nodes 0 to n-1 with links i-j: the least node that each one reaches."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def _compare(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    found, step = [], max(1, (1 << 19) // max(1, len(right)))
    for at in range(0, len(left), step):
        i, j = np.nonzero(np.bitwise_count(left[at : at + step, None] ^ right) <= radius)
        found.append((i + at, j))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def links(fps: DataFrame, radius: int = 4, block: int = 2048) -> DataFrame:
    """(a, b): links that join the same fingerprints as all pairs within ``radius`` do.

    ``fps`` has distinct values in ``fp``.
    """
    tile = F.lit(0)
    for p in range(PARTS):
        part = F.shiftrightunsigned("fp", p * PART_BITS).bitwiseAND(F.lit((1 << PART_BITS) - 1))
        tile = tile * BASE + F.bit_count(part)
    tiled = fps.select("fp", tile.cast("int").alias("tile"))
    sizes = tiled.groupBy("tile").agg(F.count("*").alias("n"))
    slot = F.pmod(F.xxhash64("fp"), F.ceil(F.col("n") / block)).cast("int")
    blocks = stage(
        tiled.join(sizes, "tile")
        .groupBy("tile", slot.alias("slot"))
        .agg(F.collect_list("fp").alias("fps")),
        "blocks",
    )
    # neighbours, each pair of tiles from its smaller side; digits stay within 0 to 16
    moves = [
        d
        for d in product(range(-radius, radius + 1), repeat=PARTS)
        if sum(map(abs, d)) <= radius and d >= (0,) * PARTS
    ]
    index = blocks.select("tile", "slot")
    digits = [F.floor(F.col("tile") / BASE ** (PARTS - 1 - p)) % BASE for p in range(PARTS)]
    near = F.array(*[F.struct(*[F.lit(x).alias(f"m{p}") for p, x in enumerate(d)]) for d in moves])
    other = F.lit(0)
    fits = F.lit(True)
    for p in range(PARTS):
        digit = digits[p] + F.col(f"move.m{p}")
        other = other * BASE + digit
        fits = fits & digit.between(0, PART_BITS)
    pairs = (
        index.select("tile", "slot", F.explode(near).alias("move"))
        .where(fits)
        .select("tile", "slot", other.cast("int").alias("tile2"))
        .join(index.select(F.col("tile").alias("tile2"), F.col("slot").alias("slot2")), "tile2")
        .where("tile != tile2 or slot <= slot2")
    )
    both = pairs.join(blocks.select("tile", "slot", F.col("fps").alias("left")), ["tile", "slot"])
    right = blocks.select(
        F.col("tile").alias("tile2"), F.col("slot").alias("slot2"), F.col("fps").alias("right")
    )
    both = both.join(right, ["tile2", "slot2"]).select("left", "right")

    def compare(batches):
        for pdf in batches:
            a, b = [], []
            for x, y in zip(pdf["left"], pdf["right"], strict=True):
                i, j = _compare(x.view(np.uint64), y.view(np.uint64), radius)
                i, j = i[x[i] != y[j]], j[x[i] != y[j]]
                if len(i):
                    nodes, at = np.unique(np.concatenate([x[i], y[j]]), return_inverse=True)
                    root = star(at[: len(i)], at[len(i) :], len(nodes))
                    moved = np.flatnonzero(root != np.arange(len(nodes)))
                    a.append(nodes[moved])
                    b.append(nodes[root[moved]])
            if a:
                yield pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)})

    return both.mapInPandas(compare, "a long, b long")


def near_duplicates(docs: DataFrame, radius: int = 4, words: int = 4) -> DataFrame:
    """One row per row of ``docs``: doc_id, fp, component_id (the smallest id reachable)."""
    fps = stage(fingerprints(docs, words), "fingerprints")
    classes = fps.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(links(classes.select("fp"), radius)).withColumnRenamed("node", "fp")
    classes = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    heads = classes.groupBy("root").agg(F.min("first").alias("component_id"))
    return fps.join(classes.join(heads, "root").select("fp", "component_id"), "fp").select(
        "doc_id", "fp", "component_id"
    )
