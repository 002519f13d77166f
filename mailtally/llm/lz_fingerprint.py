"""Document fingerprints from Lempel-Ziv phrases.

A text is parsed the LZ78 way: from where the last phrase ended, the shortest run of bytes
that is no phrase yet becomes one. The set of phrases says what a compressor would learn
from the text; texts that compress each other well share much of it. Phrases are hashed
and the set is sketched by minimum hashes: hash space is cut into ``SLOTS`` parts, each keeps
the smallest hash that falls into it, written as four hexadecimal digits (``....`` if none
does). The likeness of two fingerprints is the share of equal slots among those that either
one fills, an estimate of the overlap of the phrase sets; two empty ones are alike (1).

Following documents. Each document is compared with its successor in descending order of id,
the last one's being the first. Ids are dealt into ranges at approximate quantiles, documents
are sorted within them, and every range also gets the first document of the next range, so
that each successor stands right behind its document and texts move once.

Defined cases: a null text counts as empty, with an all-empty fingerprint; texts that hold
one phrase fill one slot. A null id comes last in the order; rows that repeat an id are
ordered by text. A single document is its own successor. Empty tables give no rows, other
columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SLOTS = 128
EMPTY = "...."
MASK, STEP = (1 << 56) - 1, 167


class Parser:
    """Phrases of a text as hashes; ``feed`` may be called again with what follows."""

    def __init__(self, seen: set[int] | None = None, at: int = 0):
        self.seen, self.at = set() if seen is None else seen, at

    def feed(self, raw: bytes) -> Parser:
        seen, h, mask, step = self.seen, self.at, MASK, STEP
        for b in raw:
            h = (h * step + b + 1) & mask
            if h not in seen:
                seen.add(h)
                h = 0
        self.at = h
        return self

    def copy(self) -> Parser:
        return Parser(self.seen.copy(), self.at)

    def fingerprint(self) -> str:
        # an unfinished phrase at the end is one that is there already
        h = np.fromiter(self.seen, np.uint64, len(self.seen))
        h ^= h >> np.uint64(31)
        h *= np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        slot = (h % np.uint64(SLOTS)).astype(np.int64)
        least = np.full(SLOTS, np.iinfo(np.uint64).max, np.uint64)
        np.minimum.at(least, slot, h)
        filled = np.bincount(slot, minlength=SLOTS) > 0
        return "".join(
            f"{int(x >> np.uint64(16)) & 0xFFFF:04x}" if f else EMPTY
            for x, f in zip(least, filled, strict=True)
        )


def likeness(a: str, b: str) -> float:
    pairs = [(a[i : i + 4], b[i : i + 4]) for i in range(0, 4 * SLOTS, 4)]
    used = [x == y for x, y in pairs if x != EMPTY or y != EMPTY]
    return sum(used) / len(used) if used else 1.0


def _range(doc_id, cuts: list[int], step: int = 64):
    """The number of ``cuts`` up to an id, found in two levels; -1 for null."""
    if not cuts:
        return F.when(doc_id.isNull(), -1).otherwise(0)
    listed = lambda x: F.split(F.lit(",".join(map(str, x))), ",").cast("array<bigint>")
    up_to = lambda x: F.size(F.filter(x, lambda c: c <= doc_id))
    coarse = up_to(listed(cuts[::step]))
    start = F.greatest(coarse - 1, F.lit(0)) * step
    fine = up_to(F.slice(listed(cuts), start + 1, F.lit(step)))
    return F.when(doc_id.isNull(), -1).otherwise(start + fine)


def with_following(docs: DataFrame, per_range: int, most_ranges: int) -> DataFrame:
    """(range, last, doc_id, text), each range followed by the first row of the next one.

    A row with ``last`` is there to be looked at only. Partitions are sorted by range, with
    ids descending. Only the cuts between ranges come to the driver, and one id of each
    range is broadcast: both are bounded by ``most_ranges``.
    """
    ranges = max(1, min(most_ranges, docs.count() // per_range))
    parts = [i / ranges for i in range(1, ranges)] or [0.5]
    cuts = docs.agg(F.percentile_approx("doc_id", parts, 10_000)).first()[0]
    cuts = sorted(set(cuts or []))[: ranges - 1]
    rows = docs.select(
        _range(F.col("doc_id"), cuts).cast("int").alias("range"),
        F.lit(False).alias("last"),
        "doc_id",
        F.coalesce("text", F.lit("")).alias("text"),
    )
    upward = Window.orderBy("range")
    whole = upward.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = (
        rows.groupBy(F.col("range").alias("of")).agg(F.max("doc_id").alias("first_id"))
        .withColumnRenamed("of", "range")
        .withColumn("before", F.coalesce(F.lead("range").over(upward), F.first("range").over(whole)))
        .select("before", "first_id")
    )
    heads = (
        rows.join(F.broadcast(firsts), F.col("doc_id").eqNullSafe(F.col("first_id")))
        .groupBy("before", "first_id")
        .agg(F.min("text").alias("text"))
        .select(
            F.col("before").alias("range"), F.lit(True).alias("last"), F.col("first_id").alias("doc_id"), "text"
        )
    )
    return (
        rows.unionByName(heads)
        .repartition("range")
        .sortWithinPartitions("range", "last", F.col("doc_id").desc_nulls_last(), "text")
    )


class _Document:
    """A document, its fingerprint, and the state of the parse where its edit begins."""

    def __init__(self, doc_id, text: str):
        self.doc_id, self.text = doc_id, text
        self.tail = len(text) // 2
        self.head = text[: len(text) - self.tail]
        half = Parser().feed(self.head.encode("utf-8", "replace"))
        self.half = half.copy()
        rest = text[len(self.head) :].encode("utf-8", "replace")
        self.fingerprint = half.feed(rest).fingerprint()

    def before(self, following: _Document) -> tuple:
        tail = following.text[: self.tail]
        edited = self.half.feed(tail.encode("utf-8", "replace")).fingerprint()
        digest = hashlib.sha256((self.head + tail).encode("utf-8", "replace")).hexdigest()
        return (
            self.doc_id,
            len(self.text),
            digest,
            self.fingerprint,
            edited,
            likeness(self.fingerprint, edited),
            likeness(self.fingerprint, following.fingerprint),
        )


RESULT = (
    "doc_id string, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def fingerprint(docs: DataFrame, per_range: int = 1000, most_ranges: int = 10_000) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next."""
    names = [part.split()[0] for part in RESULT.split(", ")]

    def run(batches):
        one = None  # the document that waits for its successor
        for pdf in batches:
            out = []
            for doc_id, last, text in zip(pdf["doc_id"], pdf["last"], pdf["text"], strict=True):
                two = _Document(doc_id, text)
                if one is not None:
                    out.append(one.before(two))
                one = None if last else two
            yield pd.DataFrame(out, columns=names).astype({"n_chars": "int64"})

    # ids travel as text: pandas would turn numbers next to a null into floating ones
    rows = with_following(docs, per_range, most_ranges)
    return (
        rows.withColumn("doc_id", F.col("doc_id").cast("string"))
        .mapInPandas(run, RESULT)
        .withColumn("doc_id", F.col("doc_id").cast("long"))
    )
