"""Importance resampling towards a target distribution, on hashed runs of words.

The pre-tokeniser (a split by a fixed pattern, nothing trained) turns a text with lowered A-Z
into words with offsets. Windows between pairs of offsets are the runs of 1 to ``longest``
words; the crc32 of a run, its words joined by one blank, names one of ``buckets`` buckets.
Counted over all documents and over all target texts, the buckets give the gain of a run: how
much likelier the target holds it. A document's weight is the mean gain of its runs, and with
Gumbel noise of its id the highest scores are a draw without replacement in proportion to the
exponentials of the weights.

Each text is read once: tasks write the bucket of each run, two bytes, and both the histogram
and the weights come from those. The driver holds the two histograms (``buckets`` rows each).
Ranks come from ranges of the scores; nothing is sorted in one task.

Defined cases: null texts and texts without words have no runs and weight 0; documents with less
than ``least_words`` words are never drawn but have a score. Rows that share an id are documents
of their own with the same noise; those that tie in score and id go in the order of their runs'
number. The noise of a null id is that of an empty one, and it comes last among equal scores. An
empty target gives gains from its smoothing alone; an empty table gives no rows. Other columns are
not read.
"""

from __future__ import annotations

from functools import lru_cache
from math import floor, log
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailtally.llm.common import stage
from mailtally.llm.ranks import ranked

#: What lies between words: ASCII without digits and lower-case letters.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@lru_cache(maxsize=1)
def splitter():
    """One per Python worker."""
    from tokenizers import Regex, pre_tokenizers

    return pre_tokenizers.Split(Regex(BETWEEN), behavior="removed")


def runs(text: str | None, longest: int, buckets: int) -> tuple[int, np.ndarray]:
    """The number of words, and the buckets of all runs of 1 to ``longest`` words.

    A window is extended by the word at the next pair of offsets, so its crc32 goes on from
    that of the window before.
    """
    lowered = (text or "").encode("utf-8", "replace").lower()
    letters = lowered.decode("utf-8")
    offsets = [at for _, at in splitter().pre_tokenize_str(letters)]
    source = lowered if len(lowered) == len(letters) else letters
    words = [source[a:b] for a, b in offsets]
    if source is letters:
        words = [w.encode("utf-8") for w in words]
    parts, ends = [list(map(crc32, words))], [b" " + w for w in words]
    for k in range(1, longest):
        parts.append(list(map(crc32, ends[k:], parts[-1])))
    sums = np.fromiter((x for part in parts for x in part), np.uint32)
    return len(words), sums % np.uint32(buckets)


def _width(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def found_runs(texts: DataFrame, longest: int, buckets: int) -> DataFrame:
    """(doc_id, words, runs) of every row of (doc_id, text); ``runs`` holds the buckets."""
    width = _width(buckets)

    def find(batches):
        for pdf in batches:
            found = [runs(t, longest, buckets) for t in pdf["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": pdf["doc_id"],
                    "words": np.array([n for n, _ in found], np.int64),
                    "runs": [x.astype(width).tobytes() for _, x in found],
                }
            )

    # ids travel as text: pandas would turn numbers next to a null into floating ones
    named = texts.select(F.col("doc_id").cast("string"), "text")
    return named.mapInPandas(find, "doc_id string, words long, runs binary")


def histogram(found: DataFrame, buckets: int) -> np.ndarray:
    """How many runs fall into each bucket; a task sends one row for each bucket at most."""
    width = _width(buckets)

    def count(batches):
        seen = np.zeros(buckets, np.int64)
        for pdf in batches:
            for x in pdf["runs"]:
                seen += np.bincount(np.frombuffer(x, width), minlength=buckets)
        at = np.flatnonzero(seen)
        yield pd.DataFrame({"bucket": at, "n": seen[at]})

    rows = found.select("runs").mapInPandas(count, "bucket long, n long").groupBy("bucket")
    sums = np.zeros(buckets, np.int64)
    for bucket, n in rows.agg(F.sum("n")).collect():
        sums[bucket] = n
    return sums


def gains(seen: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A thousandfold log ratio of the smoothed shares in the target and in the documents."""
    n = len(seen)
    ahead, behind = float(seen.sum() + n), float(target.sum() + n)
    return np.array(
        [
            floor(1000 * log((t + 1.0) * ahead / ((s + 1.0) * behind)))
            for s, t in zip(seen.tolist(), target.tolist(), strict=True)
        ],
        np.int64,
    )


def noise(doc_id: Column, seed: int) -> Column:
    """A thousandfold Gumbel number of a seeded hash of the id, rounded down."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 25,
    least_words: int = 20,
    longest: int = 2,
    buckets: int = 10_000,
    seed: int = 7,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_features, weight, score, rank (null: not drawn).

    Of the documents with ``least_words`` words or more, ``percent`` in a hundred are drawn.
    ``target`` has a column ``text``.
    """
    found = stage(found_runs(docs, longest, buckets), "runs")
    wanted = found_runs(target.select(F.lit(0).alias("doc_id"), "text"), longest, buckets)
    gain, width = gains(histogram(found, buckets), histogram(wanted, buckets)), _width(buckets)

    @F.pandas_udf("long")
    def weight(texts: pd.Series) -> pd.Series:
        sums = [gain[np.frombuffer(x, width)] for x in texts]
        return pd.Series([int(x.sum()) // len(x) if len(x) else 0 for x in sums], dtype="int64")

    each = np.dtype(width).itemsize
    scored = stage(
        found.select(
            F.col("doc_id").cast("long"),
            "words",
            F.expr(f"octet_length(runs) div {each}").alias("n_features"),
            weight("runs").alias("weight"),
        ).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)),
        "weights",
    )
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features")]
    enough = F.col("words") >= least_words
    placed = ranked(scored.where(enough), [], order, "scores")
    drawn = F.col("rank") < F.expr(f"size * {percent} div 100")
    columns = ["doc_id", "n_features", "weight", "score"]
    return placed.select(*columns, F.when(drawn, F.col("rank") + 1).alias("rank")).union(
        scored.where(~enough).select(*columns, F.lit(None).cast("long"))
    )
