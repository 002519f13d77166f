"""Packing into sequences by cutting-stock column generation.

Documents are tokenised in tasks; those longer than a sequence are cut into full pieces and
a rest, so a piece never needs to be cut again. Piece lengths are counted in units of
``grain`` tokens. Over that histogram the fractional cutting-stock problem is solved by
column generation: the revised simplex method on a basis of patterns, and an unbounded
knapsack by dynamic programming that prices the next pattern at the current duals. The
solution is rounded down; what stays open, at most one partial copy of each pattern, is
packed by best fit. Only the histogram (at most capacity / grain rows) is on the driver.

Pieces are then ranked within their unit length and the patterns handed out by rank. Ranks
come from slices of a hash, so a length that a third of all pieces share is ranked in many
tasks. Offsets within a sequence are sums over its few pieces.

Defined cases: a null text counts as empty and is one piece of one token (the end mark);
rows that repeat an id are documents of their own (equal pieces tie); an empty table gives
no rows. Other columns are not read.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import Counter
from functools import lru_cache
from unicodedata import is_normalized

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mailtally.llm.common import stage

#: The memo of encoded words is dropped when it holds so many; it never changes an id.
MEMO = 500_000
#: A comma or point that the tokenizer may take together with the sign before it: anything but
#: a letter, a digit, a blank.
SIGNS = re.compile(r"[,.](?<=[^\w ][,.]|_[,.]) ")
#: Parts are encoded so many at a time, with a sign between them that is a token of its own.
JOINED, MARK = 5_000, "\x01"


def parts(text: str) -> list[str]:
    """A text cut at places where tokens end in any case.

    Blanks and line ends separate tokens. So does the border between a letter or digit and a
    comma or point with a blank behind it. The tokenizer lowers letters one by one, as
    ``lower`` does but for two letters. It looks for its marks, as ``<|endoftext|>``, before
    that, so texts that may hold one keep their letters.
    """
    text = text.replace("\n", " ")
    if "\u03a3" not in text and "\u0130" not in text:
        if "<|" not in text:
            text = text.lower()
        if not SIGNS.search(text):
            text = text.replace(", ", " , ").replace(". ", " . ")
    return text.split(" ")


class Encoder:
    """Token ids as little-endian 32-bit numbers; parts of texts are encoded once and kept
    in a bounded memo."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.for_letters = (Tokenizer.from_file(path) for _ in range(2))
        self.memo: dict[str, bytes] = {"": b""}
        self.mark = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        # nothing is left to normalise or to split in words of lowered letters
        self.for_letters.normalizer = None
        self.for_letters.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(False, use_regex=False)]
        )

    def learn(self, words: list[str]) -> None:
        """Put the words' ids into the memo. Between blanks a mark is one token, and no other
        text gives that token, so many words are encoded as one text and told apart by it."""
        joined, alone, letters = [], [], []
        for w in words:
            if w.isalpha() and w == w.lower() and is_normalized("NFC", w):
                letters.append(w)
            else:
                (alone if MARK in w else joined).append(w)
        if len(self.mark) != 1:
            joined, alone, letters = [], words, []
        for at in range(0, len(alone), JOINED):
            part = alone[at : at + JOINED]
            found = self.tokenizer.encode_batch_fast(part, add_special_tokens=False)
            ids = (np.array(x.ids, "<u4").tobytes() for x in found)
            self.memo.update(zip(part, ids, strict=True))
        for tokenizer, plain in ((self.tokenizer, joined), (self.for_letters, letters)):
            for at in range(0, len(plain), JOINED):
                part = plain[at : at + JOINED]
                text = f" {MARK} ".join(part)
                (found,) = tokenizer.encode_batch_fast([text], add_special_tokens=False)
                ids = np.array(found.ids, "<u4")
                raw, ends = ids.tobytes(), 4 * np.append(np.flatnonzero(ids == self.mark[0]), len(ids))
                starts = np.append(0, ends[:-1] + 4)
                cut = zip(part, starts.tolist(), ends.tolist(), strict=True)
                self.memo.update((w, raw[a:b]) for w, a, b in cut)

    def __call__(self, texts: list[str]) -> list[bytes]:
        split = [parts(t) for t in texts]
        new = set().union(*split).difference(self.memo)
        if len(self.memo) + len(new) > MEMO:
            self.memo = {"": b""}
            new = set().union(*split) - {""}
        self.learn(list(new))
        get = self.memo.__getitem__
        return [b"".join(map(get, words)) for words in split]


@lru_cache(maxsize=1)
def encoder_of(path: str) -> Encoder:
    """One per Python worker, so that its memo outlives a task."""
    return Encoder(path)


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): each document's full pieces and rest."""
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches):
        encoder = encoder_of(tokenizer)
        for pdf in batches:
            texts = pdf["text"].tolist()
            at, rows = 0, []
            while at < len(texts):
                to, size = at, 0
                while to < len(texts) and size < 1_000_000:  # characters encoded at a time
                    size += len(texts[to])
                    to += 1
                for i, ids in enumerate(encoder(texts[at:to]), at):
                    ids += end
                    n = len(ids) // 4
                    for s in range(0, n, capacity):
                        e = min(n, s + capacity)
                        rows.append((i, s, e - s, zlib.crc32(ids[4 * s : 4 * e]), n))
                at = to
            row, *rest = zip(*rows, strict=True) if rows else [()] * 5
            ids = pdf["doc_id"].iloc[list(row)].reset_index(drop=True)
            names = ["start", "length", "ids_crc32", "doc_tokens"]
            yield pd.DataFrame({"doc_id": ids} | dict(zip(names, rest, strict=True)))

    # ids travel as text: pandas would turn numbers next to a null into floating ones
    texts = docs.select(F.col("doc_id").cast("string"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInPandas(
        cut, "doc_id string, start long, length long, ids_crc32 long, doc_tokens long"
    ).withColumn("doc_id", F.col("doc_id").cast("long"))


def price(weights: np.ndarray, worth: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable pattern: an unbounded knapsack over the unit lengths."""
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for c in range(1, capacity + 1):
        fits = np.searchsorted(weights, c, "right")
        best[c], last[c] = best[c - 1], -1
        if fits:
            value = best[c - weights[:fits]] + worth[:fits]
            i = int(value.argmax())
            if value[i] > best[c] + 1e-12:
                best[c], last[c] = value[i], i
    pattern, c = np.zeros(len(weights)), capacity
    while c > 0:
        if last[c] < 0:
            c -= 1
        else:
            pattern[last[c]] += 1
            c -= int(weights[last[c]])
    return float(best[capacity]), pattern


def cutting_stock(weights: np.ndarray, counts: np.ndarray, capacity: int, rounds: int) -> list:
    """Patterns with whole copies that hold exactly ``counts`` pieces: [(pattern, copies)].

    ``weights`` ascend and lie in 1 to ``capacity``.
    """
    m = len(weights)
    if not m:
        return []
    fit = (capacity // weights).astype(np.float64)
    columns, cost = [np.eye(m)[i] * fit[i] for i in range(m)], np.ones(m)
    inverse, x = np.diag(1 / fit), counts / fit
    for turn in range(rounds):
        duals = cost @ inverse
        if duals.min() < -1e-9:  # more pieces than needed may be cut
            column, new_cost = -np.eye(m)[int(duals.argmin())], 0.0
        else:
            value, column = price(weights, duals, capacity)
            new_cost = 1.0
            if value <= 1 + 1e-9:
                break
        d = inverse @ column
        ratio = np.where(d > 1e-9, x / np.where(d > 1e-9, d, 1), np.inf)
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        x = np.maximum(x - ratio[out] * d, 0)
        x[out] = ratio[out]
        columns[out], cost[out] = column, new_cost
        if turn % 200 == 199:
            inverse = np.linalg.inv(np.array(columns).T)
            x = np.maximum(inverse @ counts, 0)
        else:
            inverse[out] /= d[out]
            rest = np.arange(m) != out
            inverse[rest] -= np.outer(d[rest], inverse[out])
    left, plan = counts.astype(np.int64).copy(), []
    for pattern, copies, c in zip(columns, np.floor(x + 1e-7).astype(np.int64), cost, strict=True):
        if c and copies > 0:
            pattern = pattern.astype(np.int64)
            used = pattern > 0
            copies = min(int(copies), int((left[used] // pattern[used]).min()))
            if copies:
                plan.append((pattern, copies))
                left -= pattern * copies
    return plan + best_fit(weights, left, capacity)


def best_fit(weights: np.ndarray, counts: np.ndarray, capacity: int) -> list:
    """Best fit in descending order, over open sequences counted by what they hold."""
    room: Counter = Counter()  # (free, pattern) -> open sequences
    for i in range(len(weights) - 1, -1, -1):
        w, n = int(weights[i]), int(counts[i])
        while n:
            fits = [k for k in room if k[0] >= w]
            free, held = min(fits) if fits else (capacity, ())
            each = free // w
            full = n // each
            take, copies = (each, full if not fits else min(full, room[free, held])) if full else (n, 1)
            if fits:
                room[free, held] -= copies
                room = +room
            room[free - take * w, (*held, (i, take))] += copies
            n -= take * copies
    plan = []
    for (_, held), copies in sorted(room.items()):
        pattern = np.zeros(len(weights), np.int64)
        for i, k in held:
            pattern[i] += k
        plan.append((pattern, copies))
    return plan


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 4096,
    grain: int = 16,
    end_id: int = 2,
    rounds: int = 3000,
    per_slice: int = 2000,
    seed: int = 3,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    units = F.ceil(F.col("length") / grain).cast("int")
    cut = stage(
        pieces(docs, tokenizer, capacity, end_id)
        .withColumn("units", units)
        # a row's number keeps rows of one id, or without one, from meeting in one slice
        .withColumn("order", F.xxhash64(F.lit(seed), "doc_id", "start", F.monotonically_increasing_id())),
        "pieces",
    )
    hist = sorted(tuple(r) for r in cut.groupBy("units").count().collect())
    weights, counts = (np.array(x, np.int64) for x in (zip(*hist, strict=True) if hist else ((), ())))
    plan = cutting_stock(weights, counts, capacity // grain, rounds)
    # for each unit length: from which rank a pattern takes over, with its first sequence
    spans: dict[int, list] = {int(w): [] for w in weights}
    filled, sequence = np.zeros(len(weights), np.int64), 0
    for pattern, copies in plan:
        for i in np.flatnonzero(pattern):
            spans[int(weights[i])].append((int(filled[i]), int(pattern[i]), sequence))
        filled += pattern * copies
        sequence += copies
    spans = {w: np.array(s, np.int64) for w, s in spans.items()}

    def hand_out(batches):
        for pdf in batches:
            chosen = np.zeros(len(pdf), np.int64)
            for w, at in pdf.groupby("units").indices.items():
                table, rank = spans[int(w)], pdf["rank"].to_numpy()[at]
                row = table[np.searchsorted(table[:, 0], rank, "right") - 1]
                chosen[at] = row[:, 2] + (rank - row[:, 0]) // row[:, 1]
            yield pdf.drop(columns=["units", "rank"]).assign(sequence_id=chosen)

    slices = max(1, int(counts.sum()) // per_slice)
    sliced = cut.withColumn("slice", F.pmod(F.shiftright("order", 20), F.lit(slices)).cast("int"))
    sizes = sliced.groupBy("units", "slice").agg(F.count("*").alias("n"))
    before = Window.partitionBy("units").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        "units", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead")
    )
    within = Window.partitionBy("units", "slice").orderBy("order", "doc_id", "start")
    ranked = (
        sliced.withColumn("place", F.row_number().over(within) - 1)
        .join(sizes, ["units", "slice"])
        .withColumn("rank", F.col("ahead") + F.col("place"))
    )
    kept = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    others = ", ".join(f"{c} long" for c in [*kept[1:], "sequence_id"])
    placed = (
        ranked.select(F.col("doc_id").cast("string"), *kept[1:], "units", "rank")
        .mapInPandas(hand_out, f"doc_id string, {others}")
        .withColumn("doc_id", F.col("doc_id").cast("long"))
    )
    along = (
        Window.partitionBy("sequence_id")
        .orderBy(F.col("length").desc(), "doc_id", "start", "ids_crc32")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(along), F.lit(0)))
