"""Toxicity: bags of character n-gram vectors, averaged into a linear softmax.

A word is the mean of the vectors of its character n-grams and of the word itself; a
segment of ``span`` words is the mean of its words; a linear softmax turns that into the
odds of label 1. A document is as toxic as its most toxic segment, so that a few words in a
long text are not averaged away. Segments begin at every word, so a score does not depend on
where words stand. Vectors and softmax are fitted jointly in numpy. Since the layers are
linear, a word's share of the odds is one number, kept in a bounded memo.

The sample that comes to the driver is bounded in rows and bytes: at most ``2 * per_class``
texts, of at most ``most_bytes`` each. Longer texts are scored, but nothing is learned from them.

Defined cases: a null text counts as empty; a text without words has the odds of the bias
alone; without rows of both classes the score is the share of ones (0 without any rows).
Repeated rows are scored each for itself; other columns are not read.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field
from functools import cached_property
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailtally.llm.common import labelled_sample

EDGES = ".,;:!?\"'()[]{}<>|*-_"
#: A memo of words is dropped when it holds so many; it never changes a score.
MEMO = 300_000


def grams(words: list[str], bits: int, low: int = 3, high: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the n-grams of lower-cased words within their borders, and of whole words.

    Returns the slots and, for each, the position of its word. All words are hashed at once.
    """
    cores = [f"<{w.lower().strip(EDGES)}>".encode("utf-8", "replace") for w in words]
    mask = np.uint32((1 << bits) - 1)
    whole = np.fromiter((zlib.crc32(c) for c in cores), np.uint32, len(cores))
    size = np.fromiter(map(len, cores), np.int64, len(cores))
    raw = np.frombuffer(b"".join(cores), np.uint8).astype(np.uint32)
    owner = np.repeat(np.arange(len(cores)), size)
    left = np.repeat(np.cumsum(size), size) - np.arange(len(raw))
    slots, owners = [whole & mask], [np.arange(len(cores))]
    h = raw + np.uint32(0x9E3779B9)
    for n in range(2, high + 1):
        h = h[:-1] * np.uint32(0x01000193) ^ raw[n - 1 :] if len(h) > 1 else h[:0]
        if n >= low and len(h):
            inside = left[: len(h)] >= n
            mixed = h[inside] * np.uint32(0x85EBCA6B)
            slots.append((mixed ^ (mixed >> np.uint32(15))) & mask)
            owners.append(owner[: len(h)][inside])
    return np.concatenate(slots).astype(np.int64), np.concatenate(owners)


@dataclass
class Model:
    bits: int
    span: int
    vectors: np.ndarray
    softmax: np.ndarray
    bias: float
    memo: dict = field(default_factory=dict, repr=False)

    @cached_property
    def odds(self) -> np.ndarray:
        """The linear layers as one number for each n-gram: the log odds it adds."""
        return self.vectors @ (self.softmax[:, 1] - self.softmax[:, 0])

    def __getstate__(self):
        return self.__dict__ | {"memo": {}}

    def words(self, words: list[str]) -> np.ndarray:
        slot, owner = grams(words, self.bits)
        total = np.bincount(owner, self.odds[slot], len(words))
        return total / np.bincount(owner, minlength=len(words))

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Scores of texts, worked off in slices of bounded size."""
        out, part, size = [], [], 0
        for t in texts:
            part.append((t or "").split())
            size += len(part[-1])
            if size > 200_000:
                out.append(self._score(part))
                part, size = [], 0
        return np.concatenate([*out, self._score(part)])

    def _score(self, split: list[list[str]]) -> np.ndarray:
        memo = self.memo
        new = set(chain.from_iterable(split)).difference(memo)
        if len(memo) + len(new) > MEMO:
            memo.clear()
            new = set(chain.from_iterable(split))
        if new:
            new = list(new)
            memo.update(zip(new, self.words(new).tolist(), strict=True))
        best = np.zeros(len(split))
        for i, words in enumerate(split):
            if words:
                each = np.fromiter(map(memo.__getitem__, words), np.float64, len(words))
                span = min(self.span, len(words))
                n = len(words) - span + 1
                sums = each[:n].copy()
                for k in range(1, span):
                    sums += each[k : k + n]
                best[i] = sums.max() / span
        return 1 / (1 + np.exp(-np.clip(best + self.bias, -30, 30)))


def fit_texts(
    texts: list[str], y: np.ndarray, bits: int, width: int, span: int, epochs: int, seed: int, decay: float, rate: float
) -> Model:
    """Full-batch Adam: first on whole-text averages, then on the strongest segment."""
    rng = np.random.default_rng(seed)
    share = float(y.mean()) if len(y) else 0.0
    start = float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))
    vectors = rng.normal(0, 0.1, (1 << bits, width))
    softmax = rng.normal(0, 0.3, (width, 2))
    if len(set(y.tolist())) < 2 or not any(t.split() for t in texts):
        return Model(bits, span, np.zeros((1 << bits, width)), softmax, start)
    keep = [i for i, t in enumerate(texts) if t.split()]
    y = y[keep].astype(np.float64)
    ids: dict[str, int] = {}
    # words as numbers, text by text: only distinct ones are held as strings
    number = [
        np.array([ids.setdefault(w, len(ids)) for w in texts[i].split()], np.int32) for i in keep
    ]
    sizes = np.array([len(x) for x in number])
    tokens = np.concatenate(number)
    del number
    gram, owner = (x.astype(np.int32) for x in grams(list(ids), bits))
    n_grams = np.bincount(owner, minlength=len(ids))
    begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    per_doc = np.maximum(sizes - span, 0) + 1
    seg_at = np.concatenate([np.arange(b, b + n) for b, n in zip(begins, per_doc, strict=True)])
    seg_n = np.repeat(np.minimum(sizes, span), per_doc)
    doc_at = np.concatenate([[0], np.cumsum(per_doc)[:-1]])
    seg_doc, tok_doc = np.repeat(np.arange(len(sizes)), per_doc), np.repeat(np.arange(len(sizes)), sizes)
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    bias, state, step = np.zeros(1), {}, 0

    def adam(name: str, value, grad):
        """One step in place: a fresh array for each term would cost more than the step."""
        if name not in state:
            state[name] = (np.zeros_like(value), np.zeros_like(value), np.empty_like(value))
        m, v, room = state[name]
        m *= 0.9
        m += np.multiply(grad, 0.1, out=room)
        v *= 0.99
        np.multiply(grad, grad, out=room)
        room *= 0.01
        v += room
        np.sqrt(v, out=room)
        room += 1e-9
        np.divide(m, room, out=room)
        room *= rate * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
        value -= room

    for epoch in range(epochs):
        step += 1
        way = softmax[:, 1] - softmax[:, 0]
        word = np.bincount(owner, (vectors @ way)[gram], len(ids)) / n_grams
        each = word[tokens]
        until = np.concatenate([[0.0], np.cumsum(each)])
        seg = (until[seg_at + seg_n] - until[seg_at]) / seg_n
        if epoch < epochs // 5:
            z = np.add.reduceat(each, begins) / sizes + bias
            g = weight * (1 / (1 + np.exp(-z)) - y)
            pull = np.bincount(tokens, (g / sizes)[tok_doc], len(ids))
        else:
            top = np.maximum.reduceat(seg, doc_at)
            hit = np.flatnonzero(seg == top[seg_doc])
            hit = hit[np.unique(seg_doc[hit], return_index=True)[1]]
            z = top + bias
            g = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
            at = np.repeat(seg_at[hit] - np.cumsum(seg_n[hit]) + seg_n[hit], seg_n[hit])
            at += np.arange(len(at))
            pull = np.bincount(tokens[at], np.repeat(g / seg_n[hit], seg_n[hit]), len(ids))
        gram_pull = np.bincount(gram, (pull / n_grams)[owner], 1 << bits)
        d_soft = vectors.T @ gram_pull
        pulls = np.multiply.outer(gram_pull, way)
        pulls += decay * vectors
        adam("vectors", vectors, pulls)
        adam("softmax", softmax, np.stack([-d_soft, d_soft], 1) + 1e-6 * softmax)
        adam("bias", bias, g.sum(keepdims=True))
    return Model(bits, span, vectors, softmax, float(bias[0]))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    per_class: int = 2000,
    bits: int = 17,
    width: int = 8,
    span: int = 2,
    epochs: int = 100,
    seed: int = 7,
    decay: float = 1e-5,
    rate: float = 0.03,
    most_bytes: int = 1 << 14,
) -> Model:
    """Fit on a sample of at most ``2 * per_class`` labelled rows outside of the held-out fold,
    with texts of at most ``most_bytes``."""
    short = docs.where(F.coalesce(F.octet_length("text"), F.lit(0)) <= most_bytes)
    got = labelled_sample(short, labels, "toxic", per_class, seed).collect()
    got = sorted(got, key=lambda r: (r.doc_id, r.text))
    y = np.array([r.label for r in got])
    return fit_texts([r.text for r in got], y, bits, width, span, epochs, seed, decay, rate)


def toxicity_score(model: Model, text: Column) -> Column:
    """Score of a text column, between 0 and 1; the whole text is read."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(texts.tolist()), dtype="float64")

    return score(text)
