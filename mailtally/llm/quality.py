"""Quality classifier: a factorisation machine over hashed words and structure statistics.

A document is a sparse row: its distinct words, hashed into ``2 ** bits`` slots and scaled
to unit length, the shapes of its words in the same slots, and standardised statistics of
its structure and size. The score is

    sigmoid(w0 + sum w_i x_i + 1/2 sum_f ((sum v_if x_i)^2 - sum v_if^2 x_i^2)),

the second sum being all pairwise interactions <v_i, v_j> x_i x_j in linear time.

Defined cases: a null text counts as empty; an empty text has a row of statistics and is
scored like any other; without rows of both classes the score is the share of ones (0.5
without any rows). Repeated rows are scored each for itself; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailtally.llm.common import labelled_sample

LETTERS_AND_SPACE = bytes(
    b for b in range(256) if b >= 128 or chr(b).isalnum() or chr(b).isspace()
)
NOT_UPPER = bytes(b for b in range(256) if not 65 <= b <= 90)
NOT_DIGIT = bytes(b for b in range(256) if not 48 <= b <= 57)
RUNS = re.compile(rb"[!-/:-@\[-`{-~]{2,}")
N_STATS = 20


SHAPES = bytes(
    ord("9") if chr(b).isdigit() and b < 128 else ord("X") if 65 <= b <= 90 else ord("x") if b >= 128 or chr(b).isalpha() else b
    for b in range(256)
)


def shape(word: bytes) -> bytes:
    """Case of the first and kinds of the last three bytes of a word, without its letters."""
    return b"\0" + word[:1].translate(SHAPES) + word[-3:].translate(SHAPES)


def statistics(raw: bytes, words: list[bytes], counts: Counter) -> list[float]:
    n, n_words = max(1, len(raw)), max(1, len(words))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    n_lines = max(1, len(lines))
    symbols = sorted(len(x.translate(None, LETTERS_AND_SPACE)) / len(x) for x in lines) or [0.0]
    upper = max((len(x.translate(None, NOT_UPPER)) / len(x) for x in lines), default=0.0)
    top = counts.most_common(1)[0][1] if counts else 0
    repeats = sum(map(eq, words, words[1:]))
    runs = len(RUNS.findall(raw))
    return [
        np.log1p(len(raw)),
        np.log1p(len(words)),
        np.log1p(len(lines)),
        float(not words),
        len(raw.translate(None, LETTERS_AND_SPACE)) / n,
        len(raw.translate(None, NOT_UPPER)) / n,
        len(raw.translate(None, NOT_DIGIT)) / n,
        symbols[-1],
        symbols[len(symbols) // 2],
        upper,
        len(counts) / n_words,
        np.log1p(n_words / max(1, len(counts))),
        top / n_words,
        repeats / n_words,
        np.log1p(repeats),
        runs / n_words,
        np.log1p(runs),
        1 - len(set(lines)) / n_lines,
        np.log1p(max(map(len, counts), default=0)),
        raw.count(b"|") / n_words,
    ]


def features(text: str | None, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots and values of the hashed part, and the raw statistics."""
    raw = (text or "").encode("utf-8", "replace")
    words = raw.split()
    counts = Counter(words)
    stats = np.array(statistics(raw, words, counts), dtype=np.float64)
    if not counts:
        return np.zeros(0, np.int64), np.zeros(0, np.float32), stats
    shapes: Counter = Counter()
    for w, c in counts.items():
        shapes[shape(w)] += c
    mask = (1 << bits) - 1
    parts = []
    for part in (counts, shapes):
        slot = np.fromiter((zlib.crc32(w) & mask for w in part), np.int64, len(part))
        value = np.log1p(np.fromiter(part.values(), np.float64, len(part)))
        parts.append((slot, value / np.linalg.norm(value)))
    slot = np.concatenate([x for x, _ in parts])
    value = np.concatenate([x for _, x in parts])
    slot, at = np.unique(slot, return_inverse=True)
    return slot, np.bincount(at, value).astype(np.float32), stats


@dataclass
class Model:
    bits: int
    w0: float
    w: np.ndarray
    v: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def row(self, slot: np.ndarray, value: np.ndarray, stats: np.ndarray):
        z = np.clip((stats - self.mean) / self.scale, -4, 4) / np.sqrt(N_STATS)
        at = np.concatenate([slot, (1 << self.bits) + np.arange(N_STATS)])
        return at, np.concatenate([value, z]).astype(np.float32)

    def margin(self, at: np.ndarray, x: np.ndarray) -> tuple[float, np.ndarray]:
        v = self.v[at]
        sums = x @ v
        pairs = 0.5 * float(sums @ sums - (x * x) @ (v * v).sum(1))
        return self.w0 + float(self.w[at] @ x) + pairs, sums

    def score(self, text: str | None) -> float:
        m, _ = self.margin(*self.row(*features(text, self.bits)))
        return float(1 / (1 + np.exp(-np.clip(m, -30, 30))))


def fit_rows(
    rows: list, y: np.ndarray, bits: int, rank: int, epochs: int, rate: float, seed: int
) -> Model:
    """Adagrad on the logistic loss, one row at a time."""
    rng = np.random.default_rng(seed)
    size = (1 << bits) + N_STATS
    stats = np.array([r[2] for r in rows]).reshape(len(rows), N_STATS)
    share = float(y.mean()) if len(y) else 0.5
    model = Model(
        bits,
        float(np.log(max(share, 1e-6) / max(1 - share, 1e-6))),
        np.zeros(size, np.float32),
        rng.normal(0, 0.02, (size, rank)).astype(np.float32),
        stats.mean(0) if len(rows) else np.zeros(N_STATS),
        (stats.std(0) + 1e-3) if len(rows) else np.ones(N_STATS),
    )
    if len(set(y.tolist())) < 2:
        model.v[:] = 0
        return model
    ready = [model.row(*r) for r in rows]
    gw, gv, g0 = np.full(size, 1e-6, np.float32), np.full((size, rank), 1e-6, np.float32), 1e-6
    for _ in range(epochs):
        for i in rng.permutation(len(ready)):
            at, x = ready[i]
            m, sums = model.margin(at, x)
            g = 1 / (1 + np.exp(-np.clip(m, -30, 30))) - y[i]
            dw = g * x + 1e-5 * model.w[at]
            v = model.v[at]
            dv = g * (x[:, None] * sums[None, :] - v * (x * x)[:, None]) + 1e-5 * v
            gw[at] += dw * dw
            gv[at] += dv * dv
            g0 += g * g
            model.w[at] -= rate * dw / np.sqrt(gw[at])
            model.v[at] -= 0.3 * rate * dv / np.sqrt(gv[at])
            model.w0 -= rate * g / np.sqrt(g0)
    return model


def fit(
    docs: DataFrame,
    labels: DataFrame,
    per_class: int = 2500,
    bits: int = 16,
    rank: int = 8,
    epochs: int = 6,
    rate: float = 0.1,
    seed: int = 7,
) -> Model:
    """Fit on a sample of at most ``2 * per_class`` labelled rows outside of the held-out fold.

    Tasks turn the sample's whole texts into sparse rows; only those come to the driver.
    """

    def rows(batches):
        for pdf in batches:
            found = [features(t, bits) for t in pdf["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": pdf["doc_id"],
                    "label": pdf["label"],
                    "slot": [s.astype(np.int32).tobytes() for s, _, _ in found],
                    "value": [v.tobytes() for _, v, _ in found],
                    "stats": [s.tobytes() for _, _, s in found],
                }
            )

    schema = "doc_id long, label int, slot binary, value binary, stats binary"
    got = labelled_sample(docs, labels, "quality", per_class, seed).mapInPandas(rows, schema)
    got = sorted(got.collect(), key=lambda r: (r.doc_id, r.slot))
    sparse = [
        (
            np.frombuffer(r.slot, np.int32).astype(np.int64),
            np.frombuffer(r.value, np.float32),
            np.frombuffer(r.stats, np.float64),
        )
        for r in got
    ]
    return fit_rows(sparse, np.array([r.label for r in got]), bits, rank, epochs, rate, seed)


def quality_score(model: Model, text: Column) -> Column:
    """Score of a text column, between 0 and 1; the whole text is read."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in texts], dtype="float64")

    return score(text)
