"""Anchors of token sequences: what the operators on repeated passages share.

A document is a sequence of tokens (bytes or words), each given as a 64-bit hash. Every
window of ``length`` tokens has an anchor, the seed of ``seed`` tokens in it with the least
hash, the first one of equal ones. The choice depends on the window alone, so equal windows
have equal anchors at equal places: all occurrences of a window are found at the
occurrences of its anchor, of which there are far fewer than of windows.

The windows of one anchor are neighbours; they begin at ``first`` to ``last``. Together they
span the anchor's context, the tokens from ``first`` to ``last + length``. Contexts are
compared by a hash of their tokens and of where the anchor is in them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

U = np.uint64
RNG = np.random.Generator(np.random.PCG64(20_240_501))
BYTES = RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
BASE = U(0x9E3779B97F4A7C15)
INVERSE = U(pow(int(BASE), -1, 1 << 64))
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


@dataclass
class Tokens:
    """Tokens of several documents in a row.

    ``hash``: of each token; ``doc``: its document's number; ``begin``, ``end``: its bytes
    in ``raw``; ``start``: each document's first token.
    """

    hash: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    begin: np.ndarray | None
    end: np.ndarray | None
    raw: bytes


def byte_tokens(texts: list[str]) -> Tokens:
    parts = [t.encode("utf-8", "replace") for t in texts]
    raw = b"".join(parts)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    start = np.concatenate([[0], np.cumsum(sizes)])
    token = BYTES[np.frombuffer(raw, np.uint8)]
    return Tokens(token, np.repeat(np.arange(len(parts)), sizes), start, None, None, raw)


def word_tokens(texts: list[str]) -> Tokens:
    """Words between ASCII white space, hashed all at once."""
    parts = [t.encode("utf-8", "replace") for t in texts]
    raw = b"\n".join(parts) + b"\n"
    data = np.frombuffer(raw, np.uint8)
    blank = SPACE[data]
    edge = np.flatnonzero(np.diff(blank.astype(np.int8), prepend=1, append=1))
    begin, end = edge[::2], edge[1::2]
    sizes = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
    ends = np.cumsum(sizes)
    start = np.searchsorted(begin, np.concatenate([[0], ends]))
    doc = np.repeat(np.arange(len(parts)), np.diff(start))
    inside = np.arange(len(data)) - np.repeat(
        np.concatenate([[0], begin]), np.diff(np.concatenate([[0], begin, [len(data)]]))
    )
    longest = int((end - begin).max()) if len(begin) else 0
    factor = powers(BASE, longest + 1)
    value = np.where(blank, U(0), BYTES[data] * factor[np.minimum(inside, longest)])
    token = mix(np.add.reduceat(value, begin)) if len(begin) else np.zeros(0, np.uint64)
    return Tokens(token, doc, start, begin, end, raw)


@dataclass
class Anchors:
    """One entry per anchor of a document, by position; ``place`` counts tokens from the
    beginning of the document, so do ``first`` and ``last``."""

    doc: np.ndarray
    place: np.ndarray
    first: np.ndarray
    last: np.ndarray
    seed: np.ndarray
    context: np.ndarray


def find(tokens: Tokens, length: int, seed: int) -> Anchors:
    n, reach = len(tokens.hash), length - seed + 1
    none = np.zeros(0, np.int64)
    if n < length:
        return Anchors(none, none, none, none, none.astype(U), none.astype(U))
    # hashes of seeds, smallest in reach of each window's beginning, and where it is
    gram = tokens.hash[: n - seed + 1].copy()
    for i in range(1, seed):
        gram = gram * BASE + tokens.hash[i : n - seed + 1 + i]
    value = mix(gram)
    at, best, wide = np.arange(len(value), dtype=np.int32), value, 1
    while wide < reach:
        step = min(wide, reach - wide)
        left, right = best[: len(best) - step], best[step:]
        at = np.where(right < left, at[step:], at[: len(best) - step])
        best = np.minimum(left, right)
        wide += step
    windows = np.flatnonzero(tokens.doc[: n - length + 1] == tokens.doc[length - 1 :])
    if not len(windows):
        return Anchors(none, none, none, none, none.astype(U), none.astype(U))
    place = at[windows].astype(np.int64)
    doc = tokens.doc[windows]
    new = np.flatnonzero((np.diff(place, prepend=-1) != 0) | (np.diff(doc, prepend=-1) != 0))
    first = windows[new]
    last = windows[np.append(new[1:], len(windows)) - 1]
    place, doc = place[new], doc[new]
    total = np.concatenate([[U(0)], np.cumsum(tokens.hash * powers(BASE, n))])
    context = (total[last + length] - total[first]) * powers(INVERSE, n)[first]
    context = mix(context + mix((place - first).astype(U) * U(512) + (last - first).astype(U)))
    base = tokens.start[doc]
    return Anchors(doc, place - base, first - base, last - base, value[place], context)
