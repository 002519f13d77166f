"""Substring dedup of words by seed and extend.

Seeds are the winnowed anchors of all windows of ``length`` words. Documents meet on equal
seeds; a match is extended both ways as far as a window around the seed can reach: whole
contexts that agree are matches of full reach, elsewhere every extension is compared window
by window. Overlapping windows add up to maximal repeats, all of at least ``length`` words.
Matches are kept against the earliest occurrence only, so a seed that thousands of
documents share costs one comparison each and no pairs.

Defined cases: a null text has no words; documents shorter than ``length`` keep all words.
"Earlier" is a smaller id, or an earlier word in the same document; a null id comes after
all others. Rows that repeat an id are compared as one document with itself: equal places
of equal texts are not earlier. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from mailtally.llm.anchors import Tokens, word_tokens
from mailtally.llm.repeats import Repeats, runs

SEED = 5


def _finish(own_space: bool):
    def finish(tokens: Tokens, covered: np.ndarray) -> dict:
        raw = tokens.raw
        out = {"n_words": np.diff(tokens.start), "n_removed": [], "kept": []}
        gone = np.concatenate([[0], np.cumsum(covered)])
        out["n_removed"] = gone[tokens.start[1:]] - gone[tokens.start[:-1]]
        begin, end, doc = runs(~covered, tokens.start)
        at = np.searchsorted(doc, np.arange(len(tokens.start)))
        for i in range(len(tokens.start) - 1):
            parts = [
                raw[tokens.begin[b] : tokens.end[e - 1]]
                for b, e in zip(begin[at[i] : at[i + 1]], end[at[i] : at[i + 1]], strict=True)
            ]
            joined = b" ".join(parts)
            out["kept"].append((joined if own_space else b" ".join(joined.split())).decode("utf-8"))
        return out

    return finish


def remove_repeats(
    docs: DataFrame, length: int = 20, own_space: bool = False, carry: tuple[str, ...] = ()
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept (the remaining words),
    and the string columns named in ``carry``.

    Words are joined by one space; with ``own_space`` by the white space they had, and by one
    space where words were removed.
    """
    schema = {"n_words": "long", "n_removed": "long", "kept": "string"}
    job = Repeats(word_tokens, length, min(SEED, length), within=True)
    return job.remove(docs, _finish(own_space), schema, carry)
