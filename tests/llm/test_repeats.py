"""Suffix and substring dedup against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from mailtally.llm import anchors, repeats, substring_dedup, suffix_dedup

LAST = float("inf")


def by_bytes(rows, length):
    """doc_id, n_bytes, n_removed, kept of every row."""
    first, out = {}, []
    order = [(LAST if r[0] is None else r[0], r[0], (r[1] or "").encode()) for r in rows]
    for rank, _, raw in order:
        for i in range(len(raw) - length + 1):
            w = raw[i : i + length]
            first[w] = min(first.get(w, LAST), rank)
    for rank, doc_id, raw in order:
        gone = [False] * len(raw)
        for i in range(len(raw) - length + 1):
            if first[raw[i : i + length]] < rank:
                gone[i : i + length] = [True] * length
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((doc_id, len(raw), sum(gone), kept))
    return Counter(out)


def by_words(rows, length):
    first, out = {}, []
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")
    for doc_id, text, *_ in rows:
        words, rank = split(text), LAST if doc_id is None else doc_id
        for i in range(len(words) - length + 1):
            w = tuple(words[i : i + length])
            first[w] = min(first.get(w, (LAST, LAST)), (rank, i))
    for doc_id, text, *_ in rows:
        words, rank = split(text), LAST if doc_id is None else doc_id
        gone = [False] * len(words)
        for i in range(len(words) - length + 1):
            if first[tuple(words[i : i + length])] < (rank, i):
                gone[i : i + length] = [True] * length
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((doc_id, len(words), sum(gone), kept))
    return Counter(out)


@pytest.mark.parametrize("length", [50, 24])
def test_bytes(odd, odd_rows, length):
    got = suffix_dedup.remove_repeats(odd, length).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, bytes(r.kept)) for r in got) == by_bytes(
        odd_rows, length
    )
    for r in got:
        assert sum(e - b for b, e in zip(r.begins, r.ends)) == r.n_removed
        assert all(e < b for e, b in zip(r.ends, r.begins[1:]))  # maximal runs do not touch


@pytest.mark.parametrize("length", [20, 6])
def test_words(odd, odd_rows, length):
    got = substring_dedup.remove_repeats(odd, length).collect()
    assert Counter(tuple(r) for r in got) == by_words(odd_rows, length)


def test_small_chunks_and_hot_anchors(odd, odd_rows, monkeypatch):
    monkeypatch.setattr(repeats, "HOT", 1)
    monkeypatch.setattr(repeats, "SAMPLE", 1)
    monkeypatch.setattr(repeats.Repeats, "mark", _tiny(repeats.Repeats.mark))
    got = substring_dedup.remove_repeats(odd, 20).collect()
    assert Counter(tuple(r) for r in got) == by_words(odd_rows, 20)


def _tiny(method):
    """Every document in a chunk of its own, so nothing is settled within chunks."""

    def wrapped(self, *args):
        run = method(self, *args)
        return lambda batches: run(p.iloc[i : i + 1] for p in batches for i in range(len(p)))

    return wrapped


def test_own_space_and_carried_columns(odd, odd_rows):
    got = substring_dedup.remove_repeats(odd, 20, own_space=True, carry=("lang", "source"))
    rows = {(r.doc_id, r.n_words): r for r in got.collect()}
    assert rows[2, 90].lang == "en" and rows[1, 140].kept == odd_rows[0][1]
    assert "\n" in odd_rows[1][1] and rows[2, 90].n_removed == 60


def test_empty(empty):
    assert suffix_dedup.remove_repeats(empty).collect() == []
    assert substring_dedup.remove_repeats(empty).collect() == []


def test_equal_windows_have_equal_anchors():
    rng = random.Random(1)
    shared = bytes(rng.choices(b"ab", k=70)).decode()
    texts = ["x" * 33 + shared + "yz", shared, "q" + shared]
    tokens = anchors.byte_tokens(texts)
    found = anchors.find(tokens, 50, 8)
    at = {}
    for d, p, a, b in zip(found.doc, found.place, found.first, found.last):
        for s in range(a, b + 1):
            at.setdefault(texts[d][s : s + 50], set()).add(int(p - s))
    assert all(len(v) == 1 for v in at.values())
    assert sum(len(t) - 49 for t in texts) == int((found.last - found.first + 1).sum())


def test_word_tokens_follow_the_pattern():
    texts = ["a b \x1cc\x0bd", "", " \t", "end"]
    tokens = anchors.word_tokens(texts)
    words = [tokens.raw[b:e].decode() for b, e in zip(tokens.begin, tokens.end)]
    assert words == [w for t in texts for w in re.findall(r"[^\x20\x09-\x0D]+", t)]
    assert np.diff(tokens.start).tolist() == [3, 0, 0, 1]


def test_digest_columns(spark, sf):
    from mailtally.llm.queries import QUERIES

    got = {r.doc_id: r for r in QUERIES["op10_substring_dedup"](spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    for doc_id, n, gone, kept in by_words(rows, 20):
        r = got[doc_id]
        assert (r.n_words, r.n_removed) == (n, gone)
        assert r.kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()


def contexts_again():
    """Passages that repeat with equal surroundings where an earlier document has other ones,
    and rows of one id with unlike texts."""
    rng = random.Random(9)
    text = lambda n: " ".join("".join(rng.choices("abcdefgh", k=4)) for _ in range(n))
    rows = []
    for i in range(8):
        p, line, own = text(12 + 3 * i), text(14 + i), [text(25) for _ in range(5)]
        around = f"{own[0]} {p} {own[1]}"
        rows += [
            (10 * i + 1, f"{text(40)} {p} {text(40)} {line} {text(9)}"),
            (10 * i + 2, f"{around} {text(30)} {around}"),
            (10 * i + 3, "\n".join([f"{own[2]} {line} {own[3]}"] * 4)),
            (10 * i + 4, f"{around} {text(20)}"),
            (10 * i + 5, f"{own[4]} {p} {own[2]} {text(30)}"),
            (10 * i + 5, f"{own[4]} {p} {own[2]} {text(31)}"),
        ]
    return rows


@pytest.mark.parametrize("apart", [False, True])
def test_repeated_contexts_of_one_document(spark, monkeypatch, apart):
    if apart:
        monkeypatch.setattr(repeats.Repeats, "mark", _tiny(repeats.Repeats.mark))
    rows = contexts_again()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix_dedup.remove_repeats(docs, 50).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, bytes(r.kept)) for r in got) == by_bytes(rows, 50)
    got = substring_dedup.remove_repeats(docs, 10).collect()
    assert Counter(tuple(r) for r in got) == by_words(rows, 10)
