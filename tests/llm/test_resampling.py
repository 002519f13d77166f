"""Resampling: words and buckets, weights, noise and ranks against a plain version."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from mailtally.llm import resampling

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return (text or "").encode().lower().decode()


def features(text, longest):
    words = WORDS.findall(lowered(text))
    return [" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]


def plain(docs, target, percent, least, longest, buckets):
    def bucket(x):
        return zlib.crc32(x.encode()) % buckets

    s = Counter(bucket(f) for _, t in docs for f in features(t, longest))
    t = Counter(bucket(f) for x in target for f in features(x, longest))
    ns, nt = sum(s.values()) + buckets, sum(t.values()) + buckets
    out, ranked = [], []
    for i, text in docs:
        found = features(text, longest)
        gain = [math.floor(1000 * math.log((t[b] + 1) * ns / ((s[b] + 1) * nt))) for b in map(bucket, found)]
        weight = sum(gain) // len(gain) if gain else 0
        name = hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()
        h = int(name[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((i, len(found), weight, score))
        if len(WORDS.findall(lowered(text))) >= least:
            ranked.append((-score, i is None, i or 0, len(found), len(out) - 1))
    ranks = {x[-1]: r for r, x in enumerate(sorted(ranked)[: percent * len(ranked) // 100], 1)}
    return Counter((*row, ranks.get(k)) for k, row in enumerate(out))


def found(docs, target, *options):
    rows = resampling.resample(docs, target, *options).collect()
    return Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in rows)


@pytest.mark.parametrize("options", [(25, 20, 2, 10_000), (60, 1, 3, 70_000), (100, 0, 1, 7), (0, 20, 2, 100)])
def test_odd_rows(spark, odd, odd_rows, options):
    target = ["er an on er an", None, "", "GNU General é"]
    frame = spark.createDataFrame([(t,) for t in target], "text string")
    assert found(odd, frame, *options) == plain([(r[0], r[1]) for r in odd_rows], target, *options)


def test_empty_tables(spark, odd, odd_rows, empty):
    nothing = spark.createDataFrame([], "text string")
    assert not found(empty, nothing)
    assert found(odd, nothing) == plain([(r[0], r[1]) for r in odd_rows], [], 25, 20, 2, 10_000)


def test_words_are_those_of_the_pattern(odd_rows):
    texts = [r[1] for r in odd_rows] + ["\x00a\x7fB9_é-İ", "ſK ß", "a" * 100_000, "x  y z"]
    for text in texts:
        n, sums = resampling.runs(text, 2, 10_000)
        assert n == len(WORDS.findall(lowered(text)))
        assert Counter(sums.tolist()) == Counter(zlib.crc32(f.encode()) % 10_000 for f in features(text, 2))


def test_target_words_are_drawn(spark):
    """Every fifth document goes round the target's words, all others round words of their own."""

    def rounds(name, start):
        return " ".join(f"{name}{(start + k) % 7}" for k in range(30))

    rows = [(i, rounds("far" if i % 5 else "near", i)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    target = spark.createDataFrame([(rounds("near", k),) for k in range(10)], "text string")
    drawn = resampling.resample(docs, target, percent=20).where("rank is not null").collect()
    assert len(drawn) == 80
    assert sum(r.doc_id % 5 == 0 for r in drawn) > 60
