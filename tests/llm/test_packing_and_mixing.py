"""Packing, mixing and the pipeline: exact accounts and brute force."""

import random
import zlib
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from mailtally.llm import mixing, packing
from mailtally.llm.common import stage
from mailtally.llm.queries import word_tokenizer


def true_ids(texts):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(word_tokenizer()).encode_batch(texts, add_special_tokens=False)
    return [np.array([*x.ids, 2], "<u4") for x in found]


def check_pieces(got, rows, capacity):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    want = Counter()
    for (doc_id, *_), ids in zip(rows, true_ids([r[1] or "" for r in rows])):
        for s in range(0, len(ids), capacity):
            part = ids[s : s + capacity]
            want[doc_id, s, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    assert want == Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got)
    return len(sequences)


@pytest.mark.parametrize("capacity", [4096, 64])
def test_pack(odd, odd_rows, capacity):
    got = packing.pack(odd, word_tokenizer(), capacity=capacity, grain=max(1, capacity // 256)).collect()
    n = check_pieces(got, odd_rows, capacity)
    assert sum(r.length for r in got) / (n * capacity) > 0.8 or n <= 4


def test_padding_on_real_lengths(spark):
    got = packing.pack(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), word_tokenizer())
    row = got.selectExpr("sum(length) / 4096 / count(distinct sequence_id)").first()
    assert row[0] > 0.98


def test_encoder_cuts_where_tokens_end(monkeypatch):
    texts = [
        "Hello, world. It's 3,5 or 1.2.\nNew, line.", "a,, b ., c!!, d. e", "x_, y ́, z",
        "ΑΣ, ΌΣΟΣ. İ, i", "<|endoftext|> a <|startoftext|>, b", "tab\t,\x0b x , y", "", " , . ",
        "don't, won't. we'LL", "Å, Å. ﬁ, ½, ⅔.", "日本語, テスト. 한국어,",
    ]
    want = [x[:-1].tobytes() for x in true_ids(texts)]
    assert packing.Encoder(word_tokenizer())(texts) == want
    monkeypatch.setattr(packing, "MEMO", 3)
    encoder = packing.Encoder(word_tokenizer())
    assert [encoder([t])[0] for t in texts] == want


def test_encoder_leaves_marks_of_other_case_alone():
    texts = ["a <|ENDOFTEXT|> b", "<|StartOfText|>, B. <|startoftext|> C", "A <| B, C.\nD", "X<|EndOfText|>y"]
    want = [x[:-1].tobytes() for x in true_ids(texts)]
    assert packing.Encoder(word_tokenizer())(texts) == want
    assert packing.Encoder(word_tokenizer())([t.lower() for t in texts]) != want


def test_encoder_on_random_texts():
    """Control characters, marks, odd blanks and letters in any order: the tokenizer's ids."""
    rng = random.Random(5)
    signs = list(
        "aAbZ019 .,,..  \n\t\r\x0b\x0c\x00\x01\x01\x1c\x1d\x1e\x1f\x7f\x85\xa0\u2003\u200b\u0327\u0301"
        "éÉİΣσς'’_-()<|>!?#$&*\u3000ßſ\u212a½²٣अ्ü\u00ad\ufb01\ufeff\u212b가각"
    ) + ["'s", "'ll", "<|endoftext|>", "<|startoftext|>", "'t ", "\x01 ", ". ", ", "]
    texts = ["\x1c. a"] + ["".join(rng.choices(signs, k=rng.randint(0, 12))) for _ in range(20_000)]
    got = packing.Encoder(word_tokenizer())(texts)
    assert got == [x[:-1].tobytes() for x in true_ids(texts)]


def test_rows_without_an_id_are_ranked_in_many_slices(spark):
    docs = spark.range(10_000, numPartitions=4).selectExpr("CAST(NULL AS long) AS doc_id", "'a b c' AS text")
    packed = packing.pack(docs, word_tokenizer(), grain=4)
    got = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.count_distinct("offset").alias("k")).collect()
    assert sum(r.n for r in got) == 40_000 and max(r.n for r in got) <= 4096
    assert len(got) == 10 and all(r.n == 4 * r.k for r in got)


def test_column_generation_reaches_the_optimum():
    weights, counts = np.array([3, 4, 5, 7]), np.array([9, 7, 6, 5])
    plan = packing.cutting_stock(weights, counts, 10, 500)
    assert (sum(p * k for p, k in plan) == counts).all()
    assert all(p @ weights <= 10 for p, _ in plan)
    least = -(-int(weights @ counts) // 10)
    assert sum(k for _, k in plan) <= least + 2
    assert packing.cutting_stock(np.zeros(0, int), np.zeros(0, int), 10, 5) == []


def test_pricing_against_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(20):
        weights, worth = np.sort(rng.choice(np.arange(1, 9), 3, replace=False)), rng.random(3)
        value, pattern = packing.price(weights, worth, 12)
        best = max(
            np.dot(c, worth) for c in product(range(13), repeat=3) if np.dot(c, weights) <= 12
        )
        assert np.isclose(value, best) and np.isclose(pattern @ worth, best)
        assert pattern @ weights <= 12


def water(sizes, weights):
    target, capped, total = {}, {}, sum(sizes.values())
    while True:
        rest = {s: w for s, w in weights.items() if s not in capped}
        share = total - sum(capped.values())
        target = capped | {s: share * w / sum(rest.values()) for s, w in rest.items()}
        above = {s: 3 * sizes[s] for s in rest if target[s] > 3 * sizes[s] * (1 + 1e-12)}
        if not above:
            return target
        capped |= above


def check_mix(got, rows):
    size = lambda t: len((t or "").encode().split())
    total = Counter()
    for _, text, _, source, _ in rows:
        total[source] += size(text)
    order = sorted(total, key=lambda s: (s is None, s or ""))
    want = water(total, {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)})
    assert Counter((r.doc_id, r.source, r.size) for r in got) == Counter(
        (r[0], r[3], size(r[1])) for r in rows
    )
    taken = Counter()
    for r in got:
        assert r.source_size == total[r.source] and np.isclose(r.target, want[r.source])
        assert r.taken == 0 or (r.taken % r.size == 0 and r.taken <= 3 * r.size)
        taken[r.source] += r.taken
    return {s: want[s] - taken[s] for s in total}


def test_mix_of_odd_rows(odd, odd_rows):
    check_mix(mixing.mix(odd).collect(), odd_rows)


def test_mix_meets_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    first = mixing.mix(docs).collect()
    off = check_mix(first, rows)
    assert all(abs(x) <= 10 for x in off.values())
    assert Counter(first) == Counter(mixing.mix(docs.repartition(7)).collect())


def test_subset_sums_against_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(40):
        lengths = np.sort(rng.choice(np.arange(1, 30), 4, replace=False))
        counts = rng.integers(1, 4, 4)
        budget = int(rng.integers(0, lengths @ counts + 5))
        take = mixing.fit_budget(lengths, counts, budget, 1 << 16)
        assert (take >= 0).all() and (take <= counts).all() and take @ lengths <= budget
        start = np.floor(counts * (budget / (lengths @ counts))).clip(max=counts).astype(int)
        best = max(
            np.dot(c, lengths)
            for c in product(*(range(a, b + 1) for a, b in zip(start, counts)))
            if np.dot(c, lengths) <= budget
        )
        assert take @ lengths == best


def test_empty(empty):
    assert mixing.mix(empty).collect() == []
    assert packing.pack(empty, word_tokenizer()).collect() == []


def test_pipeline(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    frames = [docs]
    for name, step in corpus_pipeline.STAGES:
        frames.append(stage(step(spark, frames[-1], sf), name))
    for frame in frames[1:-1]:
        assert frame.columns == docs.columns
    ids = [{r.doc_id for r in f.select("doc_id").collect()} for f in frames]
    # rejected documents are bad ones, clean ones stay
    gone = ids[0] - ids[1]
    assert gone and np.mean([quality.get(i, 0) == 0 for i in gone]) > 0.9
    assert all(i in ids[1] for i in ids[0] if quality.get(i) == 1)
    # one of each group of exact copies, at least
    assert frames[2].count() == frames[2].select("text").distinct().count() < frames[1].count()
    assert ids[3] == ids[2]
    words = lambda f: f.selectExpr("sum(size(split(trim(text), '[ \\n\\t]+')))").first()[0]
    assert words(frames[3]) < words(frames[2])
    # a repeated row shows up again as pieces
    packed = frames[5].groupBy("doc_id").sum("length").collect()
    copies = {r.doc_id: r["count"] for r in frames[4].groupBy("doc_id").count().collect()}
    tokens = {r.doc_id: r.doc_tokens for r in frames[5].collect()}
    assert {r.doc_id: r["sum(length)"] for r in packed} == {i: n * tokens[i] for i, n in copies.items()}
