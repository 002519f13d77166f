"""Classifiers on held-out rows, the license scan and the phrase fingerprints."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from mailtally.llm import common, licenses, lz_fingerprint, quality, toxicity
from mailtally.llm.queries import QUERIES


def check_scores(got, labels, column, cut):
    known = {r.doc_id: r[column] for r in labels}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= cut) for r in got)
    rows = [(r.score, known[r.doc_id]) for r in got if r.held_out and r.doc_id in known]
    ones, zeros = ([s for s, y in rows if y == c] for c in (1, 0))
    assert ones and zeros
    better = np.mean([(a > b) + 0.5 * (a == b) for a in ones for b in zeros])
    return better, np.mean([(s >= cut) == y for s, y in rows])


@pytest.mark.parametrize(
    "name,column,cut,size",
    [("op2_quality", "quality", 0.3, 0.01), ("op6_toxicity", "toxic", 0.5, 0.1)],
)
def test_held_out(spark, name, column, cut, size):
    sf = f"/root/testdata/sf{size}"  # few documents are toxic: that one needs the larger table
    got = QUERIES[name](spark, sf).collect()
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    ranked, right = check_scores(got, labels, column, cut)
    assert ranked > 0.94 and right > 0.94


def test_interactions_in_linear_time():
    rng = np.random.default_rng(0)
    model = quality.Model(4, 0.3, rng.normal(size=36), rng.normal(size=(36, 3)), 0, 1)
    at, x = np.array([1, 5, 17, 30]), rng.normal(size=4)
    pairs = sum(
        model.v[at[i]] @ model.v[at[j]] * x[i] * x[j] for i in range(4) for j in range(i)
    )
    assert np.isclose(model.margin(at, x)[0], 0.3 + model.w[at] @ x + pairs)


def test_no_labels_and_odd_texts(spark, odd, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for model, score in (
        (quality.fit(odd, labels), quality.quality_score),
        (toxicity.fit(odd, labels), toxicity.toxicity_score),
    ):
        assert all(0 <= r[0] <= 1 for r in odd.select(score(model, odd.text)).collect())
        assert empty.select(score(model, empty.text)).collect() == []


def test_scores_do_not_depend_on_the_memo(monkeypatch):
    texts = ["pathetic fool here", "fine words only", "", None, "a fooI and more"] * 3
    y = np.array([1, 0, 0, 0, 1] * 3)
    fit = lambda: toxicity.fit_texts([t or "" for t in texts], y, 12, 4, 2, 40, 1, 1e-5, 0.05)
    want = fit().score(texts)
    monkeypatch.setattr(toxicity, "MEMO", 2)
    model = fit()
    assert np.allclose(np.concatenate([model.score([t]) for t in texts]), want)
    assert want[0] > 0.5 > want[1]


def plain_odds(model, words):
    """A segment by its definition: the vectors of all n-grams, averaged, into the softmax."""
    means = []
    for word in words:
        slots, _ = toxicity.grams([word], model.bits)
        means.append(model.vectors[slots].mean(0))
    out = np.mean(means, 0) @ model.softmax
    return out[1] - out[0]


def test_score_is_that_of_the_strongest_segment():
    rng = np.random.default_rng(2)
    model = toxicity.Model(10, 2, rng.normal(size=(1 << 10, 4)), rng.normal(size=(4, 2)), -0.3)
    texts = ["one", "one two", "a bad word stands here", "x " * 40 + "vile fool", ""]
    for text, got in zip(texts, model.score(texts), strict=True):
        words = text.split()
        n = min(2, len(words))
        parts = [words[i : i + n] for i in range(len(words) - n + 1)] if n else []
        odds = max((plain_odds(model, part) for part in parts), default=0.0)
        assert np.isclose(got, 1 / (1 + np.exp(-(odds + model.bias))))


def test_toxicity_does_not_depend_on_the_place(spark):
    texts = ["you vile fool", "a fine day", "what a vile fool you are", "words and more words"] * 5
    model = toxicity.fit_texts(texts, np.array([1, 0, 1, 0] * 5), 12, 4, 2, 60, 1, 1e-5, 0.05)
    mild = "and more words"
    even, odd = model.score([f"{mild} vile fool {mild}", f"{mild} so vile fool {mild}"])
    assert even > 0.5 and odd > 0.5 and abs(even - odd) < 0.2


def test_long_texts_and_repeated_ids_stay_out_of_the_sample(spark):
    docs = spark.createDataFrame(
        [(1, "b"), (1, "a"), (1, "a"), (2, "x" * 50), (3, None)], "doc_id long, text string"
    )
    labels = docs.selectExpr("doc_id", "CAST(doc_id % 2 AS INT) AS toxic")
    found = common.labelled_sample(docs, labels, "toxic", 10)
    rows = {(r.doc_id, r.text, r.label) for r in found.collect()}
    every = {(1, "a", 1), (2, "x" * 50, 0), (3, "", 1)}
    out = {r.doc_id for r in docs.where(common.held_out(F.col("doc_id"))).collect()}
    assert rows == {r for r in every if r[0] not in out} and found.count() == len(rows)
    model = toxicity.fit(docs, labels, bits=8, width=2, epochs=2, most_bytes=10)
    assert not model.vectors.any()  # rows of one class only are short enough


def test_licenses(odd, odd_rows, empty, spark):
    phrases = licenses.PHRASES

    def expect(text):
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
        places = [
            (i, label)
            for phrase, label in phrases.items()
            for i in range(len(words))
            if words[i : i + len(phrase.split())] == phrase.split()
        ]
        starts = [i for i, _ in places]
        labels = ",".join(sorted({x for _, x in places}))
        return len(words), len(places), min(starts, default=None), max(starts, default=None), labels

    got = licenses.scan(odd).collect()
    assert Counter((r.doc_id, *r[1:6]) for r in got) == Counter(
        (r[0], *expect(r[1])) for r in odd_rows
    )
    eight = next(r for r in got if r.doc_id == 8)
    assert eight.labels == "apache,apache-2.0,mit" and eight.score == 1
    assert licenses.scan(empty).collect() == []
    noisy = "permission is hereby granted absolutely free of charge to any person obtaining a copy"
    row = licenses.scan(spark.createDataFrame([(1, noisy)], "doc_id long, text string")).first()
    assert row.labels == "mit" and row.base_labels == "" and row.score < 1


def changed_notices():
    """(text, label) of every notice with a word put in, and with a word left out."""
    for notice, label in licenses.NOTICES.items():
        words, core = licenses.notice_words(notice)
        assert " ".join(words) == re.sub(r"[\[\]]", "", notice)
        for i in range(1, len(words)):
            if not core >> (i - 1) & 1:
                yield " ".join([*words[:i], "clearly", *words[i:]]), label
        for i in range(len(words)):
            if not (core >> i & 1 or i and core >> (i - 1) & 1):
                yield " ".join(words[:i] + words[i + 1 :]), label
        yield " ".join(words), label


def test_notices_with_a_word_in_or_out(spark):
    cases = list(changed_notices())
    assert len(cases) > 60
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: set(r.labels.split(",")) - set(r.base_labels.split(",")) for r in licenses.scan(docs).collect()}
    base = set(licenses.PHRASES.values())
    for i, (text, label) in enumerate(cases):
        # the notice's own label and no other notice's
        assert got[i] - base == {label} - base, text


@pytest.mark.parametrize(
    "text",
    [
        "licensed under the gnu general public license version 4",
        "licensed under the gnu general public license",
        "licensed under the apache license version 1 1",
        "licensed under cc by nd 4 0",
        "licensed under cc by nc sa 4 0",
        "released under the bsd license",
        "permission is hereby granted to copy this",
    ],
)
def test_other_licenses_get_no_notice(spark, text):
    row = licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.labels == row.base_labels


def test_license_scan_is_native(odd, plan):
    assert not re.search("Python|Pandas|Arrow|Scan ExistingRDD.*python", plan(licenses.scan(odd)))


def reference_phrases(raw):
    seen, i = set(), 0
    while i < len(raw):
        j = i + 1
        while j <= len(raw) and raw[i:j] in seen:
            j += 1
        if j > len(raw):
            break
        seen.add(raw[i:j])
        i = j
    return seen


def phrase_hash(phrase):
    value = sum((b + 1) * lz_fingerprint.STEP ** (len(phrase) - 1 - i) for i, b in enumerate(phrase))
    return value & lz_fingerprint.MASK


def test_parse_finds_the_phrases():
    for raw in (b"", b"a", b"aaaaaaaa", b"abababcabcabd" * 5, "é ü 文".encode() * 20):
        parser = lz_fingerprint.Parser().feed(raw)
        assert parser.seen == {phrase_hash(p) for p in reference_phrases(raw)}
        split = lz_fingerprint.Parser().feed(raw[:7]).copy().feed(raw[7:])
        assert split.fingerprint() == parser.fingerprint()


@pytest.mark.parametrize("per_range", [3, 1000])
def test_following_documents(odd, odd_rows, per_range):
    order = sorted(odd_rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    texts = [r[1] or "" for r in order]
    sign = lambda t: lz_fingerprint.Parser().feed(t.encode()).fingerprint()
    want = []
    for i, text in enumerate(texts):
        after, half = texts[(i + 1) % len(texts)], len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        a, b, c = sign(text), sign(edited), sign(after)
        digest = hashlib.sha256(edited.encode()).hexdigest()
        like = lz_fingerprint.likeness
        want.append((order[i][0], len(text), digest, a, b, like(a, b), like(a, c)))
    got = lz_fingerprint.fingerprint(odd, per_range=per_range).collect()
    assert Counter(tuple(r) for r in got) == Counter(want)


def test_likeness_estimates_the_overlap_of_phrases():
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(3000)]
    for shared in (0, 1500, 2700, 3000):
        a = " ".join(words).encode()
        b = " ".join([*words[:shared], *rng.permutation(words[shared:])]).encode()
        x, y = reference_phrases(a), reference_phrases(b)
        signs = [lz_fingerprint.Parser().feed(t).fingerprint() for t in (a, b)]
        # 128 slots: three deviations of a share are 0.13 at most
        assert abs(lz_fingerprint.likeness(*signs) - len(x & y) / len(x | y)) < 0.14


def test_likeness_tells_related_texts():
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(400)]
    sign = lambda t: lz_fingerprint.Parser().feed(t.encode()).fingerprint()
    a, b = " ".join(words[:200]), " ".join(words[200:])
    assert lz_fingerprint.likeness(sign(a), sign(a)) == 1
    assert lz_fingerprint.likeness(sign(a), sign(a[:600] + b[:400])) > lz_fingerprint.likeness(sign(a), sign(b))


def test_fingerprint_edges(empty, spark):
    assert lz_fingerprint.fingerprint(empty).collect() == []
    one = spark.createDataFrame([(5, "abcd")], "doc_id long, text string")
    row = lz_fingerprint.fingerprint(one).first()
    assert row.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and row.near_next == 1
