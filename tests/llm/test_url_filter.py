"""URL filter: parts of URLs, the longest rule, the models against a plain version, odd rows."""

import hashlib
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from mailtally.llm import url_filter

SCHEMA = "page_id long, url string, html string"
ODD = [
    (1, "http://A.Example.ORG/en/12?x#y"), (2, None), (3, ""), (4, "no scheme/en"), (5, "://"),
    (6, "http://org/"), (7, "http://xorg/"), (8, "http://a.org"), (9, "ftp://x.com/fr/://b.org/"),
    (10, "http://x.com/FR/1"), (11, "http://x.com/de/?://"), (12, "http://example.org/es/"),
    (13, "http://b.example.org/en/2"), (14, "http://example.org:80/en/1"), (15, "http://é.net/ü\n/z"),
    (15, "http://é.net/ü\n/z"), (None, "http://a.net/fr/1"), (17, "http://x.org?/en/1"),
    (18, "http://a.net/" + "long/" * 3000),
]


def parts(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
    lower = m.group(1).encode().lower().decode() if m else ""
    return (lower, m.group(2)) if m else ("", "")


def rule_of(host, path):
    fits = [
        (len(h + p), len(h), verdict, h + p)
        for verdict, h, p in url_filter.RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fits)[2:] if fits else (None, None)


class Model:
    """Counts of one class, with the recursion as it is written."""

    def __init__(self, texts, order, strength, alphabet):
        self.order, self.strength, self.alphabet = order, strength, alphabet
        self.n, self.all = Counter(), Counter()
        for text in texts:
            for window in windows(text, order):
                for k in range(order + 1):
                    self.n[window[order - k :]] += 1
                    self.all[window[order - k : -1], k] += 1

    def p(self, gram):
        if not gram:
            return 1 / self.alphabet
        context = (gram[:-1], len(gram) - 1)
        return (self.n[gram] + self.strength * self.p(gram[1:])) / (self.all[context] + self.strength)


def windows(text, order):
    marked = url_filter.BEGIN * order + text + url_filter.END
    return [marked[i : i + order + 1] for i in range(len(text) + 1)]


def plain_scores(texts, good, bad, order=4, strength=4.0, alphabet=256):
    a, b = (Model(x, order, strength, alphabet) for x in (good, bad))
    out = {}
    for text in texts:
        total = 0.0
        for window in windows(text, order):
            known = [window[k:] for k in range(order + 1) if a.n[window[k:]] or b.n[window[k:]]]
            if known:
                total += math.log(a.p(known[0])) - math.log(b.p(known[0]))
        out[text] = total / (len(text) + 1)
    return out


def plain_cut(scores, good):
    steps = sorted({math.floor(s * url_filter.STEPS) for s in scores})
    goods, bads = sum(good), len(good) - sum(good)
    if not goods or not bads:
        return 0.0

    def rank(step):
        kept = [math.floor(s * url_filter.STEPS) >= step for s in scores]
        right = sum(k for k, g in zip(kept, good, strict=True) if g) * bads
        right += sum(not k for k, g in zip(kept, good, strict=True) if not g) * goods
        return (-right, abs(step), step)

    return min(map(rank, steps))[2] / url_filter.STEPS


def urls(seed, n):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        host = rng.choice(["a", "www.b", "spam", "news"]) + rng.choice([".example.org", ".x.com", ".y.net"])
        path = f"/{rng.choice(['en', 'es', 'fr', 'de'])}/{rng.randint(1, 99)}"
        out.append((i, f"http://{host}{path}{rng.choice(['', '?q=1', '#top'])}"))
    return out


def plain(rows):
    split = [(i, *parts(u)) for i, u in rows]
    decided = [rule_of(h, p) for _, h, p in split]
    known = [(h + p, d[0] == "allow") for (_, h, p), d in zip(split, decided, strict=True) if d[0]]
    aside = [hashlib.md5(t.encode()).hexdigest()[0] in "012" for t, _ in known]
    fit = [x for x, out in zip(known, aside, strict=True) if not out]
    kept = [x for x, out in zip(known, aside, strict=True) if out]
    good, bad = [t for t, g in fit if g], [t for t, g in fit if not g]
    scores = plain_scores({h + p for _, h, p in split}, good, bad)
    cut = plain_cut([scores[t] for t, _ in kept], [g for _, g in kept])
    return Counter(
        (i, h, p, d[1], d[0] or ("allow" if scores[h + p] >= cut else "block"))
        for (i, h, p), d in zip(split, decided, strict=True)
    ), scores


def frame(spark, rows):
    return spark.createDataFrame([(*r, None) for r in rows], SCHEMA)


def test_verdicts_and_scores(spark):
    rows = urls(1, 300) + [(i if i is None else 1000 + i, u) for i, u in ODD]
    clash = ["row", "gram", "window", "host", "path", "rule", "verdict", "score", "text", "good", "scored"]
    pages = frame(spark, rows).selectExpr("*", *[f"'?' AS {c}" for c in clash])
    got = url_filter.judge(pages, url_filter.RULES).collect()
    expected, scores = plain(rows)
    assert Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got) == expected
    for r in got:
        assert (r.score is None) == (r.rule is not None)
        assert r.score is None or r.score == pytest.approx(scores[r.host + r.path], abs=1e-9)


def test_rules(spark):
    rows = url_filter.judge(frame(spark, ODD), url_filter.RULES).collect()
    got = {r.page_id: (r.host, r.path, r.rule) for r in rows}
    assert got[1] == ("a.example.org", "/en/12", "example.org/en/1")
    assert got[2] == got[3] == got[4] == got[5] == ("", "", None)
    assert got[6][2] == "org/" and got[7][2] is None and got[8] == ("a.org", "", None)
    assert got[9][2] == "com/fr/" and got[10][2] is None and got[14][2] is None
    assert got[15] == ("é.net", "/ü\n/z", None) and got[17] == ("x.org", "", None)


@pytest.mark.parametrize(("tail", "only"), [("org/en/2", "allow"), ("example.org/es/1", "block"), ("net/", "allow")])
def test_one_class_or_none(spark, tail, only):
    rows = [(1, f"http://{tail}"), (2, "http://z.net/fr/1"), (3, None)]
    got = {r.page_id: r.verdict for r in url_filter.judge(frame(spark, rows), url_filter.RULES).collect()}
    assert got[2] == got[3] == only


def test_no_rows(spark):
    assert url_filter.judge(frame(spark, []), url_filter.RULES).count() == 0


def test_entries_bound_the_model(spark):
    """The most frequent strings stay, each with its ending, and all others fall back."""
    rows = [(t, i % 2 == 0) for i, (_, t) in enumerate(urls(2, 80))]
    labelled = spark.createDataFrame(rows, "text string, good boolean")
    every = {r.gram: r.ratio for r in url_filter.fit(labelled, 3, 4.0, 256, 100_000).collect()}
    some = {r.gram: r.ratio for r in url_filter.fit(labelled, 3, 4.0, 256, 50).collect()}
    assert len(some) == 50 < len(every)
    assert all(len(g) == 1 or g[1:] in some for g in some)
    assert all(every[g] == pytest.approx(x) for g, x in some.items())


def test_rare_strings_are_in_the_model(spark):
    """With more strings than any cap that was, scores are those of the whole models."""
    rng = random.Random(5)
    ends = [".example.org/es", ".org/en", ".com/fr", ".com/de", ".net/x"]
    names = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789-", k=60)) for _ in range(3000)]
    rows = [(i, f"http://{n[:30]}{ends[i % 5]}/{n[30:]}") for i, n in enumerate(names)]
    expected, scores = plain(rows)
    texts = [h + p for h, p in (parts(u) for i, u in rows if i % 5 < 4)]
    assert len({w[k:] for t in texts for w in windows(t, 4) for k in range(5)}) > 120_000
    got = url_filter.judge(frame(spark, rows), url_filter.RULES).collect()
    assert Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got) == expected
    for r in got:
        assert r.score is None or r.score == pytest.approx(scores[r.host + r.path], abs=1e-9)


def test_no_python(spark, plan):
    text = plan(url_filter.judge(frame(spark, urls(1, 40)), url_filter.RULES))
    assert "Python" not in text and "Pandas" not in text
    rows = spark.createDataFrame([("x" * 200_000, True)], "text string, good boolean")
    n = rows.select(F.size(url_filter.windows(F.col("text"), 4)).alias("n")).first().n
    assert n == 200_001
