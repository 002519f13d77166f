"""SimHash, embeddings and components against brute force."""

import random
import re

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from mailtally.llm import embedding_dedup, mixing, shingle_sets, simhash
from mailtally.llm.components import components


def closure(n, linked):
    root = list(range(n))
    for _ in range(n):
        new = [min([root[i], *(root[j] for j in range(n) if linked(i, j))]) for i in range(n)]
        if new == root:
            return root
        root = new
    return root


def fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    parts = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(p.encode(), seed=42).intdigest() for p in parts]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def test_simhash(odd, odd_rows):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == len(odd_rows)
    fps = [fingerprint(r[1]) for r in odd_rows]
    near = lambda i, j: bin(fps[i] ^ fps[j]).count("1") <= 4
    root = closure(len(fps), near)
    least = {}
    for r, row in zip(root, odd_rows):
        if row[0] is not None:
            least[r] = min(least.get(r, row[0]), row[0])
    want = sorted((str(row[0]), f, str(least.get(r))) for row, f, r in zip(odd_rows, fps, root))
    assert want == sorted((str(r.doc_id), r.fp % (1 << 64), str(r.component_id)) for r in got)


@pytest.mark.parametrize("block", [8, 2048])
def test_links_of_planted_fingerprints(spark, block):
    rng = random.Random(2)
    values = {rng.getrandbits(64) for _ in range(60)} | {0, (1 << 64) - 1}
    for v in list(values)[:25]:
        for _ in range(4):
            for bit in rng.sample(range(64), rng.randint(1, 5)):
                v ^= 1 << bit
            values.add(v)
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    fps = spark.createDataFrame([(v,) for v in signed], "fp long")
    found = {r.node: r.root for r in components(simhash.links(fps, 4, block)).collect()}
    root = closure(len(values), lambda i, j: bin(values[i] ^ values[j]).count("1") <= 4)
    groups = lambda keys: sorted(sorted(g) for g in keys.values() if len(g) > 1)
    want, got = {}, {}
    for v, r in zip(signed, root):
        want.setdefault(r, []).append(v)
        got.setdefault(found.get(v, v), []).append(v)
    assert groups(want) == groups(got)


def test_links_stay_linear_in_a_cluster(spark):
    values = [(1 << i) | (1 << j) for i in range(40) for j in range(i)]
    fps = spark.createDataFrame([(v,) for v in values], "fp long")
    assert simhash.links(fps).count() < 60 * len(values)
    assert {r.root for r in components(simhash.links(fps)).collect()} == {min(values)}


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(50)] + [(100, 200 + i) for i in range(30)]
    edges += [(7, 7), (5, 4), (4, 5), (None, 3)]
    rng.shuffle(edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(51)} | {100: 100} | {200 + i: 100 for i in range(30)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def vectors():
    rng = np.random.default_rng(6)
    rows = []
    for label in (0, 1, 2):
        for c in rng.normal(size=(30, 8)):
            for _ in range(4):
                rows.append((len(rows), (c + rng.normal(0, 0.18, 8)).tolist(), label))
    rows += [(1000 + i, rows[0][1], 0) for i in range(20)]  # copies
    rows += [(2000, None, 0), (2001, [0.0] * 8, 0), (2002, [float("nan")] * 8, 1), (2003, [], 1)]
    rows += [(2004, [None] + [1.0] * 7, 1), (2005, rows[0][1], None), (2006, [1.0, 2.0], 1)]
    rows += [(2007, [2.0, 4.0], 1), (5, rows[5][1], 0), (None, rows[0][1], 0)]
    rows += [(2008, [float("inf")] * 8, 1)]
    return rows


@pytest.mark.parametrize("cells", [1, 6])
def test_embeddings(spark, cells, monkeypatch):
    rows = vectors()
    real = embedding_dedup.spherical_kmeans
    monkeypatch.setattr(
        embedding_dedup, "spherical_kmeans", lambda x, k, seed: real(x, min(cells, len(x)), seed=seed)
    )
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    table = table.selectExpr("*", "1 AS x", "2 AS h1", "3 AS cell", "4 AS copies")
    got = embedding_dedup.near_duplicates(table, block=64).collect()
    usable = lambda v: bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
    xs = [np.array(r[1], np.float32).astype(float) if usable(r[1]) else None for r in rows]

    def linked(i, j):
        a, b = xs[i], xs[j]
        if a is None or b is None or len(a) != len(b) or rows[i][2] is None or rows[i][2] != rows[j][2]:
            return False
        return i != j and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.93

    n = len(rows)
    root = closure(n, linked)
    least = {}
    for r, row in zip(root, rows):
        if row[0] is not None:
            least[r] = min(least.get(r, row[0]), row[0])
    want = sorted(
        (str(rows[i][0]), sum(linked(i, j) for j in range(n)), str(least.get(root[i]))) for i in range(n)
    )
    assert want == sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in got)
    assert max(w[1] for w in want) > 20
    assert all(r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id is not None)


def test_empty(spark, empty):
    assert simhash.near_duplicates(empty).collect() == []
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_dedup.near_duplicates(none).collect() == []


def near_copies():
    """Texts with copies of every similarity around 0.8, and a line that many documents hold."""
    rng = random.Random(8)
    text = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    line, rows = text(12), []
    for g in range(12):
        base = text(rng.choice([30, 100, 300]))
        for changes in (0, 1, 1, 2, 3, 4, 6, 8):
            copy = list(base)
            for at in rng.sample(range(len(base)), changes * len(base) // 100 + (changes > 0)):
                copy[at] = f"x{rng.randrange(10**6)}"
            rows.append(" ".join((line if g % 2 else []) + copy))
    big = text(60)
    for _ in range(60):
        at = rng.randrange(60)
        rows.append(" ".join([*big[:at], f"y{rng.randrange(10**6)}", *big[at + 1 :]]))
    rows += ["", None, " ", "a b", "A  B", "a b c"]
    return [(i, t, "en", "s", 1) for i, t in enumerate(rows)]


@pytest.mark.parametrize(("hot", "cold", "block"), [(8, 24, 512), (1, 24, 512), (8, 2, 3)])
def test_pipeline_finds_near_copies_at_the_cut(spark, monkeypatch, hot, cold, block):
    """With pairs as rows, and with tiles for shingles of more than two documents."""
    monkeypatch.setattr(shingle_sets, "COLD", cold)
    monkeypatch.setattr(shingle_sets, "BLOCK", block)
    monkeypatch.setattr(shingle_sets, "HOT", hot)
    monkeypatch.setattr(shingle_sets, "SAMPLE", 8 if hot > 1 else 1)
    rows = near_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    sets = []
    for r in rows:
        words = (r[1] or "").lower().split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))})
    alike = [[len(a & b) >= 0.8 * len(a | b) for b in sets] for a in sets]
    root = closure(len(rows), lambda i, j: alike[i][j])
    got = {r.doc_id: r.component_id for r in shingle_sets.near_duplicates(docs).collect()}
    assert got == dict(enumerate(root))
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(root))


def test_pipeline_keeps_one_row_of_each_group(spark):
    rng = random.Random(5)
    text = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(40))
    a, b, c, d = text(), text(), text(), text()
    rows = [(None, a), (1, b), (None, b), (None, b), (2, c), (2, c), (2, d), (None, None), (None, "")]
    docs = spark.createDataFrame(
        [(i, t, "en", None, n) for n, (i, t) in enumerate(rows)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()
    got = sorted((str(r.doc_id), r.text or "") for r in kept)
    assert got == sorted([("None", a), ("1", b), ("2", c), ("2", d), ("None", "")])


def below_the_cut(n):
    """Documents of one base with 4 % of the words changed: no two are alike, all share shingles."""
    rng = random.Random(9)
    base = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    rows = []
    for i in range(n):
        words = list(base)
        for at in rng.sample(range(300), 12):
            words[at] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words), "en", "s", 0))
    return rows


def test_groups_below_the_cut_make_no_pairs(spark, monkeypatch):
    """Rows that go from stage to stage grow with the group and not with its square."""
    written = {}

    def counted(df, name):
        out = stage(df, name)
        written[name] = written.get(name, 0) + (len(out.head(1)) and out.count())
        return out

    stage = shingle_sets.stage
    monkeypatch.setattr(shingle_sets, "stage", counted)
    sizes = {}
    for n in (80, 240):
        written.clear()
        docs = spark.createDataFrame(below_the_cut(n), "doc_id long, text string, lang string, source string, n_chars long")
        got = shingle_sets.near_duplicates(docs).collect()
        assert all(r.doc_id == r.component_id for r in got) and len(got) == n
        sizes[n] = dict(written)
    assert all(sizes[240][k] <= 4.5 * max(sizes[80][k], 100) for k in sizes[240])
    assert sizes[240]["close"] < 240


def test_shingle_sets_of_odd_rows(odd, odd_rows, empty):
    clash = odd.selectExpr("*", *[f"'?' AS `{c}`" for c in ("set", "made", "prefix", "sketch", "n", "doc", "a.b")])
    clash = clash.drop("n").selectExpr("*", "1 AS n")
    got = shingle_sets.near_duplicates(clash)
    assert got.columns == [*clash.columns, "component_id"]
    assert got.count() == len(odd_rows)
    assert shingle_sets.first_rows(clash).columns == clash.columns
    assert shingle_sets.near_duplicates(empty).count() == shingle_sets.first_rows(empty).count() == 0


def test_blocks_against_pairs():
    """Sketches compared in blocks pass the same pairs as one by one."""
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 1 << 63, rng.integers(1, 90), dtype=np.uint64)) for _ in range(12)]
    for i in range(30):
        base = sets[rng.integers(0, 12)]
        extra = rng.integers(0, 1 << 63, rng.integers(0, 12), dtype=np.uint64)
        sets.append(np.unique(np.concatenate([base[rng.random(len(base)) < 0.9], extra, base[:1]])))
    block = {
        "set": np.arange(len(sets)), "n": np.array(list(map(len, sets))),
        "root": rng.integers(0, 30, len(sets)), "sketch": [shingle_sets.sketch(x) for x in sets],
    }
    a, b = shingle_sets.close_in_blocks(block, block, True, 0.8)
    n, root, sketch = block["n"], block["root"], block["sketch"]
    want = {
        (i, j) for i in range(len(sets)) for j in range(i + 1, len(sets))
        if root[i] != root[j] and min(n[i], n[j]) >= 0.8 * max(n[i], n[j]) - 1e-9
        and shingle_sets.differing(sketch[i], sketch[j]) <= shingle_sets.apart(n[i], n[j], 0.8)
    }
    assert set(zip(a.tolist(), b.tolist(), strict=True)) == want and len(a) == len(want) > 10
    true = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if root[i] != root[j]
            and len(np.intersect1d(sets[i], sets[j])) >= 0.8 * len(np.union1d(sets[i], sets[j]))}
    assert true <= want


def test_pipeline_mixing_without_ids(spark):
    """Rows without an id are taken each for itself, so the mix meets its targets."""
    rng = random.Random(6)
    rows = [
        (None if s == "a" else 100 * k + i, " ".join(f"w{rng.randrange(999)}" for _ in range(10 + i % 7)), "en", s, 0)
        for k, s in enumerate("abc") for i in range(40)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    own = docs.withColumn("doc_id", F.xxhash64("doc_id", "text", "lang", "source"))
    wanted = {r.source: r.taken for r in mixing.mix(own).groupBy("source").agg(F.sum("taken").alias("taken")).collect()}
    mixed = corpus_pipeline.mix_sources(spark, docs, "")
    sizes = mixed.groupBy("source").agg(F.sum(F.size(F.split("text", " "))).alias("words")).collect()
    assert {r.source: r.words for r in sizes} == wanted


def test_vectors_of_any_size(spark):
    """Components whose squares vanish or overflow, and denormal ones, link as their direction says."""
    rng = np.random.default_rng(8)
    rows = []
    for i in range(120):
        x = rng.normal(size=8) if i % 3 else np.array(rows[-1][1]) / np.abs(rows[-1][1]).max() if rows else rng.normal(size=8)
        x = x + rng.normal(size=8) * 0.05
        rows.append((i, (x * [1.0, 1e-200, 1e200, 1e-310][i % 4]).tolist(), 0))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r.n_links for r in embedding_dedup.near_duplicates(frame).collect()}
    unit = [np.array(x) / np.abs(x).max() for _, x, _ in rows]
    unit = np.array([x / np.linalg.norm(x) for x in unit])
    links = (unit @ unit.T >= 0.93).sum(1) - 1
    assert got == dict(enumerate(links.tolist())) and links.sum() > 40


def test_prefixes_and_sketches_are_stored_once(spark):
    """They do not compress, so the rows beside the texts have none."""
    docs = spark.createDataFrame([(1, "a b c d e f g"), (2, "a b c d e f g"), (3, None)], "doc_id long, text string")
    rows, named = shingle_sets._named(docs, 5, 0.8)
    assert rows.columns == ["doc", "row", "set"]
    assert rows.count() == 3 and named.count() == 2


def test_tokens_of_a_batch_come_in_parts(monkeypatch):
    """A batch is as large as the session lets it be; what is made of it is bounded, and whole."""
    monkeypatch.setattr(shingle_sets, "PART", 800)
    rng = np.random.default_rng(3)
    prefixes = [rng.integers(0, 1 << 62, n) for n in [*range(40), 500, 0, 0, 3]]
    batch = pd.DataFrame({"set": np.arange(44), "n": np.arange(44) * 3, "prefix": [x.tobytes() for x in prefixes]})
    parts = list(shingle_sets.tokens([batch, batch.iloc[:0], batch.iloc[40:42]]))
    assert len(parts) > 5 and sorted(map(len, parts))[-3] < 2 * 100
    got = pd.concat(parts).to_numpy().tolist()
    rows = [*range(44), 40, 41]
    assert got == [[t, i, i * 3 << 32 | at] for i in rows for at, t in enumerate(prefixes[i].tolist())]


def test_pipeline_links_by_fingerprints_too(spark):
    """Copies below the cut whose fingerprints are within four bits are one group, as are those
    at the cut with fingerprints further apart; all others stay."""
    rng = random.Random(12)

    def mark(words):
        if not words:
            return 0
        hashes = [xxhash.xxh64(" ".join(words[i : i + 5]).encode(), seed=42).intdigest() for i in range(max(1, len(words) - 4))]
        return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))

    texts = [[], ["one"], ["one", "two"]]
    for n in (100, 240, 500):
        for _ in range(3):
            base = [f"w{rng.randrange(10**6)}" for _ in range(n)]
            texts.append(base)
            for changes in [*range(1, 4), *[n * 3 // 100 + 1] * 15]:
                copy = list(base)
                for at in rng.sample(range(n), changes):
                    copy[at] = f"x{rng.randrange(10**6)}"
                texts.append(copy)
    # the same set of shingles, unlike numbers of them: one set with two fingerprints
    ring = [f"r{i}" for i in range(40)]
    texts += [ring * 2 + ring[:4], ring * 2 + ring[:30], ring[:20] * 9]
    sets = [{tuple(t[i : i + 5]) for i in range(max(1, len(t) - 4))} for t in texts]
    fps = [mark(t) for t in texts]
    alike = lambda i, j: len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])
    near = lambda i, j: bin(fps[i] ^ fps[j]).count("1") <= 4
    by_sets = closure(len(texts), alike)
    root = closure(len(texts), lambda i, j: alike(i, j) or near(i, j))
    assert len(set(root)) <= len(set(by_sets)) - 3 and len(set(root)) <= len(set(closure(len(texts), near))) - 3
    docs = spark.createDataFrame(
        [(i, " ".join(t) or None, "en", "s", 0) for i, t in enumerate(texts)],
        "doc_id long, text string, lang string, source string, n_chars long",
    ).repartition(5)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(root))
    got = {r.doc_id: r.component_id for r in shingle_sets.near_duplicates(docs, radius=4).collect()}
    assert got == dict(enumerate(root))
    got = {r.doc_id: r.component_id for r in shingle_sets.near_duplicates(docs).collect()}
    assert got == dict(enumerate(by_sets))
