"""Manifest: roots, proofs and folds against a plain version; parts of a proof set; odd rows."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from mailtally.llm import merkle

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    texts = [None if v is None else str(v) for v in row]
    return h(*["-" if t is None else f"{len(t.encode())}:{t}" for t in texts])


def tree(nodes, fanout):
    levels = [nodes]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([h(*now[i : i + fanout]) for i in range(0, len(now), fanout)])
    return levels


def siblings(levels, at, fanout):
    out = []
    for nodes in levels[:-1]:
        first = at - at % fanout
        run = nodes[first : first + fanout]
        out.append((run[: at - first], run[at - first + 1 :]))
        at //= fanout
    return out


def plain(rows, fanout):
    """Counter of (doc_id, leaf, subroot, root, proof digest)."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, leaf(row), row[0]))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(groups[s], key=lambda x: x[:3])], fanout) for s in order}
    top = tree([trees[s][-1][0] for s in order], fanout)
    out = Counter()
    for place, s in enumerate(order):
        for at, (_, _, digest, doc_id) in enumerate(sorted(groups[s], key=lambda x: x[:3])):
            way = siblings(trees[s], at, fanout) + siblings(top, place, fanout)
            proof = h(*[d for left, right in way for d in left + right])
            out[doc_id, digest, trees[s][-1][0], top[-1][0], proof] += 1
    return out


def manifest_of(docs, fanout):
    digest = merkle.digest(*map(F.col, FIELDS))
    return merkle.build(docs.select("doc_id", "source", digest.alias("leaf")), fanout)


def found(manifest, wanted=None):
    rows = merkle.prove(manifest, wanted).select(
        "doc_id", "leaf", "subroot", merkle.proof_digest(F.col("path")).alias("proof"),
        merkle.fold(F.col("leaf"), F.col("path")).alias("folded"),
    ).collect()
    assert all(r.folded == manifest.root for r in rows)
    return Counter((r.doc_id, r.leaf, r.subroot, manifest.root, r.proof) for r in rows)


@pytest.mark.parametrize("fanout", [2, 3, 16])
def test_odd_rows(odd, odd_rows, fanout):
    rows = [(i, s, lang, n, t) for i, t, lang, s, n in odd_rows]
    assert found(manifest_of(odd, fanout)) == plain(rows, fanout)


@pytest.mark.parametrize("sizes", [[1], [1, 1], [2], [16], [17], [256, 1, 257], [1] * 40])
def test_sizes(spark, sizes):
    rows = [(1000 * s + i, f"s{s}", "en", i, "x" * (i % 3)) for s, n in enumerate(sizes) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert found(manifest_of(docs, 16)) == plain(rows, 16)


def test_repeated_rows(spark):
    rows = [(None, None, None, None, "a")] * 70 + [(3, None, "", 0, "")] * 2 + [(3, "", None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert found(manifest_of(docs, 4)) == plain(rows, 4)


def test_wanted_leaves_only(spark, odd):
    manifest = manifest_of(odd, 2)
    every = found(manifest)
    some = manifest.leaves.where("doc_id in (3, 9, 20)")
    part = found(manifest, some)
    assert part == Counter({k: n for k, n in every.items() if k[0] in (3, 9, 20)})


def test_no_rows(empty):
    manifest = manifest_of(empty, 16)
    assert manifest.root is None
    assert merkle.prove(manifest).count() == 0


def test_changed_text_is_found(odd):
    manifest = manifest_of(odd.where("doc_id < 20"), 16)
    changed = merkle.digest(*[F.lit(x) for x in (8, "s1", "en", 3, "other")])
    rows = merkle.prove(manifest).select("doc_id", merkle.fold(changed, F.col("path")).alias("folded"))
    assert rows.where(F.col("folded") == manifest.root).count() == 0


def test_hot_source_is_spread(spark):
    """Ranks of one source come from several ranges."""
    docs = spark.range(20_000, numPartitions=8).select(
        F.col("id").alias("doc_id"), F.lit("one").alias("source"), F.sha2(F.col("id").cast("string"), 256).alias("leaf")
    )
    manifest = merkle.build(docs)
    got = manifest.leaves.agg(F.count_distinct("rank"), F.min("rank"), F.max("rank")).first()
    assert tuple(got) == (20_000, 0, 19_999)
    assert manifest.leaves.where("rank != doc_id").count() == 0
