"""Merkle manifest of a dataset: a content-addressed tree, read by descent from its root.

A leaf is the digest of a row. The leaves of a source, in the order of their ids, are hashed
in runs of ``fanout`` until one node is left; those of all sources, in the order of the
sources, give the root in the same way. Every inner node is stored as a record from its digest
to the digests of its children, and nothing else: records are looked up by content.

Proofs are found from the root. A leaf's place is written in digits to the base ``fanout``; at
every level the digit selects a child, and the children beside it become a segment of the path.
Leaves that share their leading digits descend together, so a level looks up one record for each
of its nodes and not one for each leaf, and the root's record is read once. At the lowest nodes
the leaves join their path. Reversed, its segments are the proof, from the leaf to the root.

Places come from ranges of (source, id), so a source that holds a third of all rows is ranked,
hashed and proved in many tasks; no group is larger than ``fanout`` nodes. The driver knows
the depth of the trees and the root's digest.

Defined cases: a null source is a source, and the first one; null ids come first in theirs. Rows
that share an id are leaves of their own, in the order of their digests; equal rows tie, and
which of them is which cannot be told from the result. Null fields and empty texts have unlike
digests. A tree of one leaf is that leaf, with no siblings; an empty table has no root and gives
no rows. Other columns of the rows are not read, or carried where they are named.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailtally.llm.common import stage
from mailtally.llm.ranks import ranked

HEX = 64  # characters of a digest


def digest(*fields: Column) -> Column:
    """Digest of a row: of each field ``-`` for a null, else its bytes' number, ``:``, its text."""
    texts = [x.cast("string") for x in fields]
    marked = [F.concat(F.octet_length(x).cast("string"), F.lit(":"), x) for x in texts]
    return F.sha2(F.concat(*[F.coalesce(x, F.lit("-")) for x in marked]), 256)


@dataclass
class Manifest:
    """``leaves``: the rows with ``rank`` and ``depth`` in their source. ``records``: (digest,
    children), the children's digests in one text. ``sources``: (place, source, depth). ``depth``
    counts the levels above the sources, ``deepest`` those of the deepest source."""

    leaves: DataFrame
    records: DataFrame
    sources: DataFrame
    root: str | None
    depth: int
    deepest: int
    fanout: int


def _depth(size: str, fanout: int) -> Column:
    """Levels above ``size`` nodes."""
    powers, reach = [], 1
    while reach < 1 << 62:
        powers.append((F.col(size) > reach).cast("int"))
        reach *= fanout
    return sum(powers[1:], powers[0])


def _grow(nodes: DataFrame, fanout: int, name: str) -> tuple[DataFrame, list[DataFrame], int]:
    """Trees over ``nodes`` (tree, at, digest, depth): their top nodes as (tree, digest, depth),
    the records of each level, and the greatest depth."""
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    tops, records = nodes.where("depth = 0").select("tree", "digest", "depth"), []
    for level in range(1, deepest + 1):
        run = F.array_sort(F.collect_list(F.struct("at", "digest")))
        nodes = stage(
            nodes.where(F.col("depth") >= level)
            .groupBy("tree", "depth", F.expr(f"at div {fanout}").alias("at"))
            .agg(F.array_join(F.transform(run, lambda x: x.digest), "").alias("children"))
            .withColumn("digest", F.sha2("children", 256)),
            f"{name}-{level}",
        )
        tops = tops.union(nodes.where(F.col("depth") == level).select("tree", "digest", "depth"))
        records.append(nodes.select("digest", "children"))
    return tops, records, deepest


def build(rows: DataFrame, fanout: int = 16) -> Manifest:
    """The manifest of ``rows``: (doc_id, source, leaf) and any columns that go along."""
    leaves = stage(
        ranked(stage(rows, "leaves"), ["source"], [F.col("doc_id"), F.col("leaf")], "places")
        .withColumn("depth", _depth("size", fanout))
        .drop("size"),
        "ranked",
    )
    first = leaves.select(
        F.col("source").alias("tree"), F.col("rank").alias("at"), F.col("leaf").alias("digest"), "depth"
    )
    tops, records, deepest = _grow(first, fanout, "source-level")
    placed = ranked(
        stage(tops.select(F.col("tree").alias("source"), "digest", "depth"), "tops"),
        [],
        [F.col("source")],
        "sources",
    )
    sources = stage(placed, "placed")
    one = sources.select(
        F.lit(None).cast("string").alias("tree"),
        F.col("rank").alias("at"),
        "digest",
        _depth("size", fanout).alias("depth"),
    )
    top, upper, depth = _grow(one, fanout, "top-level")
    found = top.first()
    every = records + upper
    listed = leaves.sparkSession.createDataFrame([], "digest string, children string")
    for level in every:
        listed = listed.union(level)
    return Manifest(
        leaves,
        stage(listed.dropDuplicates(["digest"]), "records"),
        sources.select(F.col("rank").alias("place"), "source", "depth"),
        found.digest if found else None,
        depth,
        deepest,
        fanout,
    )


def _beside(digit: Column) -> Column:
    """The children left and right of the selected one."""
    return F.struct(
        F.expr("children").substr(F.lit(1), (digit * HEX).cast("int")).alias("left"),
        F.expr("children").substr(((digit + 1) * HEX + 1).cast("int"), F.length("children")).alias("right"),
    )


def _descend(frontier: DataFrame, records: DataFrame, fanout: int) -> DataFrame:
    """One level down: of each node (at, digest, path, ...) its children, with longer paths."""
    rest = [c for c in frontier.columns if c not in ("at", "digest", "path")]
    last = (F.length("children") / HEX).cast("int") - 1
    digit = F.col("digit")
    return (
        frontier.join(records, "digest")
        .withColumn("digit", F.explode(F.sequence(F.lit(0), last)))
        .select(
            *rest,
            (F.col("at") * fanout + digit).alias("at"),
            F.col("children").substr((digit * HEX + 1).cast("int"), F.lit(HEX)).alias("digest"),
            F.concat("path", F.array(_beside(digit))).alias("path"),
        )
    )


def prove(manifest: Manifest, wanted: DataFrame | None = None) -> DataFrame:
    """The leaves with ``subroot`` and ``path``: from the root down, the digests left and right
    of the way.

    ``wanted`` holds some rows of ``manifest.leaves``; the descent then follows their digits only.
    """
    fanout, records = manifest.fanout, manifest.records
    leaves = manifest.leaves if wanted is None else wanted
    if manifest.root is None:
        empty = "array<struct<left:string,right:string>>"
        return leaves.select(
            "*", F.lit(None).cast("string").alias("subroot"), F.lit(None).cast(empty).alias("path")
        )

    def asked(frontier: DataFrame, left: int) -> DataFrame:
        """Nodes with a wanted leaf ``left`` levels below."""
        if wanted is None:
            return frontier
        places = wanted.select(
            F.col("source").alias("its"), F.expr(f"rank div {fanout**left}").alias("place")
        ).distinct()
        same = F.col("source").eqNullSafe(F.col("its")) & (F.col("at") == F.col("place"))
        return frontier.join(places, same, "left_semi")

    spark = leaves.sparkSession
    frontier = spark.createDataFrame(
        [(0, manifest.root, [])],
        "at long, digest string, path array<struct<left:string,right:string>>",
    )
    for _ in range(manifest.depth):
        frontier = stage(_descend(frontier, records, fanout), "descent")
    frontier = frontier.withColumnRenamed("at", "place").join(manifest.sources, "place")
    if wanted is not None:
        its = wanted.select(F.col("source").alias("its")).distinct()
        frontier = frontier.join(its, F.col("source").eqNullSafe(F.col("its")), "left_semi")
    frontier = frontier.select(
        "source", "depth", F.lit(0).cast("long").alias("at"), "digest", "path",
        F.col("digest").alias("subroot"),
    )
    for left in range(manifest.deepest, 1, -1):
        frontier = stage(frontier, "descent")
        now = _descend(frontier.where(F.col("depth") >= left), records, fanout)
        now = asked(now, left - 1)
        frontier = now.unionByName(frontier.where(F.col("depth") < left))
    lowest = frontier.join(records, "digest", "left").select(
        F.col("source").alias("its"), F.col("at").alias("parent"), "subroot", "path", "children"
    )
    digit = F.col("rank") % fanout
    path = F.when(F.col("depth") == 0, F.col("path")).otherwise(
        F.concat("path", F.array(_beside(digit)))
    )
    parent = F.expr(f"rank div {fanout}")
    met = F.col("source").eqNullSafe(F.col("its")) & (parent == F.col("parent"))
    return leaves.join(lowest, met).select(*leaves.columns, "subroot", path.alias("path"))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings, from the leaf's level to the root's, left to right."""
    beside = F.transform(F.reverse(path), lambda x: F.concat(x.left, x.right))
    return F.sha2(F.array_join(beside, ""), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its path give."""
    return F.aggregate(
        F.reverse(path), leaf, lambda node, x: F.sha2(F.concat(x.left, node, x.right), 256)
    )
