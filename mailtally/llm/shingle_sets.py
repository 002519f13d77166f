"""Near-duplicates by the Jaccard similarity of word shingles, exact for all pairs.

SimHash fingerprints of texts that share 80 % of their shingles differ in about ten bits of
64, too many for tiles to skip anything. So pairs are found by a prefix filter. The
shingles of a document are put in one order for all; two sets of similarity ``t`` or more
share a shingle among the first ``n - ceil(t * n) + 1`` of each. Pairs that do are compared
by sketches: of each slice of the hashes one byte, their sum. Slices that differ hold shingles
that only one of the two has, so pairs with too many of them are dropped without a look at
their texts. The rest is compared by full sets, made once for each text that needs it.

Any order gives the same pairs. Shingles come in the order of their number in a sample, so
that a line of many documents is in few prefixes. Groups of near copies share their shingles all
the same; there each document is first compared with one chosen document of the group and
with its neighbour. Only documents that are not connected by then are compared pair by pair,
so components are those of all pairs.

Pairs become rows only below shingles of at most ``COLD`` open documents. They are counted over
their common shingles, and dropped if so many are missing between the common ones that the
similarity is out of reach. The documents of a more frequent shingle are cut into blocks of
like lengths, and numpy compares the sketches of two blocks at a time; only pairs that pass
become rows. So rows grow in proportion to a group, and a comparison costs well below a
microsecond; their number is the square of the documents with one rare shingle in common, like
lengths and no connection.

Fingerprints within a few bits link texts that similarity does not, such as long copies just
below the cut. With a ``radius`` those links of ``simhash`` count as well, between fingerprints
of the same shingles; sets that they join are not compared again.

Defined cases: fewer words than a shingle make one shingle; null texts and texts without
words are copies of each other; letters A-Z are lowered. Each row of the input is a document
of its own; a null id is never the smallest of a component that has another. Empty tables
give no rows. "Equal" means equal 64-bit hashes of shingles and of sets.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import product

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mailtally.llm import simhash
from mailtally.llm.common import stage
from mailtally.llm.components import components
from mailtally.llm.simhash import SEED, word_hashes

SAMPLE, HOT, MOST_HOT = 16, 3, 200_000
#: Open documents of a shingle up to which their pairs are rows; sets and bytes of a block beyond.
COLD, BLOCK, BLOCK_BYTES = 64, 512, 1 << 18
TILE = 1 << 24  # bytes compared at a time
PART = 1 << 20  # bytes of a batch that are worked on at a time


def shingles(text: str | None, words: int) -> np.ndarray:
    """The distinct hashes of a text's shingles, in ascending order."""
    return np.unique(word_hashes(text, words)).astype("<u8")


def prefix(found: np.ndarray, similarity: float, common: np.ndarray, often: np.ndarray) -> np.ndarray:
    """The first shingles of a set in the order of all: by their number in the sample, then hash."""
    n = len(found)
    if len(common):
        at = np.minimum(np.searchsorted(common, found), len(common) - 1)
        found = found[np.argsort(np.where(common[at] == found, often[at], 0), kind="stable")]
    return found[: n - int(np.ceil(similarity * n - 1e-9)) + 1] if n else found


def sketch(found: np.ndarray) -> bytes:
    """One byte of each slice of the hashes; half as many slices as shingles at least."""
    bits = max(6, len(found).bit_length() - 1)
    value = (found >> np.uint64(8) & np.uint64(255) | np.uint64(1)).astype(np.int64)
    slices = (found >> np.uint64(64 - bits)).astype(np.int64)
    return np.bincount(slices, value, 1 << bits).astype(np.int64).astype(np.uint8).tobytes()


def folded(sketches: list[bytes], slices: int) -> np.ndarray:
    """Sketches as rows of a matrix, in so many slices."""
    rows = np.stack([np.frombuffer(x, np.uint8) for x in sketches])
    return rows.reshape(len(rows), slices, -1).sum(2, dtype=np.uint8)


def differing(x: bytes, y: bytes) -> int:
    """In how many slices two sketches differ; the finer one is folded to the other's slices."""
    n = min(len(x), len(y))
    return int((folded([x], n) != folded([y], n)).sum())


def apart(n: np.ndarray, m: np.ndarray, similarity: float) -> np.ndarray:
    """How many shingles sets of ``n`` and ``m`` may have alone at most."""
    return (1 - similarity) / (1 + similarity) * (n + m) + 1e-6


def close_in_blocks(
    left: dict, right: dict, same: bool, similarity: float, token: int | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """The sets of two blocks (set, n, root, sketch) whose sketches allow the similarity and
    whose roots differ. Of one block with itself, each pair once. With a ``token``, only pairs
    of which it is the least that both have among their ``tokens``."""
    out: tuple[list, list] = ([], [])
    of_left, of_right = ([len(x) for x in side["sketch"]] for side in (left, right))
    if token is not None:
        own, others = ([set(x.tolist()) for x in side["tokens"]] for side in (left, right))
    for u, v in product(np.unique(of_left), np.unique(of_right)):
        i, j = np.flatnonzero(of_left == u), np.flatnonzero(of_right == v)
        slices = int(min(u, v))
        x = folded([left["sketch"][k] for k in i], slices)
        y = folded([right["sketch"][k] for k in j], slices)
        n, m = left["n"][i][:, None], right["n"][j]
        fit = np.minimum(n, m) >= similarity * np.maximum(n, m) - 1e-9
        fit &= left["root"][i][:, None] != right["root"][j]
        if same:
            fit &= left["set"][i][:, None] < right["set"][j]
        most = apart(n, m, similarity)
        step = max(1, TILE // y.size)
        for at in range(0, len(i), step):
            part = slice(at, at + step)
            if fit[part].any():
                far = np.count_nonzero(x[part, None] != y, axis=2)
                a, b = np.nonzero(fit[part] & (far <= most[part]))
                a, b = i[a + at], j[b]
                if token is not None:
                    both = zip(a.tolist(), b.tolist(), strict=True)
                    first = [min(own[k] & others[z]) == token for k, z in both]
                    a, b = a[first], b[first]
                out[0].append(left["set"][a])
                out[1].append(right["set"][b])
    if not out[0]:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b = map(np.concatenate, out)
    return np.minimum(a, b), np.maximum(a, b)


def common_shingles(docs: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of many documents in the sample, at most ``MOST_HOT``, and how often they occur
    there; a hint for speed only."""

    def run(batches):
        for pdf in batches:
            for text in pdf["text"]:
                yield pd.DataFrame({"token": shingles(text, words).view("i8")})

    sample = docs.where(F.pmod(F.xxhash64(F.lit(1), "text"), F.lit(SAMPLE)) == 0)
    counted = (
        sample.select("text")
        .mapInPandas(run, "token long")
        .groupBy("token")
        .count()
        .where(F.col("count") >= HOT)
        .orderBy(F.col("count").desc(), "token")
        .limit(MOST_HOT)
    )
    rows = [(r.token & (1 << 64) - 1, r["count"]) for r in counted.collect()]
    tokens, often = zip(*sorted(rows), strict=True) if rows else ((), ())
    return np.array(tokens, "u8"), np.array(often, np.int64)


def in_tiles(hot: DataFrame, similarity: float) -> DataFrame:
    """(a, b): pairs among the sets of each token that their sketches allow.

    ``hot`` has token, set, n, root and sketch. A token's sets are dealt to classes of like
    lengths, of which only neighbours can pair, and each class to blocks of a bounded number
    of sets and bytes. A set carries its tokens (at most its prefix), so that a pair comes out
    of one tile only, however many tokens it shares.
    """
    length = F.floor(F.log("n") / -np.log(similarity)).cast("int")
    tokens = hot.groupBy("set").agg(F.collect_set("token").alias("tokens"))
    placed = hot.join(tokens, "set").withColumn("length", length)
    sizes = placed.groupBy("token", "length").agg(
        F.greatest(
            F.ceil(F.count("*") / BLOCK), F.ceil(F.sum(F.octet_length("sketch")) / BLOCK_BYTES)
        ).alias("slots")
    )
    slot = F.pmod(F.xxhash64("set"), F.col("slots")).cast("int")
    columns = ["set", "n", "root", "sketch", "tokens"]
    blocks = stage(
        placed.join(sizes, ["token", "length"])
        .groupBy("token", "length", slot.alias("slot"))
        .agg(F.collect_list(F.struct(*columns)).alias("rows"))
        .select("token", "length", "slot", *[F.col(f"rows.{c}").alias(c) for c in columns]),
        "blocks",
    )
    index = blocks.select("token", "length", "slot")
    other = index.select("token", F.col("length").alias("length2"), F.col("slot").alias("slot2"))
    pairs = (
        index.withColumn("length2", F.explode(F.array(F.col("length"), F.col("length") + 1)))
        .join(other, ["token", "length2"])
        .where("length != length2 or slot <= slot2")
    )
    right = blocks.select(
        "token",
        F.col("length").alias("length2"),
        F.col("slot").alias("slot2"),
        *[F.col(c).alias(f"{c}2") for c in columns],
    )
    both = pairs.join(blocks, ["token", "length", "slot"]).join(right, ["token", "length2", "slot2"])
    same = (F.col("length") == F.col("length2")) & (F.col("slot") == F.col("slot2"))

    def compare(batches):
        for pdf in batches:
            for row in pdf.to_dict("records"):
                sides = ({c: row[c + end] for c in columns} for end in ("", "2"))
                a, b = close_in_blocks(*sides, row["same"], similarity, row["token"])
                if len(a):
                    yield pd.DataFrame({"a": a, "b": b})

    names = [c + end for end in ("", "2") for c in columns]
    return both.select("token", *names, same.alias("same")).mapInPandas(compare, "a long, b long")


def portions(batch: pd.DataFrame, column: str) -> Iterator[pd.DataFrame]:
    """The rows of a batch, each once and in order, in parts of ``PART`` bytes of a column.

    A part ends with the row that reaches them. What is made of a batch is several times
    its size, and a batch holds as much as the session lets it.
    """
    sizes = np.array([len(x) if x is not None else 0 for x in batch[column]], np.int64)
    for _, part in batch.groupby((np.cumsum(sizes) - sizes) // PART, sort=False):
        yield part


def tokens(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(token, set, n_at): a row for each shingle of a set's prefix, with the set's size and
    the shingle's place in one number."""
    for batch in batches:
        for pdf in portions(batch, "prefix"):
            found = [np.frombuffer(x, "i8") for x in pdf["prefix"]]
            sizes = np.array([len(x) for x in found], np.int64)
            at = np.concatenate([np.arange(n) for n in sizes])
            n = np.repeat(pdf["n"].to_numpy(), sizes)
            names = np.repeat(pdf["set"].to_numpy(), sizes)
            yield pd.DataFrame({"token": np.concatenate(found), "set": names, "n_at": n << 32 | at})


def fingerprint_links(marked: DataFrame, radius: int) -> DataFrame:
    """(a, b): links that join the sets whose fingerprints are within ``radius`` bits.

    ``marked`` has ``set`` and ``fp`` of rows. Texts of one set may differ in their repeats and
    so in their fingerprints; the set links with what any of them links with.
    """
    marked = stage(marked.distinct(), "fingerprints")
    roots = components(simhash.links(marked.select("fp").distinct(), radius)).withColumnRenamed("node", "fp")
    rooted = marked.join(roots, "fp", "left").select("set", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("set").alias("least"))
    found = rooted.join(least, "root").where("set != least")
    return stage(found.select(F.col("set").alias("a"), F.col("least").alias("b")), "near")


def links(
    rows: DataFrame, classes: DataFrame, words: int, similarity: float, known: DataFrame | None = None
) -> DataFrame:
    """(a, b): links that join the same sets as all pairs of ``similarity`` or more do, and
    the ``known`` ones.

    ``classes`` has distinct values in ``set``, and of each set ``n``, ``prefix``, ``sketch``
    and the number of a row in ``rows``, ``head.row``.
    """

    def differ(batches):
        for pdf in batches:
            most = apart(pdf["n"].to_numpy(), pdf["m"].to_numpy(), similarity)
            far = [differing(x, y) for x, y in zip(pdf["left"], pdf["right"], strict=True)]
            yield pdf.loc[np.array(far, float) <= most, ["a", "b"]]

    def whole(batches):
        for batch in batches:
            for pdf in portions(batch, "text"):
                made = [shingles(t, words).tobytes() for t in pdf["text"]]
                yield pd.DataFrame({"set": pdf["set"], "whole": made})

    def compare(batches):
        for pdf in batches:
            keep = []
            for left, right in zip(pdf["left"], pdf["right"], strict=True):
                x, y = np.frombuffer(left, "u8"), np.frombuffer(right, "u8")
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both >= similarity * (len(x) + len(y) - both) - 1e-9)
            yield pdf.loc[np.array(keep, bool), ["a", "b"]]

    def sketched(pairs: DataFrame) -> DataFrame:
        """The pairs whose sketches allow the similarity."""
        left = classes.select(F.col("set").alias("a"), F.col("sketch").alias("left"), "n")
        right = classes.select(F.col("set").alias("b"), F.col("sketch").alias("right"), F.col("n").alias("m"))
        return pairs.join(left, "a").join(right, "b").mapInPandas(differ, "a long, b long")

    def verified(close: DataFrame) -> DataFrame:
        """The pairs whose whole sets have it; those are made once for each text."""
        close = stage(close, "close")
        sets = close.select(F.col("a").alias("set")).union(close.select("b")).distinct()
        heads = classes.join(sets, "set", "left_semi").select(F.col("head.row").alias("row"))
        texts = rows.join(heads, "row", "left_semi").select("set", "text")
        made = stage(texts.mapInPandas(whole, "set long, whole binary"), "whole")
        left = made.select(F.col("set").alias("a"), F.col("whole").alias("left"))
        right = made.select(F.col("set").alias("b"), F.col("whole").alias("right"))
        both = close.join(left, "a").join(right, "b").select("a", "b", "left", "right")
        return stage(both.mapInPandas(compare, "a long, b long"), "alike")

    def fits(n, m):
        return F.least(n, m) >= similarity * F.greatest(n, m) - 1e-9

    n, at = F.shiftright("n_at", 32), F.col("n_at").bitwiseAND(F.lit((1 << 32) - 1))
    along = Window.partitionBy("token").orderBy("set")
    one = F.struct("set", "n_at")
    shared = stage(
        classes.select("set", "n", "prefix")
        .mapInPandas(tokens, "token long, set long, n_at long")
        .withColumn("chosen", F.first(one).over(along))
        .withColumn("before", F.lag(one).over(along))
        .withColumn("after", F.lead("set").over(along))
        .where("before is not null or after is not null")
        .drop("after"),
        "shared",
    )
    near = (
        shared.where("before is not null")
        .select("set", n.alias("n"), F.explode(F.array("chosen", "before")).alias("other"))
        .where(fits(F.col("n"), F.shiftright("other.n_at", 32)))
        .select(F.least("set", "other.set").alias("a"), F.greatest("set", "other.set").alias("b"))
        .distinct()
    )
    near = stage(near, "pairs")
    first = verified(sketched(near))
    first = first if known is None else first.union(known)
    roots = components(first).withColumnRenamed("node", "set")
    open_ = shared.select("token", "set", n.alias("n"), at.alias("at")).join(roots, "set", "left")
    open_ = open_.withColumn("root", F.coalesce("root", "set"))
    several = open_.groupBy("token").agg(
        F.min("root").alias("r"), F.max("root").alias("s"), F.count("*").alias("sharers")
    )
    open_ = stage(open_.join(several.where("r != s").select("token", "sharers"), "token"), "open")
    cold, x, y = open_.where(F.col("sharers") <= COLD), F.col("x.n"), F.col("y.n")
    common = similarity / (1 + similarity) * (F.col("n") + F.col("m")) - 1e-6
    behind = F.least(F.col("n") - F.col("i"), F.col("m") - F.col("j")) - 1
    rest = (
        cold.alias("x")
        .join(cold.alias("y"), F.expr("x.token = y.token and x.set < y.set and x.root != y.root"))
        .where(fits(x, y))
        .groupBy(F.col("x.set").alias("a"), F.col("y.set").alias("b"))
        .agg(
            F.count("*").alias("shared"), F.max("x.at").alias("i"), F.max("y.at").alias("j"),
            F.max(x).alias("n"), F.max(y).alias("m"),
        )
        .where(F.col("shared") + behind >= common)
        .select("a", "b")
    )
    hot = open_.where(F.col("sharers") > COLD).select("token", "set", "n", "root")
    dense = in_tiles(hot.join(classes.select("set", "sketch"), "set"), similarity)
    other = sketched(rest).union(dense).distinct().join(near, ["a", "b"], "left_anti")
    return first.union(verified(other))


def _named(
    docs: DataFrame, words: int, similarity: float, radius: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` with their number and set, and (set, head, component): ``head``
    is the first row of a set, by id and number, null ids last."""

    common, often = common_shingles(docs, words)

    @F.pandas_udf("set long, fp long")
    def name_of(texts: pd.Series) -> pd.DataFrame:
        names, fps = [], []
        for t in texts:
            found = word_hashes(t, words)
            names.append(xxhash.xxh64_intdigest(np.unique(found).astype("<u8").tobytes(), SEED))
            fps.append(simhash.majority(found) if radius is not None else 0)
        return pd.DataFrame({"set": np.array(names, np.uint64).view("i8"), "fp": np.array(fps, np.int64)})

    @F.pandas_udf("n long, prefix binary, sketch binary")
    def of(texts: pd.Series) -> pd.DataFrame:
        out = []
        for t in texts:
            found = shingles(t, words)
            out.append((len(found), prefix(found, similarity, common, often).tobytes(), sketch(found)))
        rest = zip(*out, strict=True) if out else [()] * 3
        return pd.DataFrame(dict(zip(("n", "prefix", "sketch"), rest, strict=True)))

    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    numbered = docs.select(whole, F.monotonically_increasing_id().alias("row"))
    # prefixes and sketches do not compress: made once more from the texts, they are stored
    # in the sets only
    named = numbered.withColumn("named", name_of("doc.text")).select("doc", "row", "named.*")
    marked = stage(named, "shingles")
    rows = marked.drop("fp")
    made = rows.withColumn("made", of("doc.text")).select("doc.doc_id", "row", "set", "made.*")
    head = F.struct(F.isnull("doc_id").alias("no_id"), F.col("doc_id"), "row")
    least = F.min(F.struct(head.alias("head"), "n", "prefix", "sketch")).alias("least")
    classes = stage(made.groupBy("set").agg(least).select("set", "least.*"), "sets")
    texts = rows.select("row", "set", F.col("doc.text").alias("text"))
    known = None if radius is None else fingerprint_links(marked.select("set", "fp"), radius)
    found = links(texts, classes, words, similarity, known)
    roots = components(found).withColumnRenamed("node", "set")
    named = classes.select("set", "head").join(roots, "set", "left")
    return rows, named.select("set", "head", F.coalesce("root", "set").alias("component"))


def near_duplicates(
    docs: DataFrame, words: int = 5, similarity: float = 0.8, radius: int | None = None
) -> DataFrame:
    """The columns of ``docs``, and ``component_id``, the smallest id that is reachable."""
    rows, named = _named(docs, words, similarity, radius)
    heads = named.groupBy("component").agg(F.min("head").alias("least"))
    found = named.join(heads, "component").select("set", F.col("least.doc_id").alias("component_id"))
    return rows.join(found, "set").select("doc.*", "component_id")


def first_rows(
    docs: DataFrame, words: int = 5, similarity: float = 0.8, radius: int | None = None
) -> DataFrame:
    """One row of each component of ``docs``: the one with the smallest id, null ids last."""
    rows, named = _named(docs, words, similarity, radius)
    heads = named.groupBy("component").agg(F.min("head").alias("least"))
    return rows.join(heads.select(F.col("least.row").alias("row")), "row", "left_semi").select("doc.*")
