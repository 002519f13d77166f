"""Exact removal of passages that repeat, for sequences of bytes or of words.

A window of ``length`` tokens is removed from a document if it also begins earlier. All jobs
work on anchors (see anchors.py), and what they exchange is packed into one binary per
target, so that rows stay few and numpy does the work:

1. ``mark``: chunks of documents give the anchors of all windows. Of equal contexts within a
   chunk only the earliest goes on; the windows of the others are settled on the spot.
2. ``settle``: one bucket of anchors at a time. Of equal contexts all but the earliest are
   settled as a whole, by the names (hashes) of their contexts and without their text. A
   context that is alone with its anchor is unique. What is left are anchors that stand in
   unlike contexts: there a repeat may begin or end within the context.
3. ``ask``: the windows of those contexts are hashed where the documents are. Again only the
   earliest of a chunk goes on.
4. ``answer``: one bucket of windows at a time, all but the earliest are settled.
5. ``cut``: the settled windows meet the documents, which yield what remains.

Texts move once: both steps that need them deal documents out alike, in one query, and Spark
reuses the exchange. Buckets and shards grow in number with the bytes of the table.

Hot anchors. An anchor that stands in very many contexts (the border of a passage that a
third of all documents holds) would make its bucket large. A sample of one in ``SAMPLE``
documents finds such anchors; their contexts are dealt out by the context, and all of them
are asked for. That list is a hint for speed only, the answer does not depend on it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailtally.llm import anchors
from mailtally.llm.anchors import Tokens
from mailtally.llm.common import stage

CHUNK, SHARD = 1_000_000, 6_000_000  # bytes of text worked on at a time; dealt to one shard
SAMPLE, HOT, MOST_HOT = 64, 16, 50_000
LAST_ID = np.iinfo(np.int64).max  # stands for a null id: after all others


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays in one compressed binary; 8-byte columns are stored byte by byte position."""
    head = np.array([len(arrays), *(len(a) for a in arrays)], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(a.tobytes() for a in arrays))


def unpack(blob: bytes, *kinds: str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    sizes = np.frombuffer(raw, np.int64, len(kinds) + 1)[1:]
    out, at = [], 8 * (len(kinds) + 1)
    for kind, n in zip(kinds, sizes, strict=True):
        out.append(np.frombuffer(raw, kind, n, at))
        at += out[-1].nbytes
    return out


# Entries of a blob are grouped by document: ids and keys of documents, how many entries each
# has, then the entries' columns.
DOCS = ("i8", "i8", "i4")
MARKS = (*DOCS, "u4", "u4", "u2", "u4", "u1")  # seed, context (low, high), first, span
SPANS = (*DOCS, "u4", "u1")  # first, span
WINDOWS = (*DOCS, "u8", "u4")  # window, first


def join_blobs(blobs, kinds: tuple) -> list[np.ndarray]:
    """(id, key) of each entry and the entries' columns, over several blobs."""
    parts = []
    for blob in blobs:
        ids, keys, n, *columns = unpack(blob, *kinds)
        parts.append([np.repeat(ids, n), np.repeat(keys, n), *columns])
    if not parts:
        return [np.zeros(0, k) for k in ("i8", "i8", *kinds[3:])]
    return [np.concatenate(x) for x in zip(*parts, strict=True)]


def split_blobs(target: np.ndarray, ids, keys, *columns) -> Iterator[tuple[int, bytes]]:
    """One blob per target; entries of a document stand together."""
    order = np.lexsort((columns[-2], keys, ids, target))
    target, ids, keys, *columns = (x[order] for x in (target, ids, keys, *columns))
    edges = np.flatnonzero(np.diff(target, prepend=-1, append=-1))
    for a, b in zip(edges, edges[1:], strict=False):
        new = np.diff(ids[a:b], prepend=~ids[a]) != 0
        new |= np.diff(keys[a:b], prepend=~keys[a]) != 0
        at = np.flatnonzero(new)
        n = np.diff(np.append(at, b - a)).astype("i4")
        yield int(target[a]), pack(ids[a:b][at], keys[a:b][at], n, *(c[a:b] for c in columns))


def chunks(pdf: pd.DataFrame, size: int = CHUNK) -> Iterator[pd.DataFrame]:
    at = 0
    lengths = pdf["text"].map(len).to_numpy()
    while at < len(pdf):
        to = at + max(1, int(np.searchsorted(np.cumsum(lengths[at:]), size)))
        yield pdf.iloc[at:to]
        at = to


def later(groups: list[np.ndarray], ids: np.ndarray, place: np.ndarray, within: bool):
    """(order, later, new): entries sorted by group, id and place, which of them have an
    earlier one in their group, and where groups begin.

    ``within``: an earlier place in the same document counts, not only a smaller id.
    """
    order = np.lexsort((place, ids, *reversed(groups)))
    new = np.zeros(len(order), bool)
    new[:1] = True
    for g in groups:
        g = g[order]
        new[1:] |= g[1:] != g[:-1]
    begin = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    ids, place = ids[order], place[order]
    after = ids > ids[begin]
    if within:
        after |= (ids == ids[begin]) & (place > place[begin])
    return order, after, new


class Repeats:
    """The jobs for one kind of token."""

    def __init__(self, tokens: Callable[[list[str]], Tokens], length: int, seed: int, within: bool):
        self.tokens, self.length, self.seed, self.within = tokens, length, seed, within

    def mark(self, buckets: int, shards: int, hot: np.ndarray):
        out_of, find = self.tokens, anchors.find

        def run(batches):
            for pdf in batches:
                rows = []
                for part in chunks(pdf):
                    found = find(out_of(part["text"].tolist()), self.length, self.seed)
                    ids, keys = part["doc_id"].to_numpy()[found.doc], part["key"].to_numpy()[found.doc]
                    span = (found.last - found.first).astype("u1")
                    order, after, _ = later([found.seed, found.context], ids, found.first, self.within)
                    done, open_ = order[after], order[~after]
                    shard = keys[done].view("u8") % np.uint64(shards)
                    for to, blob in split_blobs(
                        shard.astype(np.int64), ids[done], keys[done], found.first[done].astype("u4"), span[done]
                    ):
                        rows.append((to % buckets, "settled", to, blob))
                    seed, context = found.seed[open_], found.context[open_]
                    warm = np.isin(seed, hot)
                    to = np.where(warm, context, seed) % np.uint64(buckets)
                    for b, blob in split_blobs(
                        to.astype(np.int64),
                        ids[open_],
                        keys[open_],
                        # a hot anchor keeps an odd name, so that its bucket knows it
                        (seed >> np.uint64(32) & np.uint64(0xFFFFFFFE)).astype("u4") | warm.astype("u4"),
                        (context & np.uint64(0xFFFFFFFF)).astype("u4"),
                        (context >> np.uint64(32) & np.uint64(0xFFFF)).astype("u2"),
                        found.first[open_].astype("u4"),
                        span[open_],
                    ):
                        rows.append((b, "marks", -1, blob))
                yield pd.DataFrame(rows, columns=["bucket", "kind", "shard", "blob"])

        return run

    def settle(self, shards: int):
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            passed = pdf[pdf["kind"] == "settled"]
            rows = list(zip(passed["kind"], passed["shard"], passed["blob"], strict=True))
            ids, keys, seed, low, high, first, span = join_blobs(
                pdf["blob"][pdf["kind"] == "marks"], MARKS
            )
            context = low.astype("u8") | high.astype("u8") << np.uint64(32)
            order, after, new = later([seed, context], ids, first, self.within)
            anchor_new = np.diff(seed[order].astype(np.int64), prepend=-1) != 0
            number = np.cumsum(anchor_new) - 1
            contexts = np.bincount(number, new) if len(number) else np.zeros(0)
            # every entry that is not settled, not only the first one of its context: others
            # of the same document, or of rows that share its id, have windows of their own
            asked = ~after & ((contexts[number] > 1) | (seed[order] & 1 == 1))
            for kind, at in (("settled", order[after]), ("asked", order[asked])):
                to = (keys[at].view("u8") % np.uint64(shards)).astype(np.int64)
                rows += [(kind, s, b) for s, b in split_blobs(to, ids[at], keys[at], first[at], span[at])]
            return pd.DataFrame(rows, columns=["kind", "shard", "blob"])

        return run

    def ask(self, buckets: int, shards: int):
        length = self.length

        def run(docs: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
            rows = []
            ids, keys, first, span = join_blobs(asked["blob"], SPANS)
            docs = docs[docs["key"].isin(keys)].drop_duplicates("key")
            order = np.argsort(keys, kind="stable")
            ids, keys, first, span = (x[order] for x in (ids, keys, first, span))
            for part in chunks(docs):
                of = part["key"].to_numpy()
                a, b = np.searchsorted(keys, of), np.searchsorted(keys, of, "right")
                at = np.repeat(a - np.cumsum(b - a) + (b - a), b - a) + np.arange((b - a).sum())
                doc = np.repeat(np.arange(len(of)), b - a)
                tokens = self.tokens(part["text"].tolist())
                wide = span[at].astype(np.int64) + 1
                place = np.repeat(first[at].astype(np.int64) - np.cumsum(wide) + wide, wide)
                place += np.arange(wide.sum())
                doc, one = np.repeat(doc, wide), np.repeat(ids[at], wide)
                begin = place + tokens.start[doc]
                n = len(tokens.hash)
                total = np.concatenate(
                    [np.zeros(1, "u8"), np.cumsum(tokens.hash * anchors.powers(anchors.BASE, n))]
                )
                window = anchors.mix(
                    (total[begin + length] - total[begin]) * anchors.powers(anchors.INVERSE, n)[begin]
                )
                order, after, _ = later([window], one, place, self.within)
                done, go = order[after], order[~after]
                to = (of[doc].view("u8") % np.uint64(shards)).astype(np.int64)
                none = np.zeros(len(done), "u1")
                for s, blob in split_blobs(
                    to[done], one[done], of[doc[done]], place[done].astype("u4"), none
                ):
                    rows.append((s % buckets, "settled", s, blob))
                target = (window[go] % np.uint64(buckets)).astype(np.int64)
                for t, blob in split_blobs(
                    target, one[go], of[doc[go]], window[go], place[go].astype("u4")
                ):
                    rows.append((t, "windows", -1, blob))
            return pd.DataFrame(rows, columns=["bucket", "kind", "shard", "blob"])

        return run

    def answer(self, shards: int):
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            passed = pdf[pdf["kind"] == "settled"]
            rows = list(zip(passed["kind"], passed["shard"], passed["blob"], strict=True))
            ids, keys, window, first = join_blobs(pdf["blob"][pdf["kind"] == "windows"], WINDOWS)
            order, after, _ = later([window], ids, first, self.within)
            at = order[after]
            to = (keys[at].view("u8") % np.uint64(shards)).astype(np.int64)
            none = np.zeros(len(at), "u1")
            rows += [("settled", s, b) for s, b in split_blobs(to, ids[at], keys[at], first[at], none)]
            return pd.DataFrame(rows, columns=["kind", "shard", "blob"])

        return run

    def cut(self, finish: Callable, names: list[str]):
        """``finish(tokens, covered)`` gives a chunk's columns; ``names`` orders them."""

        def run(docs: pd.DataFrame, settled: pd.DataFrame) -> pd.DataFrame:
            _, keys, first, span = join_blobs(settled["blob"], SPANS)
            order = np.argsort(keys, kind="stable")
            keys, first, span = keys[order], first[order], span[order]
            out = []
            for part in chunks(docs):
                of = part["key"].to_numpy()
                a, b = np.searchsorted(keys, of), np.searchsorted(keys, of, "right")
                at = np.repeat(a - np.cumsum(b - a) + (b - a), b - a) + np.arange((b - a).sum())
                tokens = self.tokens(part["text"].tolist())
                begin = first[at].astype(np.int64) + tokens.start[np.repeat(np.arange(len(of)), b - a)]
                depth = np.bincount(begin, minlength=len(tokens.hash) + 1)
                ends = begin + span[at] + self.length
                depth = depth - np.bincount(ends, minlength=len(depth))
                covered = np.cumsum(depth)[: len(tokens.hash)] > 0
                kept = part.drop(columns=["text", "key", "shard"]).reset_index(drop=True)
                out.append(pd.concat([kept, pd.DataFrame(finish(tokens, covered))], axis=1))
            return pd.concat(out)[names] if out else pd.DataFrame(columns=names)

        return run

    def hot_anchors(self, rows: DataFrame) -> np.ndarray:
        """Anchors with many contexts in the sample, at most ``MOST_HOT`` of them."""

        def run(batches):
            for pdf in batches:
                for part in chunks(pdf):
                    found = anchors.find(self.tokens(part["text"].tolist()), self.length, self.seed)
                    yield pd.DataFrame(
                        {"seed": found.seed.view("i8"), "context": found.context.view("i8")}
                    ).drop_duplicates()

        sample = rows.where(F.pmod(F.xxhash64(F.lit(1), "key"), F.lit(SAMPLE)) == 0)
        counted = (
            sample.mapInPandas(run, "seed long, context long")
            .distinct()
            .groupBy("seed")
            .count()
            .where(F.col("count") >= HOT)
            .orderBy(F.col("count").desc(), "seed")
            .limit(MOST_HOT)
        )
        return np.array(sorted(r.seed for r in counted.collect()), np.int64).view("u8")

    def remove(
        self, docs: DataFrame, finish: Callable, schema: dict[str, str], carry: tuple[str, ...] = ()
    ) -> DataFrame:
        """One row per row of ``docs``: doc_id, the columns that ``finish`` gives, and the
        string columns ``carry`` as they were."""
        text = F.coalesce("text", F.lit(""))
        carried = [F.col(c).alias(f"carried_{i}") for i, c in enumerate(carry)]
        # null ids are numbers in the jobs: pandas would turn others into floating ones
        rank = F.coalesce("doc_id", F.lit(LAST_ID)).alias("doc_id")
        no_id = F.isnull("doc_id").alias("no_id")
        every = docs.select(rank, text.alias("text"), no_id, *carried).withColumn(
            "key", F.xxhash64("doc_id", "text")
        )
        rows = every.select("doc_id", "text", "key")
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        shards = buckets = max(48, -(-size // SHARD))
        packed = "bucket int, kind string, shard int, blob binary"
        found = stage(
            rows.mapInPandas(self.mark(buckets, shards, self.hot_anchors(rows)), packed)
            .groupBy("bucket")
            .applyInPandas(self.settle(shards), "kind string, shard int, blob binary"),
            "repeats",
        )
        # the shard of a key as an unsigned number, as numpy computes it
        shard = F.pmod(
            F.pmod(F.col("key"), F.lit(shards))
            + F.when(F.col("key") < 0, F.lit((1 << 64) % shards)).otherwise(F.lit(0)),
            F.lit(shards),
        )
        dealt = every.withColumn("shard", shard.cast("int"))
        by_shard = dealt.groupBy("shard")
        asked = found.where("kind = 'asked'").select("shard", "blob")
        answers = (
            by_shard.cogroup(asked.groupBy("shard"))
            .applyInPandas(self.ask(buckets, shards), packed)
            .groupBy("bucket")
            .applyInPandas(self.answer(shards), "kind string, shard int, blob binary")
        )
        settled = found.where("kind = 'settled'").select("shard", "blob").union(
            answers.select("shard", "blob")
        )
        names = {"doc_id": "long", "no_id": "boolean", **schema, **{f"carried_{i}": "string" for i in range(len(carry))}}
        result = ", ".join(f"{k} {v}" for k, v in names.items())
        again = every.withColumn("shard", shard.cast("int"))
        return (
            again.groupBy("shard")
            .cogroup(settled.groupBy("shard"))
            .applyInPandas(self.cut(finish, list(names)), result)
            .withColumn("doc_id", F.when(~F.col("no_id"), F.col("doc_id")))
            .drop("no_id")
            .withColumnsRenamed({f"carried_{i}": c for i, c in enumerate(carry)})
        )


def runs(flags: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, doc) of the runs of true flags; runs end where documents do."""
    step = np.diff(flags.astype(np.int8), prepend=0, append=0)
    inner = start[1:-1]
    inner = inner[(inner > 0) & (inner < len(flags))]
    both = np.unique(inner[flags[inner] & flags[inner - 1]])
    begin = np.sort(np.concatenate([np.flatnonzero(step > 0), both]))
    end = np.sort(np.concatenate([np.flatnonzero(step < 0), both]))
    return begin, end, np.searchsorted(start, begin, "right") - 1
