"""URL filter: host and path rules, and a character language-model ratio for all other URLs.

A rule names a host and the begin of a path; it fits that host and its subdomains, and the
longest rule that fits decides. URLs that a rule decides are the labelled ones. On them two
variable-order Markov models are fitted, one for accepted and one for rejected URLs: the
probability of a character given the ``order`` characters before it falls back on shorter
contexts,

    P(c | context) = (n(context c) + strength * P(c | shorter context)) / (n(context) + strength),

down to an even spread over ``alphabet`` characters. A URL's score is the difference of both
log-likelihoods over its host and path, divided by its number of characters and the end mark. The
cut between accepted and rejected is calibrated on labelled URLs that the models have not seen:
the one with the greatest sum of both classes' shares of right verdicts.

The models meet in one table, a row for each string of a context and a character: the log ratio
at the longest context that is known. It holds all strings of the labelled URLs, so it grows with
them and no size is forced on a join: each distinct window of ``order + 1`` characters looks up its
longest known string once, and the characters of the URLs join those windows. The sums are
aggregated before they are shuffled, by URL. Counts cover all labelled URLs. ``entries`` is there
for smaller models: only so many strings that are seen most often stay (shorter ones first, so a
string's ending is never missing), and contexts beyond that fall back like unseen ones.

Defined cases: a null URL, or one without ``://``, has an empty host and path, no rule, and the
score of an empty text, whose end mark is all there is. Without accepted or without rejected URLs
every URL that no rule decides gets the verdict that there is, ``allow`` if there is none. A
character that neither model has seen says nothing. Repeated rows are judged each for itself;
rules of equal length: the longer host wins. An empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailtally.llm.common import stage

#: Marks before the first and behind the last character of a text.
BEGIN, END = "\x02", "\x03"
#: Scores are calibrated in steps of one part in so many.
STEPS = 100

Rule = tuple[str, str, str]  # verdict, host, path

#: Verdict, host and path of the rules.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def host(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(
        F.coalesce(found, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    )


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def ruled(rules: Sequence[Rule], host: Column, path: Column, pick: int) -> Column:
    """The longest fitting rule's verdict (``pick`` 0) or text (1), else null."""
    found = F.lit(None).cast("string")
    for verdict, name, begin in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]))):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(begin)
        found = F.when(fits, F.lit((verdict, name + begin)[pick])).otherwise(found)
    return found


def windows(text: Column, order: int) -> Column:
    """For each character of a text and its end mark, it and the ``order`` characters before."""
    marked = F.concat(F.lit(BEGIN * order), text, F.lit(END))
    return F.regexp_extract_all(marked, F.lit(f"(?s)(?=(.{{{order + 1}}}))"), 1)


def fit(
    labelled: DataFrame, order: int, strength: float, alphabet: int, entries: int | None = None
) -> DataFrame:
    """(gram, ratio) of (text, good): strings of 1 to ``order + 1`` characters, all of them or
    the ``entries`` most frequent ones."""
    endings = F.array(*[F.substring("window", -k, k) for k in range(1, order + 2)])
    counts = (
        labelled.select("good", F.explode(windows(F.col("text"), order)).alias("window"))
        .select("good", F.explode(endings).alias("gram"))
        .groupBy("gram")
        .agg(F.count_if("good").alias("a"), F.count_if(~F.col("good")).alias("b"))
        .withColumn("length", F.length("gram"))
        .withColumn("context", F.expr("substring(gram, 1, length - 1)"))
    )
    counts = stage(counts, "grams")
    contexts = counts.groupBy("length", "context").agg(F.sum("a").alias("ca"), F.sum("b").alias("cb"))
    most = counts
    if entries is not None:
        most = counts.orderBy((F.col("a") + F.col("b")).desc(), "length", "gram").limit(entries)
    known = stage(most.join(contexts, ["length", "context"]), "known")
    share = F.lit(1.0 / alphabet)
    ratios, shorter = None, None
    for k in range(1, order + 2):
        now = known.where(F.col("length") == k)
        if shorter is None:
            now = now.withColumn("pa", share).withColumn("pb", share)
        else:
            now = now.withColumn("ending", F.expr("substring(gram, 2)")).join(shorter, "ending")
        p = [
            ((F.col(n) + strength * F.col(f"p{n}")) / (F.col(f"c{n}") + strength)).alias(f"p{n}")
            for n in "ab"
        ]
        now = stage(now.select("gram", *p), "model")
        shorter = now.withColumnRenamed("gram", "ending")
        ratio = now.select("gram", (F.log("pa") - F.log("pb")).alias("ratio"))
        ratios = ratio if ratios is None else ratios.union(ratio)
    return stage(ratios, "ratios")


def scored(urls: DataFrame, model: DataFrame, order: int) -> DataFrame:
    """(row, score) of (row, text): the mean log ratio of a text's characters and end mark."""
    places = urls.select("row", F.explode(windows(F.col("text"), order)).alias("window"))
    known = places.select("window").distinct()
    for k in range(1, order + 2):
        grams = model.where(F.length("gram") == k).select(
            F.col("gram").alias(f"g{k}"), F.col("ratio").alias(f"r{k}")
        )
        known = known.join(grams, F.substring("window", -k, k) == F.col(f"g{k}"), "left")
    best = F.coalesce(*[F.col(f"r{k}") for k in range(order + 1, 0, -1)], F.lit(0.0))
    known = stage(known.select("window", best.alias("ratio")), "windows")
    return places.join(known, "window").groupBy("row").agg(F.avg("ratio").alias("score"))


def calibrate(scores: DataFrame) -> float:
    """The cut of (good, score) with the greatest balanced share of right verdicts.

    Scores are counted in steps; a log ratio is bounded, so their number is. Of equal cuts the
    one nearest to 0 is taken, of two such the lower.
    """
    steps = (
        scores.groupBy(F.floor(F.col("score") * STEPS).alias("step"))
        .agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))
        .collect()
    )
    goods, bads = sum(r.good for r in steps), sum(r.bad for r in steps)
    if not goods or not bads:
        return 0.0
    best, below = None, [0, 0]
    for step, good, bad in sorted(map(tuple, steps)):
        right = (goods - below[0]) * bads + below[1] * goods
        rank = (-right, abs(step), step)
        best = rank if best is None else min(best, rank)
        below = [below[0] + good, below[1] + bad]
    return best[2] / STEPS


def unseen(text: Column) -> Column:
    """True for texts kept from the models, by the first digit of their md5."""
    return F.substring(F.md5(text), 1, 1).isin("0", "1", "2")


def judge(
    pages: DataFrame,
    rules: Sequence[Rule],
    order: int = 4,
    strength: float = 4.0,
    alphabet: int = 256,
    entries: int | None = None,
) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, score (null if a rule decides),
    verdict (``allow`` or ``block``)."""
    urls = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    listed = stage(
        urls.select(
            F.monotonically_increasing_id().alias("row"),
            "*",
            ruled(rules, F.col("host"), F.col("path"), 1).alias("rule"),
            ruled(rules, F.col("host"), F.col("path"), 0).alias("decided"),
        ),
        "urls",
    )
    text = F.concat("host", "path").alias("text")
    known = listed.where("decided is not null").select(
        "row", text, (F.col("decided") == "allow").alias("good")
    )
    kinds = [r.good for r in known.select("good").distinct().collect()]
    if len(kinds) < 2:
        only = "allow" if not kinds or kinds[0] else "block"
        score, verdict = F.lit(None).cast("double"), F.coalesce("decided", F.lit(only))
        return listed.select(
            "page_id", "host", "path", "rule", score.alias("score"), verdict.alias("verdict")
        )
    model = fit(known.where(~unseen(F.col("text"))), order, strength, alphabet, entries)
    aside = known.where(unseen(F.col("text")))
    cut = calibrate(scored(aside, model, order).join(aside.select("row", "good"), "row"))
    open_ = listed.where("decided is null").select("row", text)
    scores = scored(open_, model, order).withColumnRenamed("row", "scored")
    own = F.when(F.col("score") >= cut, F.lit("allow")).otherwise(F.lit("block"))
    return listed.join(scores, F.col("row") == F.col("scored"), "left").select(
        "page_id", "host", "path", "rule", "score", F.coalesce("decided", own).alias("verdict")
    )
