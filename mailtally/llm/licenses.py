"""License scan by diagonal voting, in DataFrame operations only.

Every pair of neighbouring words of a document is hashed and joined with the word pairs of
the templates. A hit at word ``pos`` of a pair that stands at ``tpos`` in its template votes
for the diagonal ``pos - tpos``, the place where the template would begin. Votes are
aggregated by document, template and diagonal. Phrases need every pair on one diagonal;
for notices, diagonals up to ``reach`` words apart (words put in or left out) are merged.
A merged span is verified by its pairs: a word put in costs one, a word left out two, so
``missing`` of them may be lacking, but none between words of a notice's brackets. Those
tell it from the notices of other licenses and versions.

The templates are a fixed list, so their table is broadcast. The hits of a document spread
over its own diagonals; nothing is grouped by a key that documents share.

Defined cases: a null text counts as empty; a document without words has 0 words, no labels
and score 0. Each row of the input is a document of its own, also if it repeats an id or has
none; an empty table gives no rows. Other columns are not read. Letters are lowered by
``lower``, which beyond A-Z only touches letters that occur in no template.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Everything that is no word: ASCII without digits and lower-case letters.
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases whose places are counted, with their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Notices of the method's own labels, as their licenses word them. Words in
# brackets name the license and stand there unchanged.
NOTICES = {
    "licensed under the [apache license] [version 2 0]": "apache-2.0",
    "released under the [mit license]": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "licensed under the [gnu general public license] [version 3]": "gpl-3.0",
    "licensed under the [gnu general public license] [version 2]": "gpl-2.0",
    "licensed under [cc by 4 0]": "cc-by-4.0",
    "licensed under [cc by nc 4 0]": "cc-by-nc-4.0",
    "licensed under [cc by sa 4 0]": "cc-by-sa-4.0",
    "redistribution and use in source and binary forms with or without modification": "bsd",
}


def notice_words(text: str) -> tuple[list[str], int]:
    """The words of a template, and bits for the pairs within its brackets."""
    words, core, inside = [], 0, False
    for i, word in enumerate(text.split()):
        if inside:
            core |= 1 << (i - 1)
        inside = (inside or word.startswith("[")) and not word.endswith("]")
        words.append(word.strip("[]"))
    return words, core


def template_pairs(
    spark: SparkSession, phrases: dict[str, str], notices: dict[str, str]
) -> DataFrame:
    """(template, label, exact, full, core, tpos, ta, tb): a row for each word pair of a template."""
    rows = []
    for exact, group in ((True, phrases), (False, notices)):
        for text, label in group.items():
            words, core = notice_words(text)
            if not 2 <= len(words) <= 63:
                raise ValueError(f"a template has 2 to 63 words: {text!r}")
            for i, (a, b) in enumerate(zip(words, words[1:], strict=False)):
                rows.append((len(rows) - i, label, exact, len(words) - 1, core, i, a, b))
    schema = (
        "template int, label string, exact boolean, full int, core long, tpos int, ta string, tb string"
    )
    return spark.createDataFrame(rows, schema)


def scan(
    docs: DataFrame,
    phrases: dict[str, str] = PHRASES,
    notices: dict[str, str] = NOTICES,
    reach: int = 2,
    missing: int = 2,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score (the largest share of a template that was found)."""
    words = F.array_remove(F.split(F.lower(F.coalesce("text", F.lit(""))), NO_WORD), "")
    listed = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", words.alias("words")
    )
    following = F.slice("words", F.lit(2), F.greatest(F.size("words") - 1, F.lit(0)))
    pairs = listed.select(
        "row",
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.posexplode_outer(F.arrays_zip(F.col("words").alias("a"), following.alias("b"))),
    ).select("row", "doc_id", "n_words", "pos", F.col("col.a").alias("a"), F.col("col.b").alias("b"))
    templates = template_pairs(docs.sparkSession, phrases, notices).withColumn(
        "thash", F.xxhash64("ta", "tb")
    )
    hit = (F.xxhash64("a", "b") == F.col("thash")) & (F.col("a") == F.col("ta")) & (
        F.col("b") == F.col("tb")
    )
    # beside the hits, one row of each document goes on: its first pair, or none at all
    votes = (
        pairs.join(F.broadcast(templates), hit, "left")
        .where(F.col("template").isNotNull() | F.coalesce(F.col("pos") == 0, F.lit(True)))
        .withColumn("diagonal", F.col("pos") - F.col("tpos"))
        .groupBy("row", "doc_id", "n_words", "template", "label", "exact", "full", "core", "diagonal")
        .agg(F.bit_or(F.expr("shiftleft(1L, tpos)")).alias("found"))
    )
    along = Window.partitionBy("row", "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(along)
    begins = F.col("exact") | gap.isNull() | (gap > reach)
    spans = (
        votes.withColumn("begins", begins.cast("int"))
        .withColumn("span", F.sum("begins").over(along))
        .groupBy("row", "doc_id", "n_words", "template", "label", "exact", "full", "core", "span")
        .agg(F.bit_or("found").alias("found"), F.min("diagonal").cast("long").alias("start"))
        .withColumn("part", F.bit_count("found") / F.col("full"))
    )
    base = F.col("exact") & (F.col("part") == 1)
    whole = F.col("found").bitwiseAND(F.col("core")) == F.col("core")
    own = ~F.col("exact") & whole & (F.col("full") - F.bit_count("found") <= missing)
    joined = lambda c: F.array_join(F.sort_array(F.collect_set(F.when(c, F.col("label")))), ",")
    return (
        spans.groupBy("row", "doc_id", "n_words")
        .agg(
            F.count_if(base).alias("n_base"),
            F.min(F.when(base, F.col("start"))).alias("first_word"),
            F.max(F.when(base, F.col("start"))).alias("last_word"),
            joined(base).alias("base_labels"),
            joined(base | own).alias("labels"),
            F.coalesce(F.max("part"), F.lit(0.0)).alias("score"),
        )
        .drop("row")
    )
