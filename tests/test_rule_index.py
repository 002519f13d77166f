"""Long rule lists: the literal index finds what trying every pattern finds."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from mailtally.functions.literals import keys_of, needs, trie_pattern
from mailtally.operators import routing
from mailtally.sources.rules import load_rules

WORDS = ["kiss", "Invoice", "支払", "通知", "ダリア", "straße", "Ångström", "a.b", "x[1]", "(due)", "ok", "№5"]
SHAPES = [
    "{0}", "^{0}", "{0}$", r"{0}\s+{1}", "{0}|{1}", "(?:{0}|{1}){2}", "({0})?{1}", "(?:{0})+", "{0}{{2}}",
    "(?={0}){1}", "{0}.*{1}", "[{0}]+", "(?:{0}|[xyz]+)", r"\b{0}\b", "(?P<a>{0})", "(?!{0}){1}", "(?:{0}|{0}{1})",
]


def some_rules(rng, count):
    conf = {}
    for i in range(count):
        shape = rng.choice(SHAPES)
        words = [re.escape(w) for w in rng.choices(WORDS, k=3)]
        if shape.startswith("["):
            words = ["ab"] * 3
        pattern = shape.format(*words)
        if rng.random() < 0.5:
            pattern = f"{pattern}.*no {i % 40:02}" if rng.random() < 0.5 else f"no {i:03}"
        conf[f"P{i}"] = {"match": {"subject_regex": pattern, "sender_email": rng.choice([None, None, "s@x"])}}
    return load_rules({"customers": conf})


def some_subjects(rng, count):
    def word():
        w = rng.choice(WORDS + ["xyz", " "])
        w = rng.choice([w, w.upper(), w.lower(), w * 2])
        for plain, other in (("s", "ſ"), ("i", "İ"), ("i", "ı"), ("k", "K"), ("I", "ı")):
            if rng.random() < 0.1:
                w = w.replace(plain, other)
        return w

    made = [
        rng.choice(["", " "]).join(word() for _ in range(rng.randint(0, 4))) + f" no {rng.randint(0, 250):03}"
        for _ in range(count)
    ]
    return [None, "", *made]


def test_the_index_finds_what_all_patterns_find(spark, monkeypatch):
    rng = random.Random(3)
    subjects = some_subjects(rng, 1500)
    df = spark.createDataFrame(
        [(i, s, rng.choice(["s@x", "t@x", None])) for i, s in enumerate(subjects)],
        "n int, subject string, email_sender string",
    ).coalesce(8)
    rules = some_rules(rng, 200)
    assert len(rules) >= routing.INDEX_FROM
    assert "regexp_extract_all" in routing.hits_sql(rules)
    indexed = df.select("n", F.expr(routing.hits_sql(rules)).alias("hits"))
    # every rule by itself, in groups below the index's length
    parts = []
    for at in range(0, len(rules), 20):
        some = routing.hits_sql(rules[at : at + 20])  # places in the group
        parts.append(F.expr(f"transform({some}, place -> place + {at})"))
    plain = df.select("n", F.concat(*parts).alias("hits"))
    got, want = (dict(x.collect()) for x in (indexed, plain))
    assert got == want
    assert sum(map(len, want.values())) > len(subjects)


def test_literals_that_every_match_holds():
    assert needs("Cedar.*支払") == [{"cedar"}, {"支払"}]
    assert needs(r"aoba\s+trading|青葉") == [{"trading", "青葉"}]
    assert needs("(?:ab|cd)ef") == [{"ab", "cd"}, {"ef"}]
    assert needs("(?:abc)?de") == [{"de"}]
    assert needs("(?:abc){2,}") == [{"abc"}]
    assert needs("(?=abc)de(?!fg)") == [{"de"}]
    assert needs(r"a\bbc") == [{"abc"}]
    assert needs("straße") == [{"stra"}]  # ß has other forms of case
    assert needs(".*|x") == needs("a") == needs("") == []


def test_keys_are_rare_and_no_beginning_of_another():
    numbered = [f"payment notice of partner {i:03}" for i in range(300)]
    keys = keys_of([*numbered, "payment", "x.y", "notice", "no"], 16)
    assert all(len(places) < 16 for places in keys.values())
    assert {i for places in keys.values() for i in places} >= set(range(300))
    assert not any(a != b and b.startswith(a) for a in keys for b in keys)


def test_a_literal_of_too_many_patterns_is_no_key():
    same = [rf"notice \d{{{i}}}" for i in range(1, 40)]
    assert keys_of(same, 16) == {}
    assert list(keys_of([*same, "other one"], 16).values()) == [[39]]


def test_the_trie_finds_each_key_wherever_it_begins():
    found = re.findall(trie_pattern(["ab", "ba", "a.c", "支払"]), "abab a.c axc 支払")
    assert found == ["ab", "ba", "ab", "a.c", "支払"]


def test_long_lists_route_as_short_ones(spark, sf, plan):
    from mailtally.plans import fixtures as fx

    others = {f"P{i}": {"subject_regex": rf"partner{i:04}\s+(notice|invoice)"} for i in range(1500)}
    rules = load_rules({"customers": {**others, **fx.KV_RULES["customers"]}})
    few = load_rules(fx.KV_RULES)
    df = fx.emails_kv(fx.table(spark, sf, "orders"))

    long, short = (routing.matched_rules(df, r).select("id", "rule_name") for r in (rules, few))
    assert long.exceptAll(short).isEmpty() and short.exceptAll(long).isEmpty()
    assert routing.route_all(df, rules).exceptAll(routing.route_all(df, few)).isEmpty()
    assert routing.route_first(df, rules).exceptAll(routing.route_first(df, few)).isEmpty()
    text = plan(routing.matching(df, rules))
    assert "from_json" not in text and text.count("RLIKE") <= 2 * len(few)
