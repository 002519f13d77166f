"""Routing of messages to rules, as one narrow projection per message.

The rules come from a file and become literals of the plan: no join, no shuffle. A cheap
subject filter runs first, so that bodies of messages without a rule are never parsed.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable
from itertools import groupby

from pyspark.sql import Column, DataFrame, functions as F

from mailtally.functions.bind import (
    constant,
    each,
    inline_rows,
    non_empty,
    only,
    present,
    quote,
    variable,
)
from mailtally.functions.html import (
    TABLES as TABLES_TYPE,
)
from mailtally.functions.html import drop_spacer_tables, html_body, html_tables, html_to_text
from mailtally.functions.literals import folded_sql, keys_of, trie_pattern
from mailtally.functions.regex import java_pattern
from mailtally.functions.text import lines_of
from mailtally.operators.latest import newest_copy
from mailtally.operators.strategies import (
    EXTRACTS,
    Body,
    apply_strategy,
    is_built_in,
    reads,
    rule_list,
)
from mailtally.sources.rules import Rule


#: Lists from this length on are searched by the literals of their patterns, of which one that
#: more rules need than this says too little.
INDEX_FROM, MOST_SHARERS = 32, 16


def match_sql(rule: Rule, subject: str = "subject", sender: str = "email_sender") -> str:
    """Subject search, plus the sender if the rule names one."""
    hit = f"{subject} RLIKE {quote(java_pattern(rule.subject_regex))}"
    if rule.sender_email is not None:
        hit = f"({hit} AND {sender} <=> {quote(rule.sender_email)})"
    return hit


def any_match_sql(rules: list[Rule]) -> str:
    """Whether any of the rules matches."""
    if len(rules) < INDEX_FROM:
        return " OR ".join(map(match_sql, rules)) or "false"
    return f"size({hits_sql(rules)}) > 0"


def hits_sql(rules: list[Rule], subject: str = "subject", sender: str = "email_sender") -> str:
    """The places, in this list, of the rules that match, in ascending order.

    Short lists are tried one by one. In long ones the subject is searched once for literals
    that the patterns need, and only rules of which one is found are tried; rules without such
    a literal, or with one that many rules need, are tried one by one still.
    """

    def one_by_one(places: Iterable[int]) -> str:
        hits = ", ".join(
            f"CASE WHEN {match_sql(rules[i], subject, sender)} THEN {i} END" for i in places
        )
        return present(f"array({hits})") if hits else "CAST(array() AS array<int>)"

    if len(rules) < INDEX_FROM:
        return one_by_one(range(len(rules)))
    keys = keys_of([r.subject_regex for r in rules], MOST_SHARERS)
    if not keys:
        return one_by_one(range(len(rules)))
    indexed = {i for places in keys.values() for i in places}
    slots: list[list[dict]] = [[] for _ in keys]
    for key, places in keys.items():
        slots[zlib.crc32(key.encode()) % len(slots)].append({"key": key, "places": places})
    tests = [
        {"pattern": java_pattern(r.subject_regex), "sender": r.sender_email} if i in indexed else None
        for i, r in enumerate(rules)
    ]
    slot = constant(slots, "array<array<struct<key:string,places:array<int>>>>")
    test = constant(tests, "array<struct<pattern:string,sender:string>>")
    found = f"array_distinct(regexp_extract_all({folded_sql(subject)}, {quote(trie_pattern(keys))}, 1))"

    def places_of(key: str) -> str:
        at = f"CAST(crc32(CAST({key} AS BINARY)) % {len(slots)} AS INT)"
        return f"flatten({each(only(f'get({slot}, {at})', lambda e: f'{e}.key = {key}'), lambda e: f'{e}.places')})"

    def holds(i: str) -> str:
        t = variable("t")
        own = f"({t}.sender IS NULL OR {sender} <=> {t}.sender) AND regexp_instr({subject}, {t}.pattern) > 0"
        return f"exists(array(get({test}, {i})), {t} -> {own})"

    candidates = f"array_distinct(flatten({each(found, places_of)}))"
    rest = one_by_one(i for i in range(len(rules)) if i not in indexed)
    empty = "CAST(array() AS array<int>)"
    return f"array_sort(concat(coalesce({only(candidates, holds)}, {empty}), {rest}))"


def matching(messages: DataFrame, rules: list[Rule]) -> DataFrame:
    """Messages that at least one rule matches."""
    if not rules:
        return messages.limit(0)
    return messages.filter(any_match_sql(rules))


def matched_rules(messages: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per message and matching rule, without parsing: rule_order, rule_name."""
    table = constant(
        [{"rule_order": r.order, "rule_name": r.name} for r in rules],
        "array<struct<rule_order:int,rule_name:string>>",
    )
    hits = F.expr(each(hits_sql(rules), lambda i: f"get({table}, {i})"))
    return inline_rows(messages, hits, "rule_name", "*")


def parse_bodies(messages: DataFrame, rules: list[Rule], drop_spacers: bool = False) -> DataFrame:
    """Add ``_text``, ``_lines`` and ``_tables`` as far as the rules read them."""
    body = F.col("html_body")
    needed = frozenset().union(*map(reads, rules))
    none = F.lit(None).cast(TABLES_TYPE)
    if {"text", "tables"} <= needed:
        both = messages.withColumn("_body", html_body(body))
        parsed = both.withColumns({"_text": F.col("_body.text"), "_tables": F.col("_body.tables")})
        parsed = parsed.drop("_body")
    elif "tables" in needed:
        parsed = messages.withColumns({"_text": F.lit(""), "_tables": html_tables(body)})
    else:
        parsed = messages.withColumns({"_text": html_to_text(body), "_tables": none})
    if drop_spacers and "tables" in needed:
        parsed = parsed.withColumn("_tables", drop_spacer_tables(F.col("_tables")))
    return parsed.withColumn("_lines", lines_of(F.col("_text")))


def _extracts(
    messages: DataFrame, rules: list[Rule], first: bool, drop_spacers: bool, strict_sign: bool, label_mode: str
) -> DataFrame:
    """Slim rows of the matched messages with the records of the first or of every rule."""
    if not rules:
        raise ValueError("no rules")
    parsed = parse_bodies(matching(messages, rules), rules, drop_spacers)
    return _with_records(parsed, _records(rules, first, strict_sign, label_mode))


def _records(rules: list[Rule], first: bool, strict_sign: bool, label_mode: str) -> Column:
    """Records of a parsed message, in the order of the rules.

    One form for lists of any length: subject patterns are literals and find the rules that
    match; the extraction is in the plan once for each kind and reads the rule from a
    constant struct. With ``first``, rules after the first success are not tried. A
    registered strategy is an expression of its own and stands in a list of its own kind.
    """
    body = Body(strict_sign=strict_sign, label_mode=label_mode)
    parts: list[Column] = []
    for built_in, group in groupby(rules, is_built_in):
        some = list(group)
        if built_in:
            parts.append(F.expr(rule_list(body, some, hits_sql(some), first)))
        else:
            parts += [F.when(F.expr(match_sql(r)), apply_strategy(body, r)) for r in some]
    if first:
        return F.coalesce(*map(non_empty, parts))
    empty = F.array().cast(EXTRACTS)
    return F.concat(*[F.coalesce(p, empty) for p in parts])


def extract_every(
    messages: DataFrame, rules: list[Rule], strict_sign: bool = False, label_mode: str = "line"
) -> DataFrame:
    """One slim row per message, matched or not, from one pass over the messages.

    As ``extract_first``, with ``conversation_id``, ``matched`` and ``parse_failed``. Bodies
    of messages that no rule matches are not handed to the parser.
    """
    hit = F.expr(any_match_sql(rules))
    marked = messages.withColumn("matched", F.coalesce(hit, F.lit(False)))
    marked = marked.withColumn("html_body", F.when(F.col("matched"), F.col("html_body")))
    parsed = parse_bodies(marked, rules)
    read = "_text" if "text" in frozenset().union(*map(reads, rules)) else "_tables"
    refused = F.col("html_body").isNotNull() & F.col(read).isNull()
    records = _records(rules, True, strict_sign, label_mode)
    kept = [F.col(c).alias(name) for c, name in MESSAGE_COLUMNS.items()]
    empty = F.array().cast(EXTRACTS)
    return parsed.select(
        F.coalesce(records, empty).alias("records"),
        *kept,
        "conversation_id",
        "matched",
        refused.alias("parse_failed"),
    )


MESSAGE_COLUMNS = {
    "id": "email_unique_id",
    "subject": "email_subject",
    "email_sender": "email_sender",
    "received_at": "email_received_at",
    "received_ts": "received_ts",
}


def _with_records(parsed: DataFrame, extracts: Column) -> DataFrame:
    kept = [F.col(c).alias(name) for c, name in MESSAGE_COLUMNS.items()]
    return parsed.select(extracts.alias("records"), *kept)


def extract_first(
    messages: DataFrame,
    rules: list[Rule],
    drop_spacers: bool = False,
    strict_sign: bool = False,
    label_mode: str = "line",
) -> DataFrame:
    """One slim row per matched message: its columns without the body, and the array of
    records of the first rule, in file order, that matches and yields something."""
    return _extracts(messages, rules, True, drop_spacers, strict_sign, label_mode)


def newest_extract(extracted: DataFrame) -> DataFrame:
    """One row per message id, the newest copy.

    After the extraction on purpose: this shuffles slim rows, where the same step on
    messages would shuffle their bodies.
    """
    return newest_copy(extracted, "email_unique_id")


def explode_records(extracted: DataFrame) -> DataFrame:
    """One row per record."""
    return inline_rows(extracted, F.col("records"), "customer_name", *MESSAGE_COLUMNS.values())


def route_first(
    messages: DataFrame,
    rules: list[Rule],
    drop_spacers: bool = False,
    strict_sign: bool = False,
    label_mode: str = "line",
) -> DataFrame:
    """Records of the first rule that matches and yields something."""
    return explode_records(extract_first(messages, rules, drop_spacers, strict_sign, label_mode))


def route_all(
    messages: DataFrame,
    rules: list[Rule],
    drop_spacers: bool = False,
    strict_sign: bool = False,
    label_mode: str = "line",
) -> DataFrame:
    """Records of every matching rule."""
    return explode_records(_extracts(messages, rules, False, drop_spacers, strict_sign, label_mode))
