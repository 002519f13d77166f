"""Extraction strategies: a message and a rule to an array of records.

A strategy gives a Column of ``array<EXTRACT>`` for one rule, so that routing can put every
rule into one projection; an empty or null array means no success. The built-in ones are
SQL text over the parts of a rule, which are literals, or fields of a rule struct when
there are too many rules to write each one into the plan.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, fields

from pyspark.sql import Column, functions as F

from mailtally.functions.bind import constant, each, last, let, only, present, quote, variable
from mailtally.functions.money import yen_sql
from mailtally.functions.regex import has_groups, java_pattern
from mailtally.functions.text import (
    Hit,
    amount_sql,
    code_sql,
    near_code_pattern,
    prefix_sql,
    rlike,
    short_label_sql,
)
from mailtally.schemas import EXTRACT
from mailtally.sources.rules import Rule

# --- fixed values: column headers that are not partner codes; currency of table mails ---
NOT_A_CODE = ["合計", "-"]
TABLE_CURRENCY = "'JPY'"
# --- end of fixed values ---

EXTRACTS = f"array<{EXTRACT.simpleString()}>"


@dataclass(frozen=True)
class Body:
    """Names of the parsed columns of a message, plus the options of the run."""

    text: str = "_text"
    lines: str = "_lines"
    tables: str = "_tables"
    strict_sign: bool = False
    label_mode: str = "line"


@dataclass(frozen=True)
class RuleSql:
    """The parts of a rule as SQL, and how to search with its patterns."""

    name: str
    near_code: str
    code_label: str
    code_cell: str
    amount_label: str
    amount_cell: str
    code_table: str
    amount_table: str
    prefix: str
    currency: str
    default_label: str
    hit: Hit = field(default=rlike, compare=False)


def literals(rule: Rule) -> RuleSql:
    """A rule as literals: patterns are compiled once per task."""
    values = rule_values(rule)
    return RuleSql(**{p: str(values[p]) if isinstance(values[p], int) else quote(values[p]) for p in _parts()})


def _parts() -> list[str]:
    return [f.name for f in fields(RuleSql) if f.name != "hit"]


def rule_values(rule: Rule) -> dict[str, object]:
    """The parts of a rule as values of a constant struct, with the kind of extraction it needs."""
    # A code pattern of a table rule may hold groups of its own, which the text search refuses.
    near = "" if has_groups(rule.code_regex) else near_code_pattern(rule.code_regex, rule.whole_code)
    return {
        "kind": _kind(rule),
        "name": rule.name,
        "near_code": near,
        "code_label": java_pattern(rule.code_regex),
        "code_cell": java_pattern(rule.code_regex, ignore_case=False),
        "amount_label": java_pattern(rule.amount_regex),
        "amount_cell": java_pattern(rule.amount_regex, ignore_case=False),
        "code_table": rule.code_table or 0,
        "amount_table": rule.amount_table or 0,
        "prefix": rule.prefix_code,
        "currency": rule.currency,
        "default_label": rule.default_label,
    }


RULE_KIND = ",".join(
    f"{p}:{'int' if p in ('code_table', 'amount_table') else 'string'}" for p in ["kind", *_parts()]
)


def _search(value: str, pattern: str) -> str:
    """Search with a pattern that is no literal; the last one compiled is remembered."""
    return f"regexp_instr({value}, {pattern}) > 0"


def from_struct(r: str) -> RuleSql:
    return RuleSql(**{p: f"{r}.{p}" for p in _parts()}, hit=_search)


Strategy = Callable[[Body, Rule], Column]
TEXT, TABLES = frozenset({"text"}), frozenset({"tables"})
_REGISTRY: dict[str, tuple[Strategy, frozenset[str]]] = {}


def register_strategy(
    name: str, strategy: Strategy, reads: frozenset[str] = TEXT | TABLES
) -> None:
    """Add or replace a strategy under the name used in rule files.

    ``reads`` says which parsed columns it needs, so that nothing else is parsed.
    """
    _REGISTRY[name] = (strategy, reads)


def strategy_names() -> list[str]:
    return [*_KINDS, *_REGISTRY]


def is_built_in(rule: Rule) -> bool:
    return _kind(rule) is not None


def reads(rule: Rule) -> frozenset[str]:
    """Parsed columns that a rule needs."""
    kind = _kind(rule)
    return _BUILT_IN[kind][1] if kind else _registered(rule)[1]


def _registered(rule: Rule) -> tuple[Strategy, frozenset[str]]:
    if rule.strategy not in _REGISTRY:
        raise ValueError(f"rule {rule.name}: unknown strategy {rule.strategy!r}")
    return _REGISTRY[rule.strategy]


def apply_strategy(body: Body, rule: Rule) -> Column:
    kind = _kind(rule)
    if kind is None:
        return _registered(rule)[0](body, rule).cast(EXTRACTS)
    return F.expr(_BUILT_IN[kind][0](body, literals(rule))).cast(EXTRACTS)


def _record(rule: RuleSql, code: str, amount: str, label: str, currency: str) -> str:
    return (
        f"named_struct('customer_name', {rule.name}, "
        f"'customer_code', {prefix_sql(code, rule.prefix)}, 'payment_amount', {amount}, "
        f"'payment_due_label', {label}, 'currency', {currency})"
    )


def key_value(body: Body, rule: RuleSql) -> str:
    """One record from the labelled code and the labelled amount of the text.

    The amount is searched only when there is a code.
    """

    def record(code: str, due: str) -> str:
        label = f"{due}.label"
        if body.label_mode == "normalized":
            label = short_label_sql(label)
        label = let(label, lambda x: f"IF({x} <> '', {x}, {rule.default_label})")
        return _record(rule, code, f"{due}.amount", label, rule.currency)

    def with_code(code: str) -> str:
        due = amount_sql(body.lines, rule.amount_label, body.strict_sign, rule.hit)
        return each(present(f"array({due})"), lambda d: record(code, d))

    code = code_sql(body.text, body.lines, rule.near_code, rule.code_label, rule.hit)
    return _when_present(code, with_code)


def _when_present(value: str, then: Callable[[str], str]) -> str:
    return let(value, lambda x: f"CASE WHEN {x} IS NOT NULL THEN {then(x)} END")


# --- table strategies ---------------------------------------------------------------------


def _filled_rows(body: Body, table: str) -> str:
    """Rows of a table with the blank cells left out."""
    rows = only(body.tables, lambda r: f"{r}.table_index = {table}")
    return each(rows, lambda r: only(f"{r}.cells", lambda c: f"{c} <> ''"))


def _matched(rule: RuleSql, rows: str, pattern: str) -> str:
    """Rows with a matching cell: the first match, and the cells after it."""

    def at(cells: str) -> str:
        hits = each(cells, lambda c: rule.hit(c, pattern))
        place = f"CAST(array_position({hits}, true) AS INT)"
        return f"named_struct('hit', {place}, 'cells', {cells})"

    def after(x: str) -> str:
        return (
            f"named_struct('label', get({x}.cells, {x}.hit - 1), "
            f"'rest', slice({x}.cells, {x}.hit + 1, size({x}.cells)))"
        )

    return each(only(each(rows, at), lambda x: f"{x}.hit > 0"), after)


def _zip(rule: RuleSql, codes: str, amounts: str, label: str) -> str:
    """Pair codes with amount cells up to the shorter list; drop totals and bad amounts."""
    code, cell = variable("code"), variable("cell")
    pairs = (
        f"zip_with({codes}, {amounts}, ({code}, {cell}) -> "
        f"named_struct('code', {code}, 'amount', {yen_sql(cell)}))"
    )
    totals = ", ".join(map(quote, NOT_A_CODE))
    kept = only(pairs, lambda p: f"{p}.amount IS NOT NULL AND {p}.code NOT IN ({totals})")
    return each(kept, lambda p: _record(rule, f"{p}.code", f"{p}.amount", label, TABLE_CURRENCY))


def vertical(body: Body, rule: RuleSql) -> str:
    """Label cell, value cell: the last matching row wins for the code and for the amount."""
    def code_in(cells: str) -> str:
        c, i = variable("c"), variable("i")
        after = f"transform({cells}, ({c}, {i}) -> CASE WHEN {rule.hit(c, rule.code_cell)} THEN get({cells}, {i} + 1) END)"
        return f"get({present(after)}, 0)"

    def with_code(code: str) -> str:
        due = _matched(rule, _filled_rows(body, rule.amount_table), rule.amount_cell)
        return let(due, lambda d: labelled(code, d))

    def labelled(code: str, due: str) -> str:
        cell = f"get({last(only(due, lambda d: f'size({d}.rest) > 0'))}.rest, 0)"
        amounts = present(f"array({let(cell, yen_sql)})")
        return each(amounts, lambda a: _record(rule, code, a, f"{last(due)}.label", TABLE_CURRENCY))

    codes = present(each(_filled_rows(body, rule.code_table), code_in))
    return _when_present(last(codes), with_code)


def zip_headers(body: Body, rule: RuleSql) -> str:
    """Codes in the header row, amounts in the first row with the label."""

    def from_rows(rows: str) -> str:
        first = f"get({_matched(rule, rows, rule.amount_cell)}, 0)"
        return _when_present(first, lambda due: let(f"get({rows}, 0)", lambda h: from_due(h, due)))

    def from_due(headers: str, due: str) -> str:
        longer = f"size({headers}) > size({due}.rest)"
        codes = f"IF({longer}, slice({headers}, 2, size({headers})), {headers})"
        return _zip(rule, codes, f"{due}.rest", f"{due}.label")

    return let(_filled_rows(body, rule.amount_table), from_rows)


def zip_rows(body: Body, rule: RuleSql) -> str:
    """A row of codes and a row of amounts in one table; the last of each counts."""
    def from_rows(rows: str) -> str:
        c = variable("c")
        is_code = rule.hit(c, rule.code_cell)
        others = only(rows, lambda cells: f"NOT exists({cells}, {c} -> {is_code})")
        return _pair_rows(
            rule, _matched(rule, rows, rule.code_cell), _matched(rule, others, rule.amount_cell)
        )

    return let(_filled_rows(body, rule.amount_table), from_rows)


def zip_columns(body: Body, rule: RuleSql) -> str:
    """A row of codes in one table, a row of amounts in another."""
    code_rows = _matched(rule, _filled_rows(body, rule.code_table), rule.code_cell)
    due_rows = _matched(rule, _filled_rows(body, rule.amount_table), rule.amount_cell)
    return _pair_rows(rule, code_rows, due_rows)


def _pair_rows(rule: RuleSql, code_rows: str, due_rows: str) -> str:
    def from_codes(codes: str) -> str:
        return let(last(due_rows), lambda due: _zip(rule, codes, f"{due}.rest", f"{due}.label"))

    return _when_present(f"{last(code_rows)}.rest", from_codes)


_BUILT_IN: dict[str, tuple[Callable[[Body, RuleSql], str], frozenset[str]]] = {
    "key_value": (key_value, TEXT),
    "vertical": (vertical, TABLES),
    "zip_headers": (zip_headers, TABLES),
    "zip_rows": (zip_rows, TABLES),
    "zip_columns": (zip_columns, TABLES),
}
# --- fixed values: strategy names of rule files ---
_KINDS = {
    "key_value_table": "key_value",
    "vertical_key_value": "vertical",
    "zip_headers_to_row": "zip_headers",
    "zip_rows_in_same_table": "zip_rows",
    "zip_columns_across_tables": "zip_columns",
}
# --- end of fixed values ---


def _kind(rule: Rule) -> str | None:
    """Built-in extraction of a rule; null for a registered one."""
    if rule.strategy in _REGISTRY:
        return None
    # The vertical name reads tables if the rule says which, else the text.
    if rule.strategy == "vertical_key_value" and not rule.names_tables:
        return "key_value"
    return _KINDS.get(rule.strategy)


def rule_list(body: Body, rules: list[Rule], hits: str, first: bool) -> str:
    """SQL of the records of the matching rules, in rule order.

    ``hits`` is SQL of the places of those that match. The extraction is in
    the plan once per kind, over the constant structs of the rules that match. With
    ``first`` the fold stops extracting once a rule has yielded something.
    """
    table = constant([rule_values(r) for r in rules], f"array<struct<{RULE_KIND}>>")
    matched = each(hits, lambda i: f"get({table}, {i})")
    kinds = dict.fromkeys(_kind(rule) for rule in rules)
    empty = f"CAST(array() AS {EXTRACTS})"

    def extracted(r: str) -> str:
        cases = " ".join(
            f"WHEN {quote(k)} THEN CAST({_BUILT_IN[k][0](body, from_struct(r))} AS {EXTRACTS})"
            for k in kinds
        )
        return f"coalesce(CASE {r}.kind {cases} END, {empty})"

    if not first:
        return f"flatten({each(matched, extracted)})"
    so_far, r = variable("so_far"), variable("r")
    step = f"CASE WHEN size({so_far}) > 0 THEN {so_far} ELSE {extracted(r)} END"
    return f"aggregate({matched}, {empty}, ({so_far}, {r}) -> {step})"
