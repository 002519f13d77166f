"""Rule files: YAML path, YAML text or dict to an ordered, checked list of rules."""

from __future__ import annotations

import os
from collections.abc import Iterable
from dataclasses import asdict, dataclass, field, fields
from typing import Any

import yaml
from pyspark.sql import DataFrame, SparkSession

from mailtally.functions.regex import has_groups, java_pattern
from mailtally.functions.text import DEFAULT_AMOUNT_REGEX, DEFAULT_CODE_REGEX

# --- fixed values: defaults of the rule format ---
DEFAULT_STRATEGY = "key_value_table"
DEFAULT_MERGE_KEYS = ("customer_code", "payment_due_label")
DEFAULT_CURRENCY = "JPY"
DEFAULT_LABEL = "Payment Due"
DEFAULT_TABLE_CODE = {"vertical_key_value": "請求先コード", "zip_rows_in_same_table": "コード"}
TABLE_STRATEGIES = ("zip_headers_to_row", "zip_rows_in_same_table", "zip_columns_across_tables")
DEFAULT_TABLE_AMOUNT = ".*支払額.*"
# --- end of fixed values ---


@dataclass(frozen=True)
class Rule:
    """One partner rule. ``order`` is its place in the file: the first success wins."""

    order: int
    name: str
    subject_regex: str
    strategy: str = DEFAULT_STRATEGY
    sender_email: str | None = None
    merge_keys: tuple[str, ...] = DEFAULT_MERGE_KEYS
    code_regex: str = DEFAULT_CODE_REGEX
    amount_regex: str = DEFAULT_AMOUNT_REGEX
    code_table: int | None = None
    amount_table: int | None = None
    prefix_code: str = ""
    currency: str = DEFAULT_CURRENCY
    default_label: str = DEFAULT_LABEL
    params: dict[str, Any] = field(default_factory=dict, compare=False)

    @property
    def whole_code(self) -> bool:
        """Codes longer than the format's 25 characters are none (``params.whole_code``)."""
        return bool(self.params.get("whole_code", False))

    @property
    def names_tables(self) -> bool:
        """The rule says in which tables the code and the amount are."""
        return self.amount_table is not None


def _document(source: str | dict[str, Any]) -> dict[str, Any]:
    if isinstance(source, dict):
        return source
    if isinstance(source, str):
        if os.path.isfile(source):
            with open(source, encoding="utf-8") as handle:
                loaded = yaml.safe_load(handle)
        else:
            loaded = yaml.safe_load(source)
        if isinstance(loaded, dict):
            return loaded
    raise ValueError(f"rules must be a dict, a YAML file or YAML text, got {source!r}")


def _rule(order: int, name: str, conf: dict[str, Any]) -> Rule:
    match = conf.get("match") or {}
    params = dict(conf.get("params") or {})
    subject = match.get("subject_regex") or conf.get("subject_regex") or conf.get("match_regex") or ""
    strategy = conf.get("strategy", DEFAULT_STRATEGY)
    common = dict(
        order=order,
        name=name,
        subject_regex=subject,
        strategy=strategy,
        sender_email=match.get("sender_email"),
        merge_keys=tuple(conf.get("merge_keys") or DEFAULT_MERGE_KEYS),
        prefix_code=str(conf.get("prefix_code") or params.get("prefix_code") or ""),
        currency=params.get("currency", DEFAULT_CURRENCY),
        default_label=params.get("default_label", DEFAULT_LABEL),
        params=params,
    )
    if "amount_source" in conf or "code_source" in conf or strategy in TABLE_STRATEGIES:
        code, amount = conf.get("code_source") or {}, conf.get("amount_source") or {}
        patterns = (DEFAULT_TABLE_CODE.get(strategy, "請求先コード"), DEFAULT_TABLE_AMOUNT)
        if strategy == DEFAULT_STRATEGY:  # reads text, whatever tables the rule names
            patterns = (
                params.get("code_regex", DEFAULT_CODE_REGEX),
                params.get("amount_regex", DEFAULT_AMOUNT_REGEX),
            )
        return Rule(
            **common,
            code_regex=code.get("target_regex") or patterns[0],
            amount_regex=amount.get("target_regex") or patterns[1],
            code_table=int(code.get("table_index", 0)),
            amount_table=int(amount.get("table_index", 0)),
        )
    return Rule(
        **common,
        code_regex=params.get("code_regex", DEFAULT_CODE_REGEX),
        amount_regex=params.get("amount_regex", DEFAULT_AMOUNT_REGEX),
    )


def load_rules(source: str | dict[str, Any], strategies: Iterable[str] | None = None) -> list[Rule]:
    """Read, order and check the rules. Rules without a subject pattern never match.

    Unknown strategies, broken patterns and code patterns with groups of their own
    are refused here, before any message is read.
    """
    from mailtally.operators.strategies import strategy_names

    known = set(strategies) if strategies is not None else set(strategy_names())
    rules = [
        _rule(i, name, conf or {})
        for i, (name, conf) in enumerate((_document(source).get("customers") or {}).items())
    ]
    for rule in rules:
        if rule.strategy not in known:
            raise ValueError(f"rule {rule.name}: unknown strategy {rule.strategy!r}")
        for pattern in (rule.subject_regex, rule.code_regex, rule.amount_regex):
            java_pattern(pattern)
        reads_text = rule.strategy == DEFAULT_STRATEGY or not rule.names_tables
        if reads_text and has_groups(rule.code_regex):
            raise ValueError(f"rule {rule.name}: code_regex must not hold groups, use (?:...)")
    return [r for r in rules if r.subject_regex]


def select_rules(rules: list[Rule], name: str = "ALL") -> list[Rule]:
    """Every rule, or the one of a partner."""
    return list(rules) if name == "ALL" else [r for r in rules if r.name == name]


def rules_frame(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    """The rules as a small table, for joins and for display."""
    rows = []
    for rule in rules:
        row = asdict(rule)
        row["rule_order"] = row.pop("order")
        row["merge_keys"] = list(rule.merge_keys)
        row["params"] = {k: str(v) for k, v in rule.params.items()}
        rows.append(row)
    schema = (
        "rule_order int, name string, subject_regex string, strategy string, sender_email string, "
        "merge_keys array<string>, code_regex string, amount_regex string, code_table int, "
        "amount_table int, prefix_code string, currency string, default_label string, "
        "params map<string,string>"
    )
    assert {f.name for f in fields(Rule)} - {"order"} <= set(schema.replace(",", " ").split())
    columns = [part.strip().split(" ")[0] for part in schema.split(", ")]
    return spark.createDataFrame([tuple(r[c] for c in columns) for r in rows], schema)
