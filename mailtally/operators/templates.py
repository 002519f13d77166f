"""Template intake: named metadata, header mapping, typed columns, lineage tags."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

import yaml
from pyspark.sql import Column, DataFrame, functions as F

from mailtally.functions.html import ROW, explode_rows, html_body, html_tables, html_to_text
from mailtally.functions.regex import group_index, java_pattern
from mailtally.operators.gates import by_sender, by_subject


@dataclass(frozen=True)
class Template:
    """A declared intake: which messages, which metadata, which table columns, which sinks."""

    pipeline_name: str
    top_n: int | None = None
    sender_contains: tuple[str, ...] = ()
    subject_must_contain: str = ""
    extractors: tuple[tuple[str, str, str], ...] = ()  # name, source, regex
    header_row: int = 0
    column_mapping: dict[str, str] = field(default_factory=dict)
    tables_enabled: bool = True
    data_table: str = ""
    audit_table: str = ""
    save_mode: str = "append"


def load_template(source: str | dict[str, Any]) -> Template:
    if isinstance(source, str):
        if "\n" not in source:
            with open(source, encoding="utf-8") as handle:
                source = handle.read()
        source = yaml.safe_load(source)
    if not isinstance(source, dict):
        raise ValueError("a template must be a mapping")
    wanted, tables = source.get("filter") or {}, source.get("table_extraction") or {}
    sink = source.get("sink") or {}
    return Template(
        pipeline_name=source["pipeline_name"],
        top_n=wanted.get("top_n"),
        sender_contains=tuple(wanted.get("sender_contains") or ()),
        subject_must_contain=wanted.get("subject_must_contain") or "",
        extractors=tuple(
            (e["name"], e.get("source", "subject_or_body"), e["regex"])
            for e in source.get("metadata_extractors") or ()
        ),
        header_row=int(tables.get("header_row", 0)),
        column_mapping=dict(tables.get("column_mapping") or {}),
        tables_enabled=bool(tables.get("enabled", True)),
        data_table=sink.get("data_table", ""),
        audit_table=sink.get("audit_table", ""),
        save_mode=sink.get("save_mode", "append"),
    )


def select_messages(messages: DataFrame, template: Template) -> DataFrame:
    """The template's sender and subject filters. Intake is never cut to ``top_n``."""
    if template.sender_contains:
        messages = by_sender(messages, template.sender_contains)
    if template.subject_must_contain:
        messages = by_subject(messages, template.subject_must_contain)
    return messages


def named_groups(source: Column, regex: str) -> dict[str, Column]:
    """A column per named group; null when the pattern is not found."""
    pattern = java_pattern(regex, ignore_case=False)
    found = source.rlike(pattern)
    return {
        name: F.when(found, F.regexp_extract(source, pattern, i))
        for name, i in group_index(regex).items()
    }


def extract_metadata(
    messages: DataFrame, regex: str, source: str = "subject_or_body", body: str = "html_body"
) -> DataFrame:
    """Named groups of the subject, else of the body text.

    Bodies are parsed only for messages whose subject has no match: the split is a filter
    before the parsing step, since a condition around it would not keep it from running.
    """
    pattern = java_pattern(regex, ignore_case=False)

    def with_groups(df: DataFrame, text: Column) -> DataFrame:
        return df.select("*", *[c.alias(n) for n, c in named_groups(text, regex).items()])

    if source == "subject":
        return with_groups(messages, F.col("subject"))
    if source == "body":
        parsed = messages.withColumn("_body_text", html_to_text(F.col(body)))
        return with_groups(parsed, F.col("_body_text")).drop("_body_text")
    in_subject = F.coalesce(F.col("subject").rlike(pattern), F.lit(False))
    from_subject = with_groups(messages.filter(in_subject), F.col("subject"))
    rest = messages.filter(~in_subject).withColumn("_body_text", html_to_text(F.col(body)))
    from_body = with_groups(rest, F.col("_body_text")).drop("_body_text")
    return from_subject.unionByName(from_body)


def read_once(
    messages: DataFrame, extractors: Sequence[tuple[str, str, str]], body: str = "html_body"
) -> DataFrame:
    """Named groups of all extractors, ``tables``, ``has_table`` and ``parse_failed``.

    One Arrow node reads text and tables of each body. A group comes from the subject if
    that matches, else from the body text, as far as the extractor's source allows.
    """
    parsed = messages.withColumn("_body", html_body(F.col(body)))
    found: dict[str, Column] = {}
    for _, source, regex in extractors:
        options = {"subject": ["subject"], "body": ["_body.text"]}.get(source, ["subject", "_body.text"])
        each = [named_groups(F.col(c), regex) for c in options]
        found |= {name: F.coalesce(*[groups[name] for groups in each]) for name in each[0]}
    tables = F.col("_body.tables")
    return parsed.select(
        *messages.columns,
        *[c.alias(name) for name, c in found.items()],
        tables.alias("tables"),
        (F.coalesce(F.size(tables), F.lit(0)) > 0).alias("has_table"),
        (F.col("_body.text").isNull() & F.col(body).isNotNull()).alias("parse_failed"),
    )


def with_tables(messages: DataFrame, body: str = "html_body") -> DataFrame:
    """Add ``tables``, ``has_table`` and ``parse_failed``."""
    parsed = messages.withColumn("tables", html_tables(F.col(body)))
    return parsed.select(
        "*",
        (F.coalesce(F.size("tables"), F.lit(0)) > 0).alias("has_table"),
        (F.col("tables").isNull() & F.col(body).isNotNull()).alias("parse_failed"),
    )


def table_headers(tables: Column, header_row: int) -> Column:
    """Header cells per table: ``map<table_index, cells>``."""
    rows = F.filter(tables, lambda r: r["row_index"] == header_row)
    return F.map_from_entries(
        F.transform(rows, lambda r: F.struct(r["table_index"], r["cells"]))
    )


def missing_columns(tables: Column, header_row: int, mapping: dict[str, str]) -> Column:
    """Mapped headers that no table of the message has, comma separated."""
    headers = F.flatten(
        F.transform(
            F.filter(tables, lambda r: r["row_index"] == header_row), lambda r: r["cells"]
        )
    )
    wanted = F.array(*[F.lit(h) for h in mapping])
    return F.array_join(F.array_except(wanted, headers), ", ")


def map_columns(
    messages: DataFrame, mapping: dict[str, str], header_row: int = 0, tables: str = "tables"
) -> DataFrame:
    """Rows below the header of each table, with the mapped headers as columns.

    A header that a table does not have gives null. Repeated headers count once, the
    first. Adds table_index and row_index.
    """
    headers = table_headers(F.col(tables), header_row)
    rows = F.filter(F.col(tables), lambda r: r["row_index"] > header_row)
    rest = [c for c in messages.columns if c != tables]
    exploded = explode_rows(messages, rows, *rest, headers.alias("_headers"))
    exploded = exploded.select(*rest, "_headers", f"{ROW}.*")
    row_headers = F.col("_headers")[F.col("table_index")]

    def cell(header: str) -> Column:
        place = F.array_position(row_headers, header).cast("int")
        return F.when(place > 0, F.get(F.col("cells"), place - 1))

    return exploded.select(
        *rest,
        "table_index",
        "row_index",
        *[cell(header).alias(name) for header, name in mapping.items()],
    )


def coerce(df: DataFrame, types: dict[str, str], flag: str = "schema_mismatch") -> DataFrame:
    """Cast columns; a value that does not fit becomes null and sets the flag."""

    def cast(name: str, kind: str) -> Column:
        if kind in ("timestamp", "timestamp_ntz"):
            return F.try_to_timestamp(F.col(name)).cast(kind)
        return F.col(name).try_cast(kind)

    lost = F.lit(False)
    for name, kind in types.items():
        lost = lost | (F.col(name).isNull() | cast(name, kind).isNull())
    flagged = df.withColumn(flag, lost)
    return flagged.withColumns({name: cast(name, kind) for name, kind in types.items()})


def tag_lineage(
    df: DataFrame, message_id: str = "id", received: str = "received_at",
    year: str = "year", week: str = "week",
) -> DataFrame:
    """Lineage columns of extracted rows, next to table_index."""
    have = set(df.columns)

    def optional(col: str) -> Column:
        return F.col(col) if col in have else F.lit(None).cast("string")

    return df.withColumns(
        {
            "email_message_id": F.col(message_id),
            "email_received_at": F.col(received),
            "extracted_year": optional(year),
            "extracted_week": optional(week),
        }
    )
