"""End-to-end plans built from the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from mailtally.operators.enrich import intake_summary, total_amount, weekly
from mailtally.operators.gates import (
    LOOK_BACK_DAYS,
    after_watermark,
    unaudited,
    unprocessed,
    watermark,
)
from mailtally.operators.routing import (
    explode_records,
    extract_every,
    extract_first,
    newest_extract,
    route_all,
)
from mailtally.operators.sinks import append, audit, audit_extracts, state_row
from mailtally.operators.templates import (
    Template,
    coerce,
    map_columns,
    missing_columns,
    read_once,
    select_messages,
    tag_lineage,
)
from mailtally.operators.upsert import upsert_grouped
from mailtally.session import RunFolder
from mailtally.sources.messages import read_messages, standardize
from mailtally.sources.rules import Rule, select_rules



def scheduled_intake(
    spark: SparkSession,
    messages: DataFrame,
    rules: list[Rule],
    table: str,
    audit_table: str | None = None,
    state_table: str | None = None,
    pipeline: str = "intake",
    tz: str = "Asia/Tokyo",
    as_of: str | None = None,
    label_mode: str = "line",
    days: int = LOOK_BACK_DAYS,
) -> int:
    """Watermark, processed-id gate, routing, grouped upsert, audit and state.

    The messages are read once: a slim row of each, with its records and how its reading
    ended, is written to a run folder, and records, audit and state come from there. With an
    audit table the gate skips messages that it settled within the look-back; failed ones are
    read again. Messages without a readable time are audited as failed and store nothing.
    Returns the upserted rows.
    """
    fresh = messages
    if spark.catalog.tableExists(table):
        target = spark.table(table)
        fresh = after_watermark(fresh, target, days)
        if audit_table and spark.catalog.tableExists(audit_table):
            fresh = unaudited(fresh, spark.table(audit_table), watermark(target, days))
        else:
            fresh = unprocessed(fresh, target, days=days)
    with RunFolder(spark, "intake") as run:
        extracts = newest_extract(extract_every(fresh, rules, label_mode=label_mode))
        extracts = run.keep(extracts, "extracts")
        timed = extracts.filter(F.col("received_ts").isNotNull())
        saved = upsert_grouped(explode_records(timed), rules, table, tz, as_of, stored=True)
        if audit_table:
            append(audit_extracts(extracts, as_of=as_of), audit_table, tz, as_of)
        if state_table:
            before = spark.table(state_table) if spark.catalog.tableExists(state_table) else None
            append(run.keep(state_row(extracts, pipeline, before, as_of), "state"), state_table, tz, as_of)
        return saved


def table_intake(
    messages: DataFrame, rules: list[Rule], customer: str = "ALL", drop_spacers: bool = False,
    as_of: str | None = None,
) -> DataFrame:
    """Every matching rule's records with ``ingested_at`` (UTC, ISO text)."""
    instant = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    records = route_all(messages, select_rules(rules, customer), drop_spacers)
    stamp = F.date_format(F.to_utc_timestamp(instant, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ssxxx")
    return records.withColumn("ingested_at", stamp)


def template_intake(
    messages: DataFrame,
    template: Template,
    types: dict[str, str] | None = None,
    as_of: str | None = None,
    run: RunFolder | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Declared intake: filter, metadata, table rows, types, lineage. Rows and audit log.

    Each of the two reads a body once, whatever the number of extractors. With ``run``, what
    the bodies hold is written there and both come from it, so that they are read once in all.
    With table extraction off, messages give one row each, of metadata alone.
    """
    read = read_once(select_messages(messages, template), template.extractors)
    read = run.keep(read.drop("html_body"), "read") if run else read
    mapping = template.column_mapping if template.tables_enabled else {}
    if template.tables_enabled:
        rows = map_columns(read.drop("html_body"), mapping, template.header_row)
        absent = missing_columns(F.col("tables"), template.header_row, mapping)
    else:
        rows = read.drop("html_body", "tables").withColumns(
            {"table_index": F.lit(None).cast("int"), "row_index": F.lit(None).cast("int")}
        )
        read, absent = read.withColumn("has_table", F.lit(True)), F.lit("")
    rows = tag_lineage(coerce(rows, {k: v for k, v in (types or {}).items() if k in rows.columns}))
    below = F.size(F.filter("tables", lambda r: r["row_index"] > template.header_row))
    found = below if template.tables_enabled else F.lit(1)
    checked = read.drop("html_body").withColumn("missing_columns", absent)
    return rows, audit(checked, found, as_of=as_of)


def save_template_intake(
    rows: DataFrame, log: DataFrame, template: Template, tz: str = "Asia/Tokyo", as_of: str | None = None
) -> int:
    """Write both results to the template's tables; new columns are let in.

    The template's save mode holds for the data, the log is always appended to.
    """
    _known_mode(template)
    with RunFolder(rows.sparkSession, "template") as run:
        return _store(run.keep(rows, "rows"), run.keep(log, "log"), template, tz, as_of)


def run_template_intake(
    messages: DataFrame,
    template: Template,
    types: dict[str, str] | None = None,
    tz: str = "Asia/Tokyo",
    as_of: str | None = None,
) -> int:
    """``template_intake`` and ``save_template_intake`` in one run that reads the bodies once."""
    _known_mode(template)
    with RunFolder(messages.sparkSession, "template") as run:
        rows, log = template_intake(messages, template, types, as_of, run)
        return _store(rows, log, template, tz, as_of)


def _known_mode(template: Template) -> None:
    if template.save_mode not in ("append", "overwrite"):
        raise ValueError(f"unknown save mode {template.save_mode!r}")


def _store(rows: DataFrame, log: DataFrame, template: Template, tz: str, as_of: str | None) -> int:
    replace = template.save_mode == "overwrite"
    saved = append(rows, template.data_table, tz, as_of, evolve=True, overwrite=replace)
    append(log, template.audit_table, tz, as_of, evolve=True)
    return saved


def medallion(spark: SparkSession, landing: str, rules: list[Rule], label_mode: str = "normalized") -> DataFrame:
    """Bronze, silver, gold: landed payloads, typed records of the newest message per key,
    weekly amounts per partner and currency."""
    bronze = standardize(read_messages(spark, landing))
    silver = explode_records(newest_extract(extract_first(bronze, rules, label_mode=label_mode)))
    return weekly(
        silver,
        ["customer_name", "currency"],
        "received_ts",
        {
            "records": F.count(F.lit(1)),
            "amount": total_amount(),
        },
    )


__all__ = [
    "intake_summary",
    "medallion",
    "run_template_intake",
    "save_template_intake",
    "scheduled_intake",
    "table_intake",
    "template_intake",
]
