"""Queries of the sink, upsert, audit and streaming operators.

Each writes to a fresh place in the shared scratch folder and returns what was stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from mailtally.operators import sinks, upsert
from mailtally.operators.gates import after_watermark
from mailtally.operators.latest import newest_copy
from mailtally.operators.routing import route_first
from mailtally.operators.templates import (
    coerce,
    extract_metadata,
    load_template,
    map_columns,
    missing_columns,
)
from mailtally.plans import fixtures as fx
from mailtally.plans.intake import (
    medallion,
    run_template_intake,
    scheduled_intake,
)
from mailtally.plans.oracle import KV, RECORDS, REPORT
from mailtally.plans.queries_extract import META_REGEX, meta, report_tables
from mailtally.plans.queries_messages import STANDARD, STANDARD_SQL, kv, kv_rules, landed
from mailtally.plans.registry import fresh_table, query
from mailtally.schemas import STATE
from mailtally.session import scratch_path
from mailtally.sources.messages import standardize, stream_messages
from mailtally.streaming import corrections
from mailtally.streaming import intake as stream

AS_OF = fx.AS_OF_ORDERS
SPLIT = "2000-01-01 00:00:00"


def records(spark: SparkSession, sf: str) -> DataFrame:
    return route_first(kv(spark, sf), kv_rules(), label_mode="normalized")


SAVED = "customer_code, payment_due_label, payment_amount, email_unique_id"
SAVED_SQL = "customer_code, short_label AS payment_due_label, payment_amount, email_unique_id"
SAVED_COLUMNS = SAVED.split(", ")


@query(f"WITH {RECORDS} SELECT {SAVED_SQL}, TIMESTAMP '2001-08-31 09:00:00' AS last_update_s FROM rec")
def k_append(spark: SparkSession, sf: str) -> DataFrame:
    table = fresh_table("append")
    found = records(spark, sf).select(*SAVED_COLUMNS, "received_ts")
    early = F.col("received_ts") < F.lit(SPLIT).cast("timestamp")
    sinks.append(found.filter(early), table, as_of=AS_OF)
    sinks.append(found.filter(~early), table, as_of=AS_OF)
    sinks.append(found.filter(F.lit(False)), table, as_of=AS_OF)
    return spark.table(table).select(*SAVED_COLUMNS, "last_update_s")


LATEST_SQL = f"""
WITH {RECORDS} SELECT {SAVED_SQL} FROM rec
QUALIFY row_number() OVER (PARTITION BY customer_code, short_label ORDER BY ts DESC, email_unique_id DESC) = 1
"""


@query(LATEST_SQL)
def k_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Pure merge of later messages into the result of the earlier ones."""
    found = records(spark, sf)
    early = F.col("received_ts") < F.lit(SPLIT).cast("timestamp")
    keys = ["customer_code", "payment_due_label"]
    target = upsert.newest_per_merge_key(found.filter(early), keys)
    return upsert.merge_frames(target, found.filter(~early), keys).select(*SAVED_COLUMNS)


@query(LATEST_SQL)
def k_upsert_table(spark: SparkSession, sf: str) -> DataFrame:
    """The same through a stored table; the first batch is sent twice."""
    table = fresh_table("upsert")
    found = records(spark, sf)
    early = F.col("received_ts") < F.lit(SPLIT).cast("timestamp")
    keys = ["customer_code", "payment_due_label"]
    for batch in (found.filter(early), found.filter(~early), found.filter(early)):
        upsert.upsert(batch, table, keys, as_of=AS_OF)
    return spark.table(table).select(*SAVED_COLUMNS)


@query(LATEST_SQL.replace(SAVED_SQL, SAVED_SQL + ", strftime(ts, '%Y') AS year"))
def k_upsert_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    """A table partitioned by year: later rows of a key leave the partition of the earlier.

    Two batches with a key tuple each, and the first one once more.
    """
    table = fresh_table("parts")
    found = records(spark, sf).withColumn("year", F.date_format("received_ts", "yyyy"))
    early = F.col("received_ts") < F.lit(SPLIT).cast("timestamp")
    keys, turned = ["customer_code", "payment_due_label"], ["payment_due_label", "customer_code"]
    first, second = found.filter(early), found.filter(~early)
    upsert.upsert(first, table, keys, as_of=AS_OF, partition_by=["year"])
    upsert.upsert_all([(turned, second), (keys, first)], table, as_of=AS_OF)
    return spark.table(table).select(*SAVED_COLUMNS, "year")


@query(
    f"""
WITH {RECORDS}, e AS (
  SELECT {SAVED_SQL}, CASE WHEN k % 3 > 0 THEN strftime(ts, '%Y') END AS year FROM rec WHERE ts < TIMESTAMP '{SPLIT}'
  QUALIFY row_number() OVER (PARTITION BY customer_code, short_label ORDER BY ts DESC, email_unique_id DESC) = 1),
l AS (
  SELECT {SAVED_SQL} FROM rec WHERE ts >= TIMESTAMP '{SPLIT}'
  QUALIFY row_number() OVER (PARTITION BY customer_code, short_label ORDER BY ts DESC, email_unique_id DESC) = 1)
SELECT customer_code, payment_due_label, coalesce(l.payment_amount, e.payment_amount) AS payment_amount,
       coalesce(l.email_unique_id, e.email_unique_id) AS email_unique_id, e.year
FROM e FULL JOIN l USING (customer_code, payment_due_label)
"""
)
def k_upsert_null_partition(spark: SparkSession, sf: str) -> DataFrame:
    """Some rows have no year. The second batch lacks the column: what it finds keeps its
    year, what it adds joins the rows without one."""
    table = fresh_table("null_part")
    found = records(spark, sf)
    early = F.col("received_ts") < F.lit(SPLIT).cast("timestamp")
    number = F.regexp_extract("email_unique_id", r"(\d+)$", 1).cast("long")
    year = F.when(number % 3 > 0, F.date_format("received_ts", "yyyy"))
    keys = ["customer_code", "payment_due_label"]
    upsert.upsert(
        found.filter(early).withColumn("year", year), table, keys, as_of=AS_OF, partition_by=["year"]
    )
    upsert.upsert(found.filter(~early), table, keys, as_of=AS_OF)
    return spark.table(table).select(*SAVED_COLUMNS, "year")


@query(LATEST_SQL)
def k_upsert_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """A table with buckets of one key column, which two key tuples share."""
    table = fresh_table("buckets")
    found = records(spark, sf)
    early = F.col("received_ts") < F.lit(SPLIT).cast("timestamp")
    keys, turned = ["customer_code", "payment_due_label"], ["payment_due_label", "customer_code"]
    first, second = found.filter(early), found.filter(~early)
    upsert.upsert(first, table, keys, as_of=AS_OF, buckets=16, bucket_by=["customer_code"])
    upsert.upsert_all([(turned, second), (keys, first)], table, as_of=AS_OF)
    return spark.table(table).select(*SAVED_COLUMNS)


GROUPED = """
QUALIFY CASE WHEN c % 5 = 1 THEN row_number() OVER (PARTITION BY customer_code ORDER BY ts DESC, email_unique_id DESC)
        ELSE row_number() OVER (PARTITION BY customer_code, short_label ORDER BY ts DESC, email_unique_id DESC) END = 1
"""


@query(f"WITH {RECORDS} SELECT customer_name, {SAVED_SQL} FROM rec {GROUPED}")
def k_merge_grouped(spark: SparkSession, sf: str) -> DataFrame:
    """One partner merges on the code alone, the others on code and label."""
    table = fresh_table("grouped")
    upsert.upsert_grouped(records(spark, sf), kv_rules(), table, as_of=AS_OF)
    return spark.table(table).select("customer_name", *SAVED_COLUMNS)


@query(
    f"""
WITH {REPORT}, m AS (SELECT DISTINCT k, id, conversation_id, received_at, short, none FROM rep),
n AS (SELECT id, count(*) AS n FROM rep WHERE NOT none GROUP BY 1)
SELECT m.id AS message_id, conversation_id, received_at, TIMESTAMP '2024-01-31 00:00:00' AS processed_at,
       CASE WHEN none THEN 'NO_TABLE_FOUND' WHEN short THEN 'SCHEMA_MISMATCH' ELSE 'SUCCESS' END AS status,
       COALESCE(n, 0) AS rows_extracted,
       CASE WHEN none THEN 'no table in body' WHEN short THEN 'missing columns: Hours' END AS error_message
FROM m LEFT JOIN n USING (id)
"""
)
def k_audit(spark: SparkSession, sf: str) -> DataFrame:
    tables = report_tables(spark, sf)
    mapping = {"Task": "subject_text", "Owner": "sender", "Done at": "received_text", "Hours": "status_text"}
    checked = tables.withColumn("missing_columns", missing_columns(F.col("tables"), 0, mapping))
    rows = coerce(map_columns(tables, mapping), {"received_text": "timestamp_ntz"})
    log = sinks.audit(checked, rows, id_col="id", as_of=fx.AS_OF_EVENTS)
    return log.withColumn("processed_at", F.col("processed_at").cast("timestamp_ntz"))


TEMPLATE = {
    "pipeline_name": "weekly_report",
    "filter": {
        "top_n": 25,
        "sender_contains": ["NOREPLY@reports"],
        "subject_must_contain": "weekly report",
    },
    "metadata_extractors": [
        {"name": "kind", "source": "subject_or_body", "regex": r"Report (?P<kind>[a-z]+)"},
        {"name": "topic", "source": "subject", "regex": r"(?P<topic>[Ww]eekly [Rr]eport)"},
    ],
    "table_extraction": {
        "header_row": 0,
        "column_mapping": {"Task": "subject_text", "Owner": "sender_text", "Hours": "amount"},
    },
}


@query(
    f"""
WITH {REPORT} SELECT id AS email_message_id, regexp_extract(subject_text, '^[a-z]+') AS kind, CAST(i + 1 AS INTEGER) AS row_index,
       subject_text, sender_text, CAST(status_text AS DECIMAL(18,2)) AS amount, short AS schema_mismatch
FROM rep WHERE NOT none
"""
)
def k_template(spark: SparkSession, sf: str) -> DataFrame:
    """A declared intake, saved to its data and audit tables and read back."""
    names = {"data_table": fresh_table("data"), "audit_table": fresh_table("log")}
    template = load_template({**TEMPLATE, "sink": names})
    reports = fx.emails_report(fx.dealt(fx.table(spark, sf, "events")))
    run_template_intake(reports, template, {"amount": "decimal(18,2)"}, as_of=fx.AS_OF_EVENTS)
    return spark.table(template.data_table).select(
        "email_message_id", "kind", "row_index", "subject_text", "sender_text", "amount",
        "schema_mismatch",
    )


@query(
    f"""
WITH {RECORDS} SELECT email_unique_id, customer_code, CASE WHEN ts >= TIMESTAMP '2000-01-01' THEN currency END AS currency FROM rec
"""
)
def k_evolve(spark: SparkSession, sf: str) -> DataFrame:
    """The second batch brings a column the table did not have."""
    table = fresh_table("evolve")
    found = records(spark, sf).select("email_unique_id", "customer_code", "currency", "received_ts")
    early = F.col("received_ts") < F.lit(SPLIT).cast("timestamp")
    sinks.append(found.filter(early).drop("currency"), table, as_of=AS_OF)
    sinks.append(found.filter(~early), table, as_of=AS_OF, evolve=True)
    return spark.table(table).select("email_unique_id", "customer_code", "currency")


@query(
    """
SELECT strftime(o_orderdate, '%Y') AS year, count(*) AS messages FROM orders GROUP BY 1
"""
)
def k_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "partitioned")
    found = extract_metadata(meta(spark, sf), META_REGEX).drop("html_body")
    sinks.write_partitioned(found, path, ["year", "week"])
    stored = spark.read.schema(found.schema).parquet(path)
    return stored.groupBy("year").agg(F.count(F.lit(1)).alias("messages"))


@query(
    f"""
WITH {RECORDS} SELECT customer_name, currency, CAST(date_trunc('week', ts) AS DATE) AS week_start, count(*) AS records,
       CAST(sum(CAST(payment_amount AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS amount
FROM rec WHERE k % 17 <> 0 GROUP BY 1, 2, 3
"""
)
def k_gold(spark: SparkSession, sf: str) -> DataFrame:
    return medallion(spark, landed(spark, kv(spark, sf), "bronze"), kv_rules())


@query(
    f"""
WITH {KV} SELECT sender AS pipeline, 'tok-' || max(k) AS delta_token, count(*) AS emails_processed FROM kv GROUP BY 1
"""
)
def k_state(spark: SparkSession, sf: str) -> DataFrame:
    """State rows of several runs appended to a table, then read as the newest per pipeline."""
    table = fresh_table("state")
    sinks.create_table(spark, table, STATE)
    mails = kv(spark, sf)
    digits = F.regexp_extract("id", r"(\d+)$", 1).cast("long")
    per_sender = mails.groupBy(F.col("email_sender").alias("pipeline")).agg(
        F.concat(F.lit("tok-"), F.max(digits).cast("string")).alias("delta_token"),
        F.count(F.lit(1)).alias("emails_processed"),
        F.lit(0).cast("long").alias("records_extracted"),
    )
    for i, when in enumerate(["2001-08-30 00:00:00", AS_OF]):
        token = F.col("delta_token") if i else F.lit("tok-old")
        run = per_sender.select(
            "pipeline", token.alias("delta_token"), "emails_processed", "records_extracted",
            F.lit(when).cast("timestamp").alias("updated_at"),
        )
        run.write.insertInto(table)
    newest = sinks.latest_state(spark.table(table)).drop("updated_at")
    return newest.join(
        spark.table(table).filter(F.col("updated_at") == F.lit(AS_OF).cast("timestamp"))
        .select("pipeline", "emails_processed"), "pipeline",
    )


@query(f"WITH {RECORDS} SELECT {SAVED_SQL} FROM rec {GROUPED}")
def k_scheduled_intake(spark: SparkSession, sf: str) -> DataFrame:
    """The whole scheduled run, twice: the second run finds nothing new to store."""
    table, log, state = fresh_table("sink"), fresh_table("audit"), fresh_table("state")
    mails = kv(spark, sf)
    for _ in range(2):
        scheduled_intake(
            spark, mails, kv_rules(), table, log, state, as_of=AS_OF, label_mode="normalized"
        )
    return spark.table(table).select(*SAVED_COLUMNS)


ODD = """
odd AS (
  SELECT *, CASE WHEN k % 11 = 0 THEN 'unmatched' WHEN k % 5 = 0 THEN 'refused' WHEN k % 7 = 0 THEN 'empty'
                 WHEN k % 17 = 0 THEN 'untimed' WHEN k % 13 = 0 THEN 'undue' ELSE 'fine' END AS case_ FROM kv)
"""


def odd_mails(spark: SparkSession, sf: str) -> DataFrame:
    """Notices of which some have a broken body, an empty one or no readable time."""
    key = F.regexp_extract("id", r"(\d+)$", 1).cast("long")
    mails = kv(spark, sf)
    timed = (key % 11 == 0) | (key % 5 == 0) | (key % 7 == 0) | (key % 17 != 0)
    body = (
        F.when(key % 5 == 0, F.lit("<p>broken</p><![ foo"))
        .when(key % 7 == 0, F.lit(""))
        .otherwise(F.col("html_body"))
    )
    return mails.withColumns(
        {"html_body": body, "received_ts": F.when(timed, F.col("received_ts"))}
    )


@query(
    f"""
WITH {KV}, {ODD}
SELECT id AS message_id, received_at,
       CASE WHEN case_ IN ('refused', 'untimed') THEN 'FAILED' WHEN case_ = 'fine' THEN 'SUCCESS' ELSE 'NO_TABLE_FOUND' END AS status,
       CAST(CASE WHEN case_ = 'fine' THEN 1 ELSE 0 END AS BIGINT) AS rows_extracted,
       CASE case_ WHEN 'refused' THEN 'body could not be parsed' WHEN 'untimed' THEN 'no readable receive time'
                  WHEN 'unmatched' THEN 'no rule matches' WHEN 'fine' THEN NULL ELSE 'no record in body' END AS error_message
FROM odd
"""
)
def k_intake_audit(spark: SparkSession, sf: str) -> DataFrame:
    """What the log says of each message after one run."""
    table, log = fresh_table("sink"), fresh_table("audit")
    scheduled_intake(
        spark, odd_mails(spark, sf), kv_rules(), table, log, as_of=AS_OF, label_mode="normalized"
    )
    return spark.table(log).select(
        "message_id", "received_at", "status", "rows_extracted", "error_message"
    )


@query(
    f"""
WITH {KV}, {ODD}, a AS (SELECT * FROM odd WHERE ts < TIMESTAMP '{SPLIT}'), w AS (
  SELECT max(ts) - INTERVAL 7 DAYS AS bound FROM a WHERE case_ = 'fine'),
b AS (SELECT odd.* FROM odd, w WHERE case_ = 'untimed' OR ts >= bound AND (ts >= TIMESTAMP '{SPLIT}' OR case_ = 'refused')),
r AS (SELECT 1 AS run, * FROM a UNION ALL SELECT 2 AS run, * FROM b)
SELECT run, strftime(max(ts) FILTER (case_ <> 'untimed'), '%Y-%m-%dT%H:%M:%S.000') AS delta_token,
       count(*) AS emails_processed, count(*) FILTER (case_ = 'fine') AS records_extracted FROM r GROUP BY run
"""
)
def k_intake_state(spark: SparkSession, sf: str) -> DataFrame:
    """The state after each of two runs; the second one reads what failed once more."""
    table, log, state = fresh_table("sink"), fresh_table("audit"), fresh_table("state")
    mails = odd_mails(spark, sf)
    stated = F.to_timestamp("received_at")
    early = mails.filter(stated < F.lit(SPLIT).cast("timestamp"))
    for batch in (early, mails):
        scheduled_intake(
            spark, batch, kv_rules(), table, log, state, as_of=AS_OF, label_mode="normalized"
        )
    run = F.when(F.col("delta_token") < SPLIT, 1).otherwise(2)
    return spark.table(state).select(
        run.alias("run"), "delta_token", "emails_processed", "records_extracted"
    )


# --- streaming --------------------------------------------------------------------------------


def _landing(spark: SparkSession, sf: str, name: str) -> str:
    return landed(spark, kv(spark, sf), name)


@query(STANDARD_SQL)
def m_stream_intake(spark: SparkSession, sf: str) -> DataFrame:
    path, out = _landing(spark, sf, "stream-in"), scratch_path(spark, "stream-out")
    flat = stream.messages_stream(stream_messages(spark, path))
    stream.drain(stream.append_stream(flat, out, scratch_path(spark, "offsets")))
    return spark.read.schema(flat.schema).parquet(out).select(*STANDARD)


@query(f"WITH {KV} SELECT id, received_at FROM kv")
def m_stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every message lands twice in one run; one copy of each comes out.

    The payloads land compressed, in a file per core: what is written is mostly they.
    """
    path = scratch_path(spark, "twice")
    payload = fx.payloads(kv(spark, sf))
    for _ in range(2):
        payload.write.mode("append").json(path, compression="gzip")
    flat = stream.dedup_stream(standardize(stream_messages(spark, path)))
    out = scratch_path(spark, "dedup-out")
    stream.drain(stream.append_stream(flat.select("id", "received_at", "received_ts"), out, scratch_path(spark, "offsets")))
    return spark.read.parquet(out).select("id", "received_at")


@query(
    LATEST_SQL.replace("FROM rec", "FROM rec WHERE k % 17 <> 0")
)
def m_stream_upsert(spark: SparkSession, sf: str) -> DataFrame:
    path, table = _landing(spark, sf, "upsert-in"), fresh_table("stream")
    flat = standardize(stream_messages(spark, path, max_files=4))
    two_keys = [_with_keys(r, ("customer_code", "payment_due_label")) for r in kv_rules()]
    query_ = stream.upsert_stream(
        flat, two_keys, table, scratch_path(spark, "offsets"), as_of=AS_OF, label_mode="normalized"
    )
    stream.drain(query_)
    return spark.table(table).select(*SAVED_COLUMNS)


STREAM_ODD = """
odd AS (
  SELECT *, CASE WHEN k % 5 = 0 AND k % 11 > 0 AND k % 17 > 0 THEN 'refused' WHEN k % 19 = 0 THEN 'untimed'
                 WHEN k % 11 = 0 OR k % 17 = 0 THEN 'unmatched'
                 WHEN k % 7 = 0 THEN 'empty' WHEN k % 13 = 0 THEN 'undue' ELSE 'fine' END AS case_ FROM kv)
"""


def _odd_stream(spark: SparkSession, sf: str) -> tuple[str, str, str]:
    """The odd notices through the streaming intake, in batches of 4 files: its tables.

    Some have no subject as payloads, and some are given a time here that cannot be read.
    """
    names = [fresh_table(x) for x in ("stream", "stream_audit", "stream_state")]
    number = F.regexp_extract("id", r"(\d+)$", 1).cast("long")
    stated = F.when(number % 19 == 0, F.lit("soon")).otherwise(F.col("received_at"))
    path = landed(spark, odd_mails(spark, sf).withColumn("received_at", stated), "odd-in")
    flat = standardize(stream_messages(spark, path, max_files=4))
    run = stream.intake_stream(
        flat, kv_rules(), *names, scratch_path(spark, "offsets"), as_of=AS_OF, label_mode="normalized"
    )
    stream.drain(run)
    return tuple(names)


@query(
    f"""
WITH {KV}, {STREAM_ODD}
SELECT id AS message_id,
       CASE WHEN case_ IN ('refused', 'untimed') THEN 'FAILED' WHEN case_ = 'fine' THEN 'SUCCESS' ELSE 'NO_TABLE_FOUND' END AS status,
       CAST(CASE WHEN case_ = 'fine' THEN 1 ELSE 0 END AS BIGINT) AS rows_extracted,
       CASE case_ WHEN 'refused' THEN 'body could not be parsed' WHEN 'untimed' THEN 'no readable receive time'
                  WHEN 'unmatched' THEN 'no rule matches' WHEN 'fine' THEN NULL ELSE 'no record in body' END AS error_message
FROM odd
"""
)
def m_stream_audit(spark: SparkSession, sf: str) -> DataFrame:
    """The audit log of a stream: one row of each message, whatever batch it came in."""
    _, log, _ = _odd_stream(spark, sf)
    return spark.table(log).select("message_id", "status", "rows_extracted", "error_message")


@query(
    f"""
WITH {KV}, {STREAM_ODD}
SELECT strftime(max(ts) FILTER (k % 19 <> 0), '%Y-%m-%dT%H:%M:%S.000') AS delta_token,
       count(*) AS emails_processed, count(*) FILTER (case_ = 'fine') AS records_extracted FROM odd
"""
)
def m_stream_state(spark: SparkSession, sf: str) -> DataFrame:
    """The state rows of a stream's batches, taken together."""
    _, _, state = _odd_stream(spark, sf)
    return spark.table(state).agg(
        F.max("delta_token").alias("delta_token"),
        F.sum("emails_processed").alias("emails_processed"),
        F.sum("records_extracted").alias("records_extracted"),
    )


def _with_keys(rule, keys):
    from dataclasses import replace

    return replace(rule, merge_keys=keys)


@query(LATEST_SQL.replace("FROM rec", "FROM rec WHERE k % 17 <> 0"))
def m_late_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Corrections that come late, in a second run: newer ones overwrite, older ones do not."""
    path, table, offsets = scratch_path(spark, "late-up"), fresh_table("late"), scratch_path(spark, "offsets")
    mails = kv(spark, sf)
    key = F.regexp_extract("id", r"(\d+)$", 1).cast("long")
    rules = [_with_keys(r, ("customer_code", "payment_due_label")) for r in kv_rules()]
    for part in (key % 2 == 0, key % 2 == 1):
        fx.payloads(mails.filter(part)).write.mode("append").json(path)
        flat = standardize(stream_messages(spark, path))
        stream.drain(
            stream.upsert_stream(flat, rules, table, offsets, as_of=AS_OF, label_mode="normalized")
        )
    return spark.table(table).select(*SAVED_COLUMNS)


def _corrected(spark: SparkSession, sf: str, parts: list, days: int) -> DataFrame:
    """The notices of each part in a run of their own, through the state of merge keys."""
    path, table, offsets = scratch_path(spark, "corr-in"), fresh_table("corrected"), scratch_path(spark, "offsets")
    mails = kv(spark, sf)
    rules = [_with_keys(r, ("customer_code", "payment_due_label")) for r in kv_rules()]
    for part in parts:
        fx.payloads(mails.filter(part)).write.mode("append").json(path)
        flat = standardize(stream_messages(spark, path))
        stream.drain(
            corrections.correction_stream(
                flat, rules, table, offsets, days=days, as_of=AS_OF, label_mode="normalized"
            )
        )
    return spark.table(table).select(*SAVED_COLUMNS)


@query(LATEST_SQL.replace("FROM rec", "FROM rec WHERE k % 17 <> 0"))
def m_corrections(spark: SparkSession, sf: str) -> DataFrame:
    """As ``m_late_upsert``, with the newest record of each key in state and a look-back that
    holds all: what the table holds in the end is the same."""
    odd = F.regexp_extract("id", r"(\d+)$", 1).cast("long") % 2 == 1
    return _corrected(spark, sf, [~odd, odd], days=36500)


@query(
    LATEST_SQL.replace("rec AS (", "w AS (SELECT max(ts) - INTERVAL 7 DAYS AS b FROM kv WHERE k % 2 = 0),\nrec AS (", 1)
    .replace("FROM rec", "FROM rec, w WHERE k % 17 <> 0 AND (k % 2 = 0 OR ts > b)")
)
def m_corrections_late(spark: SparkSession, sf: str) -> DataFrame:
    """Corrections of a second run that lie behind the look-back of the first are ignored."""
    odd = F.regexp_extract("id", r"(\d+)$", 1).cast("long") % 2 == 1
    return _corrected(spark, sf, [~odd, odd], days=7)


@query(
    f"""
WITH {KV}, w AS (SELECT max(ts) - INTERVAL 7 DAYS AS b FROM kv WHERE ts < TIMESTAMP '2000-01-01')
SELECT id, received_at FROM kv, w WHERE ts < TIMESTAMP '2000-01-01' OR ts >= b
"""
)
def m_late(spark: SparkSession, sf: str) -> DataFrame:
    """A second run sends everything again: what is behind the look-back of the first run,
    or was seen in it, is dropped."""
    path, out, offsets = (scratch_path(spark, n) for n in ("late-in", "late-out", "offsets"))
    mails = kv(spark, sf)
    first = mails.filter(F.col("received_ts") < F.lit(SPLIT).cast("timestamp"))
    for batch in (first, mails):
        fx.payloads(batch).write.mode("append").json(path)
        flat = stream.dedup_stream(standardize(stream_messages(spark, path)))
        slim = flat.select("id", "received_at", "received_ts")
        stream.drain(stream.append_stream(slim, out, offsets))
    return spark.read.parquet(out).select("id", "received_at")


@query(
    f"""
WITH {KV}, w AS (SELECT max(ts) - INTERVAL 7 DAYS AS b FROM kv WHERE ts < TIMESTAMP '2000-01-01')
SELECT id, received_at FROM kv, w WHERE ts >= b
"""
)
def m_late_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Batch twin of the late rule."""
    mails = newest_copy(kv(spark, sf), "id")
    stored = mails.filter(F.col("received_ts") < F.lit(SPLIT).cast("timestamp"))
    return after_watermark(mails, stored).select("id", "received_at")


