"""Queries of the scan and gate operators."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from mailtally.operators import gates
from mailtally.operators.profile import dq_split
from mailtally.operators.routing import matched_rules, route_all, route_first
from mailtally.operators.sinks import latest_state
from mailtally.plans import fixtures as fx
from mailtally.plans.oracle import KV, RECON, RECORD_COLUMNS, RECORDS, TABLES
from mailtally.plans.registry import fresh_table, query
from mailtally.schemas import PAYLOAD_WITH_ATTACHMENTS
from mailtally.session import scratch_path
from mailtally.sources import attachments as att
from mailtally.sources import catalog, messages as msg
from mailtally.sources.rules import load_rules, rules_frame, select_rules

RECORD = [c.strip() for c in RECORD_COLUMNS.split(",")]


def kv(spark: SparkSession, sf: str) -> DataFrame:
    return fx.emails_kv(fx.dealt(fx.table(spark, sf, "orders")))


def kv_rules() -> list:
    return load_rules(fx.KV_RULES)


def landed(spark: SparkSession, messages: DataFrame, name: str) -> str:
    """Write payloads of messages as JSON lines to the shared scratch folder."""
    path = scratch_path(spark, name)
    fx.payloads(messages).write.json(path)
    return path


STANDARD_SQL = f"""
WITH {KV}
SELECT id, CASE WHEN k % 17 = 0 THEN '' ELSE subject END AS subject,
       CASE WHEN k % 19 = 0 THEN '' ELSE sender END AS email_sender,
       CASE WHEN k % 19 = 0 THEN '' ELSE partner || ' AR' END AS sender_name,
       received_at, CASE WHEN k % 23 = 0 THEN FALSE ELSE k % 4 = 0 END AS has_attachments,
       k % 2 = 1 AS is_read, 'c-' || c AS conversation_id
FROM kv
"""
STANDARD = [
    "id", "subject", "email_sender", "sender_name", "received_at", "has_attachments", "is_read",
    "conversation_id",
]


@query(STANDARD_SQL)
def s_message_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = landed(spark, kv(spark, sf), "payloads")
    return msg.standardize(msg.read_messages(spark, path)).select(*STANDARD)


@query(STANDARD_SQL)
def s_standardize(spark: SparkSession, sf: str) -> DataFrame:
    return msg.standardize(fx.payloads(kv(spark, sf))).select(*STANDARD)


@query(f"WITH {KV} SELECT id, subject, received_at FROM kv ORDER BY ts DESC, id DESC LIMIT 50")
def s_latest_n(spark: SparkSession, sf: str) -> DataFrame:
    return msg.latest_n(kv(spark, sf), 50).select("id", "subject", "received_at")


@query(
    f"""
WITH {KV} SELECT sender AS email_sender, id, received_at FROM kv
QUALIFY row_number() OVER (PARTITION BY sender ORDER BY ts DESC, id DESC) <= 50
"""
)
def s_latest_n_per_mailbox(spark: SparkSession, sf: str) -> DataFrame:
    return msg.latest_n(kv(spark, sf), 50, per="email_sender").select("email_sender", "id", "received_at")


@query(f"WITH {KV} SELECT id, received_at FROM kv WHERE ts >= TIMESTAMP '1999-06-01 00:00:00'")
def s_since(spark: SparkSession, sf: str) -> DataFrame:
    return msg.since(kv(spark, sf), "1999-06-01 00:00:00").select("id", "received_at")


@query(f"WITH {KV} SELECT id, received_at FROM kv WHERE ts >= TIMESTAMP '2001-07-02 00:00:00'")
def f_days_back(spark: SparkSession, sf: str) -> DataFrame:
    return msg.days_back(kv(spark, sf), 60, fx.AS_OF_ORDERS).select("id", "received_at")


def _with_attachments(documents: DataFrame) -> DataFrame:
    """One message per document; the text comes as two attachments, or none for some."""
    key = F.col("doc_id")

    def one(i: int, content: Column) -> Column:
        return F.struct(
            F.concat(F.lit("a-"), key.cast("string"), F.lit(f"-{i}")).alias("id"),
            F.concat(F.col("source"), F.lit(f"-{i}.txt")).alias("name"),
            F.lit("text/plain").alias("contentType"),
            F.octet_length(content).cast("long").alias("size"),
            F.base64(content.cast("binary")).alias("contentBytes"),
        )

    both = F.array(one(0, F.col("text")), one(1, F.col("lang")))
    return documents.select(
        F.concat(F.lit("d-"), key.cast("string")).alias("id"),
        F.when(key % 9 != 0, both).alias("attachments"),
    )


@query(
    """
SELECT 'd-' || doc_id AS message_id, source || '-' || i || '.txt' AS name,
       CASE WHEN i = 0 THEN text ELSE lang END AS content,
       CAST(strlen(CASE WHEN i = 0 THEN text ELSE lang END) AS BIGINT) AS size
FROM documents, (SELECT unnest([0, 1]) AS i) WHERE doc_id % 9 <> 0
UNION ALL SELECT 'd-' || doc_id, NULL, NULL, NULL FROM documents WHERE doc_id % 9 = 0
"""
)
def s_attachments(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "attachments")
    _with_attachments(fx.table(spark, sf, "documents")).write.json(path)
    raw = msg.read_messages(spark, path, PAYLOAD_WITH_ATTACHMENTS)
    return att.attachments(raw).select(
        "message_id", "name", F.col("content").cast("string").alias("content"), "size"
    )


CSV_SCHEMA = T.StructType(
    [
        T.StructField("part_key", T.LongType()),
        T.StructField("quantity", T.DoubleType()),
        T.StructField("status", T.StringType()),
    ]
)


@query(
    """
SELECT l_orderkey AS order_key, CAST(1 AS INTEGER) AS line_number, l_partkey AS part_key,
       CASE WHEN l_linenumber = 3 THEN NULL ELSE l_quantity END AS quantity, l_linestatus AS status
FROM lineitem
"""
)
def s_attachment_csv(spark: SparkSession, sf: str) -> DataFrame:
    line = fx.table(spark, sf, "lineitem")
    text = F.concat(
        F.lit("part_key,quantity,status\r\n"),
        F.concat_ws(
            ",",
            F.col("l_partkey").cast("string"),
            F.when(F.col("l_linenumber") == 3, F.lit("many")).otherwise(F.col("l_quantity").cast("string")),
            "l_linestatus",
        ),
        F.lit("\n"),
    )
    mails = line.select(F.col("l_orderkey").alias("order_key"), text.alias("text"))
    return att.attachment_csv(mails, CSV_SCHEMA)


@query(
    """
SELECT event_type AS pipeline, arg_max('tok-' || event_id, ts) AS delta_token, max(ts) AS updated_at
FROM events GROUP BY 1
"""
)
def s_latest_state(spark: SparkSession, sf: str) -> DataFrame:
    state = fx.table(spark, sf, "events").select(
        F.col("event_type").alias("pipeline"),
        F.concat(F.lit("tok-"), F.col("event_id").cast("string")).alias("delta_token"),
        F.col("ts").alias("updated_at"),
    )
    return latest_state(state)


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 10")
def s_sample(spark: SparkSession, sf: str) -> DataFrame:
    orders = fx.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return catalog.sample_rows(orders, 10, ["o_orderkey"])


@query(
    """
SELECT 'doc_id' AS "column", 'bigint' AS data_type, '' AS comment, avg(CASE WHEN doc_id IS NULL THEN 1.0 ELSE 0.0 END) AS null_pct FROM documents LEFT JOIN labels USING (doc_id)
UNION ALL SELECT 'lang', 'string', '', avg(CASE WHEN lang IS NULL THEN 1.0 ELSE 0.0 END) FROM documents LEFT JOIN labels USING (doc_id)
UNION ALL SELECT 'source', 'string', '', avg(CASE WHEN source IS NULL THEN 1.0 ELSE 0.0 END) FROM documents LEFT JOIN labels USING (doc_id)
UNION ALL SELECT 'n_chars', 'bigint', '', avg(CASE WHEN n_chars IS NULL THEN 1.0 ELSE 0.0 END) FROM documents LEFT JOIN labels USING (doc_id)
UNION ALL SELECT 'quality', 'int', '', avg(CASE WHEN quality IS NULL THEN 1.0 ELSE 0.0 END) FROM documents LEFT JOIN labels USING (doc_id)
UNION ALL SELECT 'toxic', 'int', '', avg(CASE WHEN toxic IS NULL THEN 1.0 ELSE 0.0 END) FROM documents LEFT JOIN labels USING (doc_id)
"""
)
def s_data_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    docs = fx.documents_with_labels(fx.table(spark, sf, "documents"), fx.table(spark, sf, "labels"))
    return catalog.documented_columns(docs)


ANALYZED = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double", "o_orderstatus": None}


@query(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {f'CAST(min({c}) AS DOUBLE)' if kind else 'NULL::DOUBLE'} AS min_value,
        {f'CAST(max({c}) AS DOUBLE)' if kind else 'NULL::DOUBLE'} AS max_value,
        count(*) - count({c}) AS num_nulls, true AS distinct_close FROM orders"""
        for c, kind in ANALYZED.items()
    )
)
def s_analyze(spark: SparkSession, sf: str) -> DataFrame:
    """Catalog statistics; their distinct counts are approximate and held against exact ones."""
    name = fresh_table("analyze")
    orders = fx.table(spark, sf, "orders").select(*ANALYZED)
    orders.write.saveAsTable(name)
    exact = None
    for c in ANALYZED:
        one = orders.select(c).distinct().agg(F.lit(c).alias("_column"), F.count(c).alias("_exact"))
        exact = one if exact is None else exact.union(one)
    found = catalog.analyze(spark, name).join(exact, F.col("column") == F.col("_column"))
    off = F.abs(F.col("distinct_count").cast("long") - F.col("_exact"))
    return found.select(
        "column",
        F.col("min").try_cast("double").alias("min_value"),
        F.col("max").try_cast("double").alias("max_value"),
        F.col("num_nulls").cast("long").alias("num_nulls"),
        (off <= 0.15 * F.col("_exact") + 1).alias("distinct_close"),  # three times the error of 5 %
    )


@query("SELECT 'lineitem.parquet' AS file_name, count(*) AS rows, 'LOADED' AS bronze_status FROM lineitem")
def s_file_audit(spark: SparkSession, sf: str) -> DataFrame:
    log = catalog.file_audit(fx.table(spark, sf, "lineitem"))
    name = F.regexp_extract("input_file_name", "[^/]+$", 0)
    return log.select(name.alias("file_name"), "rows", "bronze_status")


@query(
    """
SELECT o_orderkey AS order_key, CAST(CASE WHEN q.i = 0 THEN o_custkey ELSE o_orderkey END AS BIGINT) AS part_key,
       CAST(o_totalprice AS DOUBLE) AS quantity,
       CASE WHEN q.i = 0 THEN 'first' || chr(10) || 'line, ' || o_orderstatus ELSE 'say "so"' END AS status
FROM orders, (SELECT unnest([0, 1]) AS i) q
"""
)
def s_attachment_quoted(spark: SparkSession, sf: str) -> DataFrame:
    """Quoted values with line breaks, separators and doubled quotes."""
    key, price = F.col("o_orderkey").cast("string"), F.col("o_totalprice").cast("double").cast("string")
    text = F.concat(
        F.lit("part_key,quantity,status\r\n"),
        F.col("o_custkey").cast("string"), F.lit(","), price, F.lit(',"first\nline, '), F.col("o_orderstatus"), F.lit('"\r\n'),
        key, F.lit(","), price, F.lit(',"say ""so"""\n'),
    )
    mails = fx.table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_key"), text.alias("text"))
    schema = "part_key bigint, quantity double, status string"
    return att.attachment_csv(mails, T.StructType.fromDDL(schema)).drop("line_number")


# --- routing and filters --------------------------------------------------------------------


@query(f"WITH {RECORDS} SELECT {RECORD_COLUMNS} FROM rec")
def f_route_first(spark: SparkSession, sf: str) -> DataFrame:
    return route_first(kv(spark, sf), kv_rules()).select(*RECORD)


EVERYONE = {
    "customers": {
        **fx.KV_RULES["customers"],
        "Everyone": {
            "subject_regex": "支払",
            "params": {"code_regex": "請求先コード", "amount_regex": "支払額"},
        },
    }
}


@query(
    f"""
WITH {RECORDS}
SELECT {RECORD_COLUMNS} FROM rec
UNION ALL
SELECT 'Everyone', CAST(100000 + c AS VARCHAR), payment_amount, payment_due_label, 'JPY',
       email_unique_id, email_subject, email_sender, email_received_at FROM rec
"""
)
def f_route_all(spark: SparkSession, sf: str) -> DataFrame:
    return route_all(kv(spark, sf), load_rules(EVERYONE)).select(*RECORD)


@query(
    f"""
WITH {KV}
SELECT id, rule AS rule_name, c % 5 + 1 AS rule_order FROM (SELECT *, CAST(c % 5 AS INTEGER) AS z FROM kv) WHERE is_notice
UNION ALL SELECT id, 'Decoy', 0 FROM kv WHERE is_notice
UNION ALL SELECT id, 'Everyone', 6 FROM kv WHERE is_notice
"""
)
def f_matched_rules(spark: SparkSession, sf: str) -> DataFrame:
    hits = matched_rules(kv(spark, sf), load_rules(EVERYONE))
    return hits.select("id", "rule_name", F.col("rule_order").cast("long").alias("rule_order"))


@query(
    f"""
WITH {KV}, r(rule_order, name, strategy, merge_keys) AS (VALUES
  (0, 'Decoy', 'key_value_table', 'customer_code,payment_due_label'), (1, 'Aoba', 'key_value_table', 'customer_code,payment_due_label'),
  (2, 'Birch', 'key_value_table', 'customer_code'), (3, 'Cedar', 'key_value_table', 'customer_code,payment_due_label'),
  (4, 'Dahlia', 'key_value_table', 'customer_code,payment_due_label'), (5, 'Elm', 'key_value_table', 'customer_code,payment_due_label'))
SELECT CAST(rule_order AS INTEGER) AS rule_order, name, strategy, merge_keys,
       (SELECT count(*) FROM kv WHERE is_notice AND (name = 'Decoy' OR rule = name)) AS messages FROM r
"""
)
def s_rules(spark: SparkSession, sf: str) -> DataFrame:
    """The loaded rules with the number of messages each one matches."""
    rules = kv_rules()
    counts = matched_rules(kv(spark, sf), rules).groupBy(F.col("rule_name").alias("name")).agg(
        F.count(F.lit(1)).alias("messages")
    )
    table = rules_frame(spark, rules).select(
        "rule_order", "name", "strategy", F.array_join("merge_keys", ",").alias("merge_keys")
    )
    return table.join(counts, "name", "left").select(
        "rule_order", "name", "strategy", "merge_keys", F.coalesce("messages", F.lit(0)).alias("messages")
    )


@query(f"WITH {RECORDS} SELECT {RECORD_COLUMNS} FROM rec WHERE customer_name = 'Birch'")
def f_customer(spark: SparkSession, sf: str) -> DataFrame:
    return route_all(kv(spark, sf), select_rules(kv_rules(), "Birch")).select(*RECORD)


@query(f"WITH {KV} SELECT id, sender AS email_sender FROM kv WHERE c % 5 IN (0, 4)")
def f_sender(spark: SparkSession, sf: str) -> DataFrame:
    return gates.by_sender(kv(spark, sf), ["AR@aoba", "elm.example"]).select("id", "email_sender")


@query(f"WITH {KV} SELECT id, subject FROM kv WHERE is_notice AND c % 5 = 2")
def f_subject(spark: SparkSession, sf: str) -> DataFrame:
    return gates.by_subject(kv(spark, sf), "CEDAR mart").select("id", "subject")


SENDER_RULES = {
    "customers": {
        "ElmOnly": {
            "match": {"subject_regex": "支払通知", "sender_email": "ar@elm.example"},
            "params": {"code_regex": "請求先コード", "amount_regex": "支払額"},
        },
        "Anyone": {
            "match": {"subject_regex": "Aoba", "sender_email": None},
            "params": {"code_regex": "請求先コード", "amount_regex": "支払額"},
        },
    }
}


@query(
    f"""
WITH {RECORDS} SELECT CASE WHEN c % 5 = 4 THEN 'ElmOnly' ELSE 'Anyone' END AS customer_name, customer_code,
       payment_amount, email_unique_id FROM rec WHERE c % 5 IN (0, 4)
"""
)
def f_rule_sender(spark: SparkSession, sf: str) -> DataFrame:
    routed = route_first(kv(spark, sf), load_rules(SENDER_RULES))
    return routed.select("customer_name", "customer_code", "payment_amount", "email_unique_id")


@query(f"WITH {KV} SELECT id, has FROM (SELECT id, k % 4 = 0 AS has, c FROM kv) WHERE has AND c % 5 = 3")
def f_has_attachments(spark: SparkSession, sf: str) -> DataFrame:
    chosen = gates.MessageFilter(kv(spark, sf)).by_has_attachments().by_sender("dahlia").results()
    return chosen.select("id", F.col("has_attachments").alias("has"))


def _stored(messages: DataFrame) -> DataFrame:
    """Messages up to mid 2000 as the stored side of the gates; every 29th has no id."""
    digits = F.regexp_extract("id", r"(\d+)$", 1).cast("long")
    stored = messages.filter(F.col("received_ts") < F.lit("2000-07-01").cast("timestamp"))
    return stored.select(
        F.when(digits % 29 != 0, F.col("id")).alias("email_unique_id"), "received_ts"
    )


@query(
    f"""
WITH {KV} SELECT id, received_at FROM kv
WHERE ts >= (SELECT max(ts) - INTERVAL 7 DAYS FROM kv WHERE ts < TIMESTAMP '2000-07-01')
"""
)
def f_watermark(spark: SparkSession, sf: str) -> DataFrame:
    mails = kv(spark, sf)
    return gates.after_watermark(mails, _stored(mails)).select("id", "received_at")


@query(
    f"""
WITH {KV}, bound AS (SELECT max(ts) - INTERVAL 7 DAYS AS b FROM kv WHERE ts < TIMESTAMP '2000-07-01')
SELECT id, received_at FROM kv, bound
WHERE ts >= b AND id NOT IN (SELECT id FROM kv WHERE ts < TIMESTAMP '2000-07-01' AND k % 29 <> 0 AND ts >= (SELECT b FROM bound))
"""
)
def f_unprocessed(spark: SparkSession, sf: str) -> DataFrame:
    mails = kv(spark, sf)
    stored = _stored(mails)
    fresh = gates.unprocessed(gates.after_watermark(mails, stored), stored)
    return fresh.select("id", "received_at")


@query(f"WITH {KV} SELECT id, is_notice AND has_due AS valid FROM kv WHERE is_notice")
def f_valid(spark: SparkSession, sf: str) -> DataFrame:
    mails = kv(spark, sf)
    notices = mails.filter(F.col("subject") != "Newsletter").select("id")
    records = route_first(mails, kv_rules()).select(F.col("email_unique_id").alias("id")).distinct()
    flagged = records.withColumn("valid", F.lit(True))
    return notices.join(flagged, "id", "left").select("id", F.coalesce("valid", F.lit(False)).alias("valid"))


@query(
    f"""
WITH {TABLES} SELECT customer_name, count(*) AS records, 0 AS totals FROM tabrec
WHERE layout IN (1, 2) GROUP BY 1
"""
)
def f_totals(spark: SparkSession, sf: str) -> DataFrame:
    mails = fx.emails_tables(fx.dealt(fx.table(spark, sf, "orders")))
    rules = [r for r in load_rules(fx.TABLE_RULES) if r.name in ("Headers", "Rows")]
    records = route_all(mails, rules, drop_spacers=True)
    total = F.count_if(F.col("customer_code").isin("合計", "79合計", "-")).cast("int")
    return records.groupBy("customer_name").agg(F.count(F.lit(1)).alias("records"), total.alias("totals"))


# --- business-date guards -------------------------------------------------------------------

GUARD_DAY = date(1998, 9, 2)


@query(
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1998-09-02' AND l_shipdate < TIMESTAMP '1998-09-03'
"""
)
def f_guard(spark: SparkSession, sf: str) -> DataFrame:
    day = gates.anchor_date(spark, "Asia/Tokyo", "1998-09-01 18:00:00")
    line = gates.guard(fx.table(spark, sf, "lineitem"), "l_shipdate", day)
    return line.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


@query(
    f"""
WITH {RECON}
SELECT max(d) AS loaded_date FROM (
  SELECT DISTINCT CAST(loaded_at AS DATE) AS d FROM src WHERE loaded_at < TIMESTAMP '1998-05-20'
  INTERSECT SELECT DISTINCT CAST(loaded_at AS DATE) FROM tgt)
"""
)
def f_last_loaded(spark: SparkSession, sf: str) -> DataFrame:
    line = fx.table(spark, sf, "lineitem")
    anchor = date(1998, 5, 19)  # the target has no rows of that month
    return gates.last_loaded_date(fx.recon_source(line), fx.recon_target(line), "loaded_at", anchor)


# --- data-quality split -----------------------------------------------------------------------

DQ_BASE = "SELECT lang, source, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)"


def _dq(spark: SparkSession, sf: str) -> DataFrame:
    docs = fx.documents_with_labels(fx.table(spark, sf, "documents"), fx.table(spark, sf, "labels"))
    return docs.select("lang", "source", "quality", "toxic")


@query(f"SELECT * FROM ({DQ_BASE}) WHERE quality IS NOT NULL")
def f_dq_ok(spark: SparkSession, sf: str) -> DataFrame:
    return dq_split(_dq(spark, sf), F.col("quality").isNotNull())[0]


@query(f"SELECT * FROM ({DQ_BASE}) EXCEPT SELECT * FROM ({DQ_BASE}) WHERE quality IS NOT NULL")
def f_dq_bad(spark: SparkSession, sf: str) -> DataFrame:
    return dq_split(_dq(spark, sf), F.col("quality").isNotNull())[1]


@query(f"SELECT * FROM ({DQ_BASE}) WHERE quality IS NULL")
def u_subtract(spark: SparkSession, sf: str) -> DataFrame:
    return dq_split(_dq(spark, sf), F.col("quality").isNotNull(), keep_duplicates=True)[1]


