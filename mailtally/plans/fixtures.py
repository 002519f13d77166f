"""Inputs of the registered queries, derived from the base tables with Column expressions.

Every view has one base table (two for joins), keeps its row count a fixed multiple of it
and needs no shuffle, so it scales with the table it comes from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

PARTNERS = ["Aoba Trading", "Birch Sports", "Cedar Mart", "ダリア商会", "Elm Stores"]
SENDERS = ["aoba", "birch", "cedar", "dahlia", "elm"]

KV_RULES = {
    "customers": {
        # Matches most subjects, finds no code: every message falls through to a later rule.
        "Decoy": {
            "subject_regex": "支払通知",
            "params": {"code_regex": "存在しない欄", "amount_regex": "支払額"},
        },
        "Aoba": {
            "subject_regex": "aoba\\s+trading|青葉",
            "params": {"code_regex": "請求先コード", "amount_regex": "支払額"},
        },
        "Birch": {
            "subject_regex": "BIRCH",
            "merge_keys": ["customer_code"],
            "params": {"code_regex": "コード", "amount_regex": "支払額|入金額", "prefix_code": "79"},
        },
        "Cedar": {
            "subject_regex": "Cedar.*支払",
            "params": {"code_regex": "請求先コード", "amount_regex": "支払額", "currency": "USD"},
        },
        "Dahlia": {
            "subject_regex": "ダリア",
            "params": {"code_regex": "請求先コード|Account\\s*No", "amount_regex": "支払額"},
        },
        "Elm": {
            "subject_regex": "^Elm",
            "params": {"code_regex": "請求先コード", "amount_regex": "支払額"},
        },
    }
}

TABLE_RULES = {
    "customers": {
        "Vertical": {
            "match": {"subject_regex": "vertical layout", "sender_email": None},
            "strategy": "vertical_key_value",
            "code_source": {"table_index": 0, "target_regex": "請求先コード"},
            "amount_source": {"table_index": 0, "target_regex": "(月|末) ?支払額$"},
        },
        "Headers": {
            "match": {"subject_regex": "headers layout", "sender_email": None},
            "strategy": "zip_headers_to_row",
            "code_source": {"table_index": 0, "is_header": True},
            "amount_source": {"table_index": 0, "target_regex": "(月|末) ?支払額$"},
        },
        "Rows": {
            "match": {"subject_regex": "rows layout", "sender_email": None},
            "strategy": "zip_rows_in_same_table",
            "code_source": {"table_index": 0, "target_regex": "^コード$"},
            "amount_source": {"table_index": 0, "target_regex": "(月|末) ?支払額$"},
            "prefix_code": "79",
        },
        "Columns": {
            "match": {"subject_regex": "columns layout", "sender_email": None},
            "strategy": "zip_columns_across_tables",
            "code_source": {"table_index": 0, "target_regex": "請求先コード"},
            "amount_source": {"table_index": 1, "target_regex": "振込金額$"},
        },
        "Pipe": {
            "match": {"subject_regex": "pipe layout", "sender_email": "tables@elm.example"},
            "strategy": "vertical_key_value",
            "code_source": {"table_index": 0, "target_regex": "請求先コード"},
            "amount_source": {"table_index": 0, "target_regex": "(月|末) ?支払額$"},
        },
    }
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def dealt(df: DataFrame) -> DataFrame:
    """Base rows of a fixture, dealt out to one task per core before bodies are built.

    The given tables come in one row group each, which no split size divides, and reading
    mail bodies is heavy on CPU. Landed messages come in many files and need no such step.
    """
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def _key(name: str, modulus: int) -> Column:
    return F.col(name) % modulus


def _received(orderdate: Column, key: Column) -> Column:
    seconds = F.make_dt_interval(secs=(key % 86400).cast("decimal(18,6)"))
    return orderdate.cast("timestamp") + seconds


def _list(values: list[str]) -> str:
    return "array(" + ", ".join(f"'{v}'" for v in values) + ")"


_RECEIVED = "CAST(o_orderdate AS TIMESTAMP) + make_dt_interval(0, 0, 0, CAST(o_orderkey % 86400 AS DECIMAL(18,6)))"
_ISO = "yyyy-MM-dd\\'T\\'HH:mm:ss\\'Z\\'"


def emails_kv(orders: DataFrame) -> DataFrame:
    """One labelled message per order; see KV_RULES. Message columns only."""
    base = orders.selectExpr(
        "o_orderkey AS k",
        "o_custkey AS c",
        "floor(o_totalprice) AS n",
        "date_format(o_orderdate, 'MM') AS mm",
        f"element_at({_list(PARTNERS)}, CAST(o_custkey % 5 AS INT) + 1) AS partner",
        f"element_at({_list(SENDERS)}, CAST(o_custkey % 5 AS INT) + 1) AS slug",
        f"{_RECEIVED} AS received_ts",
    )
    number = "format_number(n, 0)"
    notation = f"""CASE k % 6 WHEN 0 THEN concat('¥', {number}) WHEN 1 THEN concat('￥', {number})
        WHEN 2 THEN concat({number}, '円') WHEN 3 THEN concat('¥-', {number})
        WHEN 4 THEN concat('▲', {number}) ELSE concat('$', {number}, '.00') END"""
    due_row = (
        f"IF(k % 13 = 0, '', concat('<tr><td>', mm, '月 支払額</td><td>', {notation}, '</td></tr>'))"
    )
    body = f"""concat('<div><p>', partner, ' 御中</p><p>請求先コード: ', CAST(c + 100000 AS STRING),
        '</p>\\n<table><tr><td>総請求金額</td><td>', IF(k % 13 = 0, '', '¥'), format_number(n * 2, 0),
        '</td></tr>', {due_row}, '</table></div>')"""
    return base.selectExpr(
        "concat('m-', k) AS id",
        "IF(k % 11 = 0, 'Newsletter', concat(partner, ' 支払通知 ', mm)) AS subject",
        "concat('ar@', slug, '.example') AS email_sender",
        "concat(partner, ' AR') AS sender_name",
        f"date_format(received_ts, '{_ISO}') AS received_at",
        f"{body} AS html_body",
        "k % 4 = 0 AS has_attachments",
        "k % 2 = 1 AS is_read",
        "concat('c-', c) AS conversation_id",
        "received_ts",
    )


def payloads(messages: DataFrame) -> DataFrame:
    """Nested service payloads of flat messages; some leave out subject or sender."""
    digits = F.regexp_extract("id", r"(\d+)$", 1).cast("long")
    address = F.struct(F.col("email_sender").alias("address"), F.col("sender_name").alias("name"))
    return messages.select(
        "id",
        F.when(digits % 17 != 0, F.col("subject")).alias("subject"),
        F.when(digits % 19 != 0, F.struct(address.alias("emailAddress"))).alias("from"),
        F.col("received_at").alias("receivedDateTime"),
        F.struct(F.col("html_body").alias("content")).alias("body"),
        F.when(digits % 23 != 0, F.col("has_attachments")).alias("hasAttachments"),
        F.col("is_read").alias("isRead"),
        F.col("conversation_id").alias("conversationId"),
    )


LAYOUTS = ["vertical", "headers", "rows", "columns", "pipe"]


def emails_tables(orders: DataFrame) -> DataFrame:
    """One table message per order, five layouts by ``o_orderkey % 5``; see TABLE_RULES.

    An order gives ``1 + o_orderkey % 4`` codes; zip layouts end with a total column; every
    seventh message starts with a one-cell spacer table (not the pipe text).
    """
    base = orders.selectExpr(
        "o_orderkey AS k",
        "o_custkey AS c",
        "floor(o_totalprice) AS n",
        "o_orderkey % 5 AS layout",
        "CAST(o_orderkey % 4 AS INT) AS last_k",
        "concat(date_format(o_orderdate, 'MM'), '月 支払額') AS label",
        f"element_at({_list(LAYOUTS)}, CAST(o_orderkey % 5 AS INT) + 1) AS layout_name",
        f"element_at({_list(SENDERS)}, CAST(o_orderkey % 5 AS INT) + 1) AS slug",
        f"{_RECEIVED} AS received_ts",
    ).selectExpr(
        "*",
        "transform(sequence(0, last_k), i -> CAST(c * 10 + 1000000 + i AS STRING)) AS codes",
        "transform(sequence(0, last_k), i -> concat('¥', format_number(n + i * 1000, 0))) AS amounts",
        "concat('¥', format_number(n * (last_k + 1) + 500 * last_k * (last_k + 1), 0)) AS total",
    )

    def row(*cells: str) -> str:
        return f"concat('<tr><td>', array_join(concat({', '.join(cells)}), '</td><td>'), '</td></tr>')"

    def grid(*rows: str) -> str:
        return f"concat('<table>', {', '.join(rows)}, '</table>')"

    due = row("array(label)", "amounts", "array(total)")
    grids = f"""CASE layout
        WHEN 0 THEN {grid(row("array('請求先コード', codes[0])"), row("array(label, amounts[0])"))}
        WHEN 1 THEN {grid(row("array('項目')", "codes", "array('合計')"), due)}
        WHEN 2 THEN {grid(row("array('コード')", "codes", "array('合計')"), due)}
        WHEN 3 THEN concat({grid(row("array('請求先コード')", "codes"))}, {grid(row("array('振込金額')", "amounts"))})
        ELSE concat('請求先コード | ', codes[0], '<br>--- | ---<br>', label, ' | ', amounts[0]) END"""
    spacer = "IF(layout <> 4 AND k % 7 = 0, '<table><tr><td>お知らせ</td></tr></table>', '')"
    return base.selectExpr(
        "concat('t-', k) AS id",
        "concat(layout_name, ' Layout notice') AS subject",
        "concat('tables@', slug, '.example') AS email_sender",
        "'Tables AR' AS sender_name",
        f"date_format(received_ts, '{_ISO}') AS received_at",
        f"concat('<html><body>', {spacer}, {grids}, '</body></html>') AS html_body",
        "false AS has_attachments",
        "false AS is_read",
        "concat('c-', c) AS conversation_id",
        "received_ts",
    )


def emails_amounts(customer: DataFrame) -> DataFrame:
    """One amount text per customer in eight notations by ``c_custkey % 8``."""
    number = F.format_number(F.abs("c_acctbal"), 2)
    kind = _key("c_custkey", 8)
    text = (
        F.when(kind == 0, F.concat(F.lit("$"), number))
        .when(kind == 1, F.concat(F.lit("("), F.lit("£"), number, F.lit(")")))
        .when(kind == 2, F.concat(F.lit("△"), number))
        .when(kind == 3, F.concat(F.lit("  ¥-"), number, F.lit("　")))
        .when(kind == 4, F.concat(number, F.lit("円")))
        .when(kind == 5, F.lit("#DIV/0!"))
        .when(kind == 6, F.concat(F.lit("EUR "), number))
        .otherwise(F.concat(F.lit("N/A "), number))
    )
    return customer.select("c_custkey", text.alias("amount_text"))


def emails_meta(orders: DataFrame) -> DataFrame:
    """Report messages: optional resend prefix, year, week and report name in the subject."""
    day = F.col("o_orderdate")
    subject = F.concat(
        F.when(_key("o_orderkey", 3) == 0, F.lit("rerun of ")).otherwise(F.lit("")),
        F.lit("report"),
        _key("o_custkey", 10).cast("string"),
        F.lit(", year "),
        F.date_format(day, "yyyy"),
        F.lit(", week "),
        F.lpad(F.ceil(F.dayofyear(day) / F.lit(7)).cast("string"), 2, "0"),
        F.lit("W"),
    )
    in_body = _key("o_orderkey", 8) == 0
    return orders.select(
        F.concat(F.lit("r-"), F.col("o_orderkey").cast("string")).alias("id"),
        F.when(in_body, F.lit("Weekly notice")).otherwise(subject).alias("subject"),
        F.lit("noreply@reports.example").alias("email_sender"),
        F.when(in_body, F.concat(F.lit("<p>file: "), subject, F.lit(" attached</p>")))
        .otherwise(F.lit("<p>see attachment</p>"))
        .alias("html_body"),
        _received(day, F.col("o_orderkey")).alias("received_ts"),
    )


REPORT_HEADERS = ["Task", "Owner", "Done at", "Hours"]


def emails_report(events: DataFrame) -> DataFrame:
    """One report table per event: a header row and ``1 + event_id % 3`` data rows.

    Every tenth message has no Hours column; every seventh row time is not a time.
    """
    short = _key("event_id", 10) == 0
    rows = F.transform(
        F.sequence(F.lit(0), _key("event_id", 3).cast("int")),
        lambda k: F.concat(
            F.lit("<tr><td>"), F.col("event_type"), F.lit("-"), k.cast("string"),
            F.lit("</td><td>user"), F.col("user_id").cast("string"), F.lit("@mail.example</td><td>"),
            F.when((F.col("event_id") + k) % 7 == 0, F.lit("n/a")).otherwise(
                F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
            ),
            F.lit("</td>"),
            F.when(short, F.lit("")).otherwise(
                F.concat(F.lit("<td>"), F.col("value").cast("decimal(18,2)").cast("string"), F.lit("</td>"))
            ),
            F.lit("</tr>"),
        ),
    )
    header = F.concat(
        F.lit("<tr><th>Task</th><th>Owner</th><th>Done at</th>"),
        F.when(short, F.lit("")).otherwise(F.lit("<th>Hours</th>")),
        F.lit("</tr>"),
    )
    none = _key("event_id", 20) == 5
    return events.select(
        F.concat(F.lit("e-"), F.col("event_id").cast("string")).alias("id"),
        F.concat(F.lit("Weekly Report "), F.col("event_type")).alias("subject"),
        F.lit("noreply@reports.example").alias("email_sender"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("received_at"),
        F.when(none, F.lit("<p>nothing to report</p>"))
        .otherwise(F.concat(F.lit("<table>"), header, F.concat_ws("", rows), F.lit("</table>")))
        .alias("html_body"),
        F.concat(F.lit("u-"), F.col("user_id").cast("string")).alias("conversation_id"),
        F.col("ts").cast("timestamp").alias("received_ts"),
    )


# --- reconciliation -----------------------------------------------------------------------

def recon_source(lineitem: DataFrame) -> DataFrame:
    """Source side: status R becomes NULL; shipments of 1997-03 are not there."""
    return _recon_side(lineitem).filter(F.col("ship_month") != "1997-03")


def recon_target(lineitem: DataFrame) -> DataFrame:
    """Target side: lacks ``l_orderkey % 97 = 0`` and the month 1998-05."""
    return _recon_side(lineitem).filter(
        (F.col("l_orderkey") % 97 != 0) & (F.col("ship_month") != "1998-05")
    )


def _cents(col: str) -> Column:
    """Hundredths as a whole number: exact sums without a decimal per row."""
    return F.round(F.col(col) * 100).cast("long")


def _recon_side(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        "l_orderkey",
        F.when(F.col("l_returnflag") != "R", F.col("l_returnflag")).alias("return_flag"),
        F.col("l_linestatus").alias("line_status"),
        F.date_format("l_shipdate", "yyyy-MM").alias("ship_month"),
        F.to_date("l_shipdate").alias("ship_date"),
        _cents("l_quantity").alias("quantity"),
        _cents("l_extendedprice").alias("amount"),
        F.col("l_shipdate").alias("loaded_at"),
    )


# --- observability ------------------------------------------------------------------------

AS_OF_EVENTS = "2024-01-31 00:00:00"
AS_OF_ORDERS = "2001-08-31 00:00:00"


def _k(props: str = "props") -> Column:
    return F.regexp_extract(props, r"(\d+)", 1).cast("long")


def job_defs(orders: DataFrame) -> DataFrame:
    deleted = (F.col("o_orderstatus") == "F") & (_key("o_orderkey", 5) == 0)
    return orders.select(
        _key("o_custkey", 3).alias("workspace_id"),
        F.col("o_custkey").alias("job_id"),
        F.concat(F.lit("job-"), F.col("o_custkey").cast("string")).alias("name"),
        F.col("o_orderdate").alias("change_time"),
        F.when(deleted, F.col("o_orderdate")).alias("delete_time"),
        F.col("o_orderpriority").alias("tags"),
        F.col("o_orderkey").alias("version_id"),
    )


def job_runs(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    return events.select(
        _key("user_id", 3).alias("workspace_id"),
        F.col("user_id").alias("job_id"),
        F.col("event_id").alias("run_id"),
        F.when(kind == "view", F.lit("SUBMIT_RUN")).otherwise(F.lit("JOB_RUN")).alias("run_type"),
        F.col("ts").alias("period_start_time"),
        (F.col("ts") + F.make_dt_interval(secs=_k().cast("decimal(18,6)"))).alias("period_end_time"),
        F.when(kind == "error", F.lit("FAILED"))
        .when(kind == "signup", F.lit("TIMED_OUT"))
        .otherwise(F.lit("SUCCEEDED"))
        .alias("result_state"),
        F.when(kind == "error", F.lit("RUN_EXECUTION_ERROR"))
        .otherwise(F.lit("SUCCESS"))
        .alias("termination_code"),
        _k().alias("run_duration_seconds"),
        (_k() * 2).cast("double").alias("setup_duration"),
        F.col("value").alias("execution_duration"),
    )


def job_usage(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").alias("run_id"),
        (F.col("value") / 10).cast("decimal(18,4)").alias("usage"),
        F.when(_key("event_id", 3) == 0, F.lit("0.15"))
        .when(_key("event_id", 3) == 1, F.lit("0.30"))
        .otherwise(F.lit("0.55"))
        .cast("decimal(6,2)")
        .alias("price"),
    )


def task_runs(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("user_id").alias("run_id"),
        F.concat(F.lit("task-"), _key("event_id", 20).cast("string")).alias("task_key"),
        F.col("value").cast("decimal(18,2)").alias("duration"),
    )


def query_history(events: DataFrame) -> DataFrame:
    return events.select(
        F.concat(F.lit("stmt-"), _key("event_id", 20).cast("string")).alias("statement_id"),
        F.col("value").cast("decimal(18,2)").alias("duration"),
        (_k() * 1024).alias("spilled_bytes"),
        (_k() * 4096).alias("read_bytes"),
    )


def stage_metrics(events: DataFrame) -> DataFrame:
    """Exported stage records: one JSON text per row."""
    return events.select(
        F.to_json(
            F.struct(
                _key("event_id", 20).alias("stageId"),
                F.concat(F.lit("stage "), _key("event_id", 20).cast("string")).alias("name"),
                (_k() * 1024).alias("memoryBytesSpilled"),
                (_k() * 512).alias("diskBytesSpilled"),
                F.col("value").alias("executorRunTime"),
            )
        ).alias("stage")
    )


def lineage(lineitem: DataFrame) -> DataFrame:
    external = F.col("l_linenumber") == 4
    source = F.concat(F.lit("p_"), F.col("l_partkey").cast("string"))
    return lineitem.select(
        F.when(~external, source).alias("source_table_full_name"),
        F.concat(F.lit("s_"), F.col("l_suppkey").cast("string")).alias("target_table_full_name"),
        F.when(external, F.concat(F.lit("/lake/"), source)).alias("source_path"),
        F.lit(None).cast("string").alias("target_path"),
        (F.col("l_returnflag") != "R").alias("direct_access"),
        F.struct(
            F.struct(
                _key("l_orderkey", 150).alias("job_id"),
                F.col("l_orderkey").alias("job_run_id"),
            ).alias("job_info")
        ).alias("entity_metadata"),
        F.col("l_shipdate").alias("event_time"),
    )


def responses(part: DataFrame) -> DataFrame:
    """Free-text answers around a JSON object; some name an unknown column or have no JSON."""
    confidence = (F.lit(50) + _key("p_partkey", 50)) / 100
    columns = F.concat(
        F.lit('"p_name": "name '), F.col("p_partkey").cast("string"), F.lit('", "p_size": "'),
        F.col("p_type"), F.lit('"'),
        F.when(_key("p_partkey", 7) == 0, F.lit(', "p_ghost": "made up"')).otherwise(F.lit("")),
    )
    text = F.concat(
        F.lit("Here you are:\n{\n\"table_description\": \"Parts of "), F.col("p_brand"),
        F.lit('", "column_descriptions": {'), columns, F.lit('},\n"questions_for_steward": ["unit of '),
        F.col("p_name"), F.lit('?"], "confidence": '), confidence.cast("string"), F.lit("}\nRegards"),
    )
    return part.select(
        "p_partkey",
        F.when(_key("p_partkey", 31) == 0, F.lit("I cannot answer."))
        .when(_key("p_partkey", 37) == 0, F.lit("{broken: json"))
        .otherwise(text)
        .alias("response"),
    )


def documents_with_labels(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Left join, so that quality and toxic hold real NULLs."""
    return documents.select("doc_id", "lang", "source", "n_chars").join(labels, "doc_id", "left")
