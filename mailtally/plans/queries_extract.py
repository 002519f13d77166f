"""Queries of the text, HTML and table extraction operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from mailtally.functions import html, money, responses, text
from mailtally.operators import templates
from mailtally.operators.routing import route_all, route_first
from mailtally.operators.strategies import EXTRACTS, Body, apply_strategy
from mailtally.plans import fixtures as fx
from mailtally.plans.oracle import KV, META, RECORD_COLUMNS, RECORDS, REPORT, RESPONSES, TABLES
from mailtally.plans.queries_messages import RECORD, kv, kv_rules
from mailtally.plans.registry import query
from mailtally.sources.rules import load_rules


def table_mails(spark: SparkSession, sf: str) -> DataFrame:
    return fx.emails_tables(fx.dealt(fx.table(spark, sf, "orders")))


def table_rules(*names: str) -> list:
    return [r for r in load_rules(fx.TABLE_RULES) if not names or r.name in names]


# --- HTML -------------------------------------------------------------------------------------


@query(
    r"""
WITH cut AS (
  SELECT page_id, regexp_replace(html, '(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->|<![^>]*>', ' ', 'g') AS h FROM pages),
broken AS (SELECT page_id, regexp_replace(h, '<br[^>]*>|</p>|</div>|</tr>|</article>', chr(10), 'g') AS h FROM cut),
bare AS (SELECT page_id, regexp_replace(h, '<[^>]*>', ' ', 'g') AS h FROM broken),
plain AS (SELECT page_id, regexp_replace(replace(replace(replace(h, '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;?', '&', 'g') AS h FROM bare),
lines AS (SELECT page_id, list_filter(list_transform(string_split(h, chr(10)), lambda l: trim(regexp_replace(l, ' +', ' ', 'g'))), lambda l: l <> '') AS ls FROM plain)
SELECT page_id, array_to_string(ls, chr(10)) AS body_text, CAST(len(ls) AS BIGINT) AS line_count FROM lines
"""
)
def t_html_text(spark: SparkSession, sf: str) -> DataFrame:
    pages = fx.dealt(fx.table(spark, sf, "pages").select("page_id", "html"))
    read = pages.select("page_id", html.html_to_text("html").alias("t"))
    single = F.regexp_replace("t", " +", " ")
    lines = F.size(text.lines_of(F.col("t"))).cast("long")
    return read.select("page_id", single.alias("body_text"), lines.alias("line_count"))


@query(
    f"""
WITH {KV}
SELECT id, partner || ' 御中' || chr(10) || '請求先コード: ' || (100000 + c) || chr(10) || '総請求金額 ' ||
       CASE WHEN has_due THEN '¥' ELSE '' END || format('{{:,}}', n * 2) ||
       CASE WHEN has_due THEN chr(10) || mm || '月 支払額 ' || notation ELSE '' END AS body_text
FROM kv
"""
)
def t_html_text_mails(spark: SparkSession, sf: str) -> DataFrame:
    return kv(spark, sf).select("id", html.html_to_text("html_body").alias("body_text"))


GRID_SQL = f"""
WITH {TABLES},
cells AS (
  SELECT id, layout, k, label, last_k, n, list(code ORDER BY i) AS codes,
         list('¥' || format('{{:,}}', amount) ORDER BY i) AS numbers,
         '¥' || format('{{:,}}', CAST(sum(amount) AS BIGINT)) AS total
  FROM tb GROUP BY ALL),
grid AS (
  SELECT id, layout, k, 0 AS t, 0 AS row_index, CASE layout WHEN 0 THEN ['請求先コード', codes[1]]
         WHEN 1 THEN list_concat(['項目'], codes, ['合計']) WHEN 2 THEN list_concat(['コード'], codes, ['合計'])
         WHEN 3 THEN list_concat(['請求先コード'], codes) ELSE ['請求先コード', codes[1]] END AS c FROM cells
  UNION ALL
  SELECT id, layout, k, CASE WHEN layout = 3 THEN 1 ELSE 0 END, CASE WHEN layout = 3 THEN 0 ELSE 1 END,
         CASE layout WHEN 0 THEN [label, numbers[1]] WHEN 1 THEN list_concat([label], numbers, [total])
         WHEN 2 THEN list_concat([label], numbers, [total]) WHEN 3 THEN list_concat(['振込金額'], numbers)
         ELSE [label, numbers[1]] END FROM cells),
spaced AS (
  SELECT id, layout, t + CASE WHEN k % 7 = 0 AND layout <> 4 THEN 1 ELSE 0 END AS table_index, row_index, c FROM grid
  UNION ALL SELECT id, layout, 0, 0, ['お知らせ'] FROM cells WHERE k % 7 = 0 AND layout <> 4)
"""


def _grids(df: DataFrame) -> DataFrame:
    return html.explode_tables(df).select(
        "id", "table_index", "row_index", F.array_join("cells", "|").alias("cells")
    )


GRID_COLUMNS = "CAST(table_index AS INTEGER) AS table_index, CAST(row_index AS INTEGER) AS row_index, array_to_string(c, '|') AS cells"


@query(f"{GRID_SQL} SELECT id, {GRID_COLUMNS} FROM spaced")
def t_tables(spark: SparkSession, sf: str) -> DataFrame:
    mails = table_mails(spark, sf)
    return _grids(mails.select("id", html.html_tables("html_body").alias("tables")))


@query(f"{GRID_SQL} SELECT id, {GRID_COLUMNS} FROM spaced WHERE layout = 4")
def t_pipe(spark: SparkSession, sf: str) -> DataFrame:
    mails = table_mails(spark, sf).filter(F.col("subject").startswith("pipe"))
    return _grids(mails.select("id", html.html_tables("html_body").alias("tables")))


@query(
    f"""
{GRID_SQL} SELECT id, CAST(t AS INTEGER) AS table_index, CAST(row_index AS INTEGER) AS row_index,
array_to_string(c, '|') AS cells FROM grid
"""
)
def f_spacer(spark: SparkSession, sf: str) -> DataFrame:
    read = table_mails(spark, sf).select("id", html.html_tables("html_body").alias("tables"))
    return _grids(read.withColumn("tables", html.drop_spacer_tables(F.col("tables"))))


# --- amounts and codes ------------------------------------------------------------------------

ABS = "CAST(CAST(abs(c_acctbal) AS DECIMAL(18,2)) AS DOUBLE)"


@query(
    f"""
SELECT c_custkey, CASE WHEN c_custkey % 8 IN (1, 2, 3) THEN -{ABS} WHEN c_custkey % 8 IN (0, 4, 6) THEN {ABS} END AS amount
FROM customer
"""
)
def t_currency(spark: SparkSession, sf: str) -> DataFrame:
    mails = fx.emails_amounts(fx.table(spark, sf, "customer"))
    return mails.select("c_custkey", money.clean_amount("amount_text").alias("amount"))


@query(
    f"""
SELECT c_custkey, CASE WHEN c_custkey % 8 IN (2, 3) THEN -{ABS} WHEN c_custkey % 8 = 4 THEN {ABS} END AS amount
FROM customer
"""
)
def t_currency_jp(spark: SparkSession, sf: str) -> DataFrame:
    mails = fx.emails_amounts(fx.table(spark, sf, "customer"))
    return mails.select("c_custkey", money.clean_amount_yen("amount_text").alias("amount"))


def _read(spark: SparkSession, sf: str) -> DataFrame:
    """Text and lines of the labelled messages."""
    read = kv(spark, sf).select("id", html.html_to_text("html_body").alias("text"))
    return read.withColumn("lines", text.lines_of(F.col("text")))


@query(f"WITH {KV} SELECT id, CAST(100000 + c AS VARCHAR) AS code FROM kv")
def t_code(spark: SparkSession, sf: str) -> DataFrame:
    code = text.extract_code("text", "lines", "請求先コード|コード")
    return _read(spark, sf).select("id", code.alias("code"))


@query(
    f"""
WITH {KV} SELECT id, CASE WHEN has_due THEN amount END AS amount,
       CASE WHEN has_due THEN mm || '月 支払額 ' || notation END AS label FROM kv
"""
)
def t_amount(spark: SparkSession, sf: str) -> DataFrame:
    due = text.extract_amount("lines", "支払額")
    read = _read(spark, sf).select("id", due.alias("due"))
    return read.select("id", "due.amount", "due.label")


@query(
    """
SELECT c_custkey, CASE WHEN starts_with(CAST(c_custkey AS VARCHAR), '7') THEN '' ELSE '7' END || c_custkey AS code
FROM customer
"""
)
def t_prefix(spark: SparkSession, sf: str) -> DataFrame:
    customer = fx.table(spark, sf, "customer")
    return customer.select("c_custkey", text.prefix_code(F.col("c_custkey").cast("string"), "7").alias("code"))


@query(
    f"""
WITH {RECORDS} SELECT customer_name, customer_code, payment_amount, short_label AS payment_due_label, currency,
       email_unique_id, email_subject, email_sender, email_received_at FROM rec
"""
)
def t_extract_kv(spark: SparkSession, sf: str) -> DataFrame:
    return route_first(kv(spark, sf), kv_rules(), label_mode="normalized").select(*RECORD)


# --- table strategies -------------------------------------------------------------------------


def _strategy(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return route_all(table_mails(spark, sf), table_rules(name), drop_spacers=True).select(*RECORD)


def _strategy_sql(layouts: str) -> str:
    return f"WITH {TABLES} SELECT {RECORD_COLUMNS} FROM tabrec WHERE layout IN ({layouts})"


@query(_strategy_sql("0"))
def t_vertical(spark: SparkSession, sf: str) -> DataFrame:
    return _strategy(spark, sf, "Vertical")


@query(_strategy_sql("1"))
def t_zip_headers(spark: SparkSession, sf: str) -> DataFrame:
    return _strategy(spark, sf, "Headers")


@query(_strategy_sql("2"))
def t_zip_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _strategy(spark, sf, "Rows")


@query(_strategy_sql("3"))
def t_zip_columns(spark: SparkSession, sf: str) -> DataFrame:
    return _strategy(spark, sf, "Columns")


@query(_strategy_sql("0, 1, 2, 3, 4"))
def t_table_records(spark: SparkSession, sf: str) -> DataFrame:
    return route_all(table_mails(spark, sf), table_rules(), drop_spacers=True).select(*RECORD)


@query(
    f"""
WITH {TABLES} SELECT tb0.id, count(email_unique_id) AS records, coalesce(sum(payment_amount), 0.0) AS amount
FROM tb0 LEFT JOIN (SELECT * FROM tabrec WHERE layout = 2) r ON tb0.id = email_unique_id GROUP BY tb0.id
"""
)
def t_strategy_column(spark: SparkSession, sf: str) -> DataFrame:
    """A strategy used as a plain column, outside of routing."""
    read = table_mails(spark, sf).select("id", "subject", html.html_tables("html_body").alias("tables"))
    read = read.withColumn("tables", html.drop_spacer_tables(F.col("tables")))
    body = Body(tables="tables")
    rows_rule = apply_strategy(body, table_rules("Rows")[0]).cast(EXTRACTS)
    wanted = F.when(F.col("subject").startswith("rows"), rows_rule)
    found = read.select("id", F.coalesce(wanted, F.array().cast(EXTRACTS)).alias("r"))
    total = F.aggregate("r", F.lit(0.0), lambda acc, r: acc + r["payment_amount"])
    return found.select("id", F.size("r").cast("long").alias("records"), total.alias("amount"))


# --- templates --------------------------------------------------------------------------------

META_REGEX = r"(?P<report_name>report\w+), year (?P<year>\d{4}), week (?P<week>\d{2}W)"


def meta(spark: SparkSession, sf: str) -> DataFrame:
    return fx.emails_meta(fx.dealt(fx.table(spark, sf, "orders")))


@query(f"WITH {META} SELECT id, year, week, report_name FROM meta")
def t_metadata(spark: SparkSession, sf: str) -> DataFrame:
    found = templates.extract_metadata(meta(spark, sf), META_REGEX)
    return found.select("id", "year", "week", "report_name")


MAPPING = {
    "Task": "subject_text",
    "Owner": "sender_text",
    "Done at": "received_text",
    "Hours": "status_text",
}


def report_tables(spark: SparkSession, sf: str) -> DataFrame:
    return templates.with_tables(fx.emails_report(fx.dealt(fx.table(spark, sf, "events"))))


def report_rows(spark: SparkSession, sf: str) -> DataFrame:
    return templates.map_columns(report_tables(spark, sf), MAPPING)


@query(
    f"""
WITH {REPORT} SELECT id, CAST(i + 1 AS INTEGER) AS row_index, subject_text, sender_text, received_text, status_text
FROM rep WHERE NOT none
"""
)
def t_column_map(spark: SparkSession, sf: str) -> DataFrame:
    return report_rows(spark, sf).select("id", "row_index", *MAPPING.values())


@query(
    f"""
WITH {REPORT} SELECT id, CAST(i + 1 AS INTEGER) AS row_index,
       CASE WHEN received_text <> 'n/a' THEN ts_second END AS received_text,
       CAST(status_text AS DECIMAL(18,2)) AS status_text, received_text = 'n/a' OR short AS schema_mismatch
FROM rep WHERE NOT none
"""
)
def t_coerce(spark: SparkSession, sf: str) -> DataFrame:
    types = {"received_text": "timestamp_ntz", "status_text": "decimal(18,2)"}
    typed = templates.coerce(report_rows(spark, sf), types)
    return typed.select("id", "row_index", "received_text", "status_text", "schema_mismatch")


@query(
    f"""
WITH {REPORT} SELECT id AS email_message_id, received_at AS email_received_at,
       CAST(NULL AS VARCHAR) AS extracted_year, CAST(NULL AS VARCHAR) AS extracted_week,
       CAST(0 AS INTEGER) AS table_index, CAST(i + 1 AS INTEGER) AS row_index, subject_text
FROM rep WHERE NOT none
"""
)
def t_lineage_cols(spark: SparkSession, sf: str) -> DataFrame:
    tagged = templates.tag_lineage(report_rows(spark, sf))
    return tagged.select(
        "email_message_id", "email_received_at", "extracted_year", "extracted_week",
        "table_index", "row_index", "subject_text",
    )


@query(
    """
SELECT c_custkey, CAST(c_custkey AS VARCHAR) || '-カナABC' AS wide,
       CAST(CAST(abs(c_acctbal) AS DECIMAL(18,2)) AS DOUBLE) AS amount FROM customer
"""
)
def t_width(spark: SparkSession, sf: str) -> DataFrame:
    """Full-width digits and letters and half-width kana, folded and then cleaned."""
    customer = fx.table(spark, sf, "customer")
    number = F.translate(F.format_number(F.abs("c_acctbal"), 2), "0123456789,.", "０１２３４５６７８９，．")
    wide = F.concat(
        F.translate(F.col("c_custkey").cast("string"), "0123456789", "０１２３４５６７８９"),
        F.lit("－ｶﾅＡＢＣ"),
    )
    return customer.select(
        "c_custkey",
        text.normalize_width(wide).alias("wide"),
        money.clean_amount_yen(text.fold_width(number)).alias("amount"),
    )


# --- responses --------------------------------------------------------------------------------


def parsed(spark: SparkSession, sf: str) -> DataFrame:
    return responses.with_json(fx.responses(fx.table(spark, sf, "part")))


@query(
    f"""
WITH {RESPONSES} SELECT k AS p_partkey, CASE WHEN ok THEN 'Parts of ' || p_brand END AS description,
       CASE WHEN ok THEN CAST(confidence AS DOUBLE) END AS confidence,
       CASE WHEN ok THEN CAST(CASE WHEN ghost THEN 3 ELSE 2 END AS INTEGER) END AS described, NOT ok AS has_error FROM resp
"""
)
def t_json(spark: SparkSession, sf: str) -> DataFrame:
    return parsed(spark, sf).select(
        "p_partkey",
        F.col("doc.table_description").alias("description"),
        "doc.confidence",
        F.size(F.map_keys("doc.column_descriptions")).alias("described"),
        F.col("json_error").isNotNull().alias("has_error"),
    )


@query(f"WITH {RESPONSES} SELECT k AS p_partkey, 'p_ghost' AS \"column\" FROM resp WHERE ok AND ghost")
def t_bad_columns(spark: SparkSession, sf: str) -> DataFrame:
    known = fx.table(spark, sf, "part").columns
    return responses.unknown_columns(parsed(spark, sf), "p_partkey", known)


@query(
    f"""
WITH {RESPONSES} SELECT k AS p_partkey, CASE WHEN ok AND confidence >= 0.9 THEN 'Parts of ' || p_brand ELSE '' END AS description,
       CASE WHEN ok AND confidence < 0.9 THEN 'unit of ' || p_name || '?' END AS question,
       ok AND confidence >= 0.9 AS accepted FROM resp
"""
)
def t_gate(spark: SparkSession, sf: str) -> DataFrame:
    gated = responses.gate(parsed(spark, sf))
    return gated.select("p_partkey", "description", "question", "accepted")
