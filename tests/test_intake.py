"""Rules, routing, strategies, templates and attachments on small hand-made messages."""

import json
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mailtally.functions.text import DEFAULT_CODE_REGEX
from mailtally.operators import gates, routing, strategies, templates
from mailtally.plans import fixtures as fx, intake
from mailtally.plans.intake import table_intake, template_intake
from mailtally.plans.registry import fresh_table
from mailtally.schemas import MESSAGE
from mailtally.session import RunFolder
from mailtally.sources import attachments, messages as msg
from mailtally.sources.rules import load_rules, rules_frame, select_rules


def mails(spark, *rows):
    filled = [
        {
            "id": f"m{i}", "email_sender": "ar@x.example", "sender_name": "", "has_attachments": False,
            "is_read": False, "conversation_id": "c", "received_at": "2026-08-26T00:00:00Z", **row,
        }
        for i, row in enumerate(rows)
    ]
    schema = StructType(MESSAGE.fields[:-1])
    text = spark.createDataFrame([tuple(r.get(f) for f in schema.names) for r in filled], schema)
    return text.withColumn("received_ts", F.to_timestamp("received_at"))


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


RULES = """
customers:
  Kita:
    subject_regex: "^statement k"
    merge_keys: [customer_code]
    params: {code_regex: "Ref", amount_regex: "transfer|settled", currency: USD, default_label: none}
  Nishi:
    subject_regex: "nishi"
    params: {code_regex: "Ref", amount_regex: "settled", prefix_code: "N-"}
  Minami:
    match: {subject_regex: "minami", sender_email: "desk@minami.example"}
"""


def lines(*items):
    return "".join(f"<div>{x}</div>" for x in items)


def routed(spark, subject, body, **more):
    df = mails(spark, {"subject": subject, "html_body": body, **more})
    return routing.route_first(df, load_rules(RULES)).collect()


def test_only_a_line_with_the_label_counts(spark):
    body = lines("Ref: Q7001", "gross 9,000", "fee 1,000", "settled 8,000 in May", "balance 7,000")
    (r,) = routed(spark, "Statement K / May", body)
    assert (r.customer_name, r.customer_code, r.payment_amount, r.currency) == ("Kita", "Q7001", 8000.0, "USD")
    assert (r.payment_due_label, r.email_unique_id) == ("settled 8,000 in May", "m0")


def test_the_label_may_stand_in_a_table_cell(spark):
    body = lines("Ref: Q7002") + table(["gross", "$500"], ["transfer", "$450", "net of fee"])
    (r,) = routed(spark, "statement k", body)
    assert (r.payment_amount, r.payment_due_label) == (450.0, "transfer $450 net of fee")


def test_the_first_label_line_with_an_amount_wins(spark):
    body = lines("Ref: Q7003", "we transfer as agreed", "deduction: △600", "transfer: 1,400", "settled: 2,000")
    (r,) = routed(spark, "statement k", body)
    assert r.payment_amount == 1400.0 and r.payment_due_label.startswith("transfer: 1")


def test_amount_on_the_line_below_and_prefix(spark):
    (r,) = routed(spark, "Nishi", lines("Ref", "4810", "settled", "¥3,300"))
    assert (r.customer_code, r.payment_amount) == ("N-4810", 3300.0)
    (r,) = routed(spark, "Nishi", lines("Ref: N-4810", "settled ¥1,000"))
    assert r.customer_code == "N-4810"  # the prefix is there already


def test_sender_of_a_rule(spark):
    body = lines("Customer ID: Z100", "Total Due: ¥7,000")
    assert routed(spark, "minami", body) == []
    (r,) = routed(spark, "minami", body, email_sender="desk@minami.example")
    assert (r.customer_code, r.payment_amount) == ("Z100", 7000.0)


@pytest.mark.parametrize("note", ["¥{}", "￥{}", "{}円", "${}", "€{}", "₩{}"])
@pytest.mark.parametrize("label", ["settled {}", "settled: {}", "・settled {} (Q2)", "[settled]", "mid-term settled {}"])
def test_label_and_amount_shapes(spark, note, label):
    amount = note.format("64,250")
    body = lines("Ref: ABC-1", *([label, amount] if "{}" not in label else [label.format(amount)]))
    (r,) = routed(spark, "nishi", body)
    assert (r.customer_code, r.payment_amount) == ("N-ABC-1", 64250.0)


def test_mail_without_code_amount_or_rule(spark):
    assert routed(spark, "nishi", lines("settled ¥5,000")) == []
    assert routed(spark, "nishi", lines("Ref: ABC", "settled soon")) == []
    assert routed(spark, "weather", lines("Ref: ABC", "settled ¥5,000")) == []


def test_first_success_all_matches_and_skipped_mail(spark):
    rules = load_rules(
        {
            "customers": {
                "NoCode": {"subject_regex": "pay", "params": {"code_regex": "存在しない"}},
                "First": {"subject_regex": "pay"},
                "Second": {"subject_regex": "pay"},
            }
        }
    )
    body = "<p>Customer ID: AB123</p><p>Payment Amount: $1,500.50</p>"
    df = mails(spark, {"subject": "PAY now", "html_body": body}, {"subject": "alert", "html_body": body})
    assert [r.customer_name for r in routing.route_first(df, rules).collect()] == ["First"]
    assert sorted(r.customer_name for r in routing.route_all(df, rules).collect()) == ["First", "Second"]
    assert routing.matched_rules(df, rules).count() == 3
    assert [r.name for r in select_rules(rules, "Second")] == ["Second"]


def test_rule_files(spark, tmp_path):
    path = tmp_path / "rules.yaml"
    path.write_text(RULES, encoding="utf-8")
    for source in (RULES, str(path)):
        rules = load_rules(source)
        assert [r.name for r in rules] == ["Kita", "Nishi", "Minami"]
    assert rules[1].code_regex == "Ref" and rules[1].merge_keys == ("customer_code", "payment_due_label")
    assert load_rules({"customers": {"D": {"subject_regex": "x"}}})[0].code_regex == DEFAULT_CODE_REGEX
    assert rules_frame(spark, rules).count() == 3
    for bad in ("just text", 5, {"customers": {"B": {"subject_regex": "x", "strategy": "magic"}}},
                {"customers": {"B": {"subject_regex": "x", "params": {"code_regex": "(a)b"}}}}):
        with pytest.raises(ValueError):
            load_rules(bad)


def test_own_strategy(spark):
    def subject_only(body, rule):
        return F.array(
            F.struct(
                F.lit(rule.name).alias("customer_name"), F.col("subject").alias("customer_code"),
                F.lit(1.0).alias("payment_amount"), F.lit("l").alias("payment_due_label"),
                F.lit("JPY").alias("currency"),
            )
        )

    strategies.register_strategy("subject_only", subject_only)
    rules = load_rules({"customers": {"S": {"subject_regex": ".", "strategy": "subject_only"}}})
    assert one(routing.route_first(mails(spark, {"subject": "abc", "html_body": "<p>x</p>"}), rules)).customer_code == "abc"


def _tables(spark, strategy, body, prefix="", code=None, amount=None):
    conf = {
        "match": {"subject_regex": "."}, "strategy": strategy, "prefix_code": prefix,
        "code_source": code or {"table_index": 0, "target_regex": "コード"},
        "amount_source": amount or {"table_index": 0, "target_regex": "支払額"},
    }
    df = mails(spark, {"subject": "s", "html_body": body})
    rows = table_intake(df, load_rules({"customers": {"T": conf}}), as_of="2026-01-01 00:00:00").collect()
    assert all(r.ingested_at == "2026-01-01T00:00:00+00:00" for r in rows)
    return [(r.customer_code, r.payment_amount, r.payment_due_label) for r in rows]


def table(*rows):
    return "<table>" + "".join(
        "<tr>" + "".join(f"<td>{c}</td>" for c in row) + "</tr>" for row in rows
    ) + "</table>"


def test_vertical_last_match_wins(spark):
    body = table(["コード", "", "A1"], ["支払額", "¥1"], ["コード", "B2"], ["4月 支払額", "▲2"])
    assert _tables(spark, "vertical_key_value", body) == [("B2", -2.0, "4月 支払額")]
    # A later label without a value renames; a later value that is no amount clears.
    renamed = table(["コード", "A1"], ["支払額", "¥1"], ["5月 支払額"])
    assert _tables(spark, "vertical_key_value", renamed) == [("A1", 1.0, "5月 支払額")]
    assert _tables(spark, "vertical_key_value", table(["コード", "A1"], ["支払額", "¥1"], ["支払額", "未定"])) == []


def test_zip_headers(spark):
    body = table(["項目", "A1", "B2", "合計"], ["支払額", "¥1", "-", "¥3"], ["支払額", "¥9", "¥9", "¥9"])
    assert _tables(spark, "zip_headers_to_row", body) == [("A1", 1.0, "支払額")]
    # No corner cell: as many headers as amounts, so none is skipped.
    assert _tables(spark, "zip_headers_to_row", table(["A1", "B2"], ["支払額", "¥1", "¥2"])) == [
        ("A1", 1.0, "支払額"), ("B2", 2.0, "支払額"),
    ]


def test_zip_rows_and_columns(spark):
    body = table(["コード", "A1", "B2", "合計"], ["支払額", "¥1", "¥2", "¥3"])
    assert _tables(spark, "zip_rows_in_same_table", body, prefix="79") == [
        ("79A1", 1.0, "支払額"), ("79B2", 2.0, "支払額"),
    ]
    two = table(["コード", "A1", "B2"]) + table(["振込金額", "¥5", "¥6", "¥7"])
    amount = {"table_index": 1, "target_regex": "振込"}
    assert _tables(spark, "zip_columns_across_tables", two, amount=amount) == [
        ("A1", 5.0, "振込金額"), ("B2", 6.0, "振込金額"),
    ]
    assert _tables(spark, "zip_columns_across_tables", "<p>no table</p>", amount=amount) == []


def test_payloads_and_wrapper(spark, tmp_path):
    payload = {
        "id": "p-77", "subject": "Remittance 77",
        "from": {"emailAddress": {"address": "ar@client.example", "name": "Ledger Desk"}},
        "receivedDateTime": "2025-03-04T05:06:07Z", "body": {"content": "<p>See below</p>"},
        "hasAttachments": False, "isRead": True, "conversationId": "thread-9",
    }
    (tmp_path / "a.json").write_text(json.dumps({"value": [payload, {"id": "bare"}]}, indent=1))
    raw = msg.read_wrapped(spark, str(tmp_path), multiline=True)
    rows = {r.id: r for r in msg.standardize(raw).collect()}
    full, bare = rows["p-77"], rows["bare"]
    assert (full.email_sender, full.html_body, full.is_read) == ("ar@client.example", "<p>See below</p>", True)
    assert (bare.subject, bare.email_sender, bare.html_body, bare.has_attachments) == ("", "", "", False)
    assert bare.received_ts is None


def test_metadata_cases(spark):
    regex = r"batch (?P<shop>[a-z]+)-(?P<nr>\d+)"
    df = mails(
        spark,
        {"subject": "fwd: batch oslo-17 is ready", "html_body": "<p>batch rome-1</p>"},
        {"subject": "batch without number", "html_body": "<ul><li>batch lima-4</li></ul>"},
        {"subject": None, "html_body": "<p>batch bern-9</p>"},
        {"subject": "none", "html_body": None},
    )
    columns = lambda d: {r.id: (r.shop, r.nr) for r in d.collect()}
    expected = {"m0": ("oslo", "17"), "m1": ("lima", "4"), "m2": ("bern", "9"), "m3": (None, None)}
    assert columns(templates.extract_metadata(df, regex)) == expected
    extractors = [("a", "subject_or_body", regex), ("b", "subject", r"(?P<first>^\w+)"), ("c", "body", "(?P<any>batch)")]
    read = templates.read_once(df, extractors)
    assert columns(read) == expected
    assert {r.id: (r.first, r["any"]) for r in read.collect()} == {
        "m0": ("fwd", "batch"), "m1": ("batch", "batch"), "m2": (None, "batch"), "m3": ("none", None),
    }
    assert columns(templates.extract_metadata(df, regex, "subject"))["m1"] == (None, None)


def test_template_reads_each_body_once(spark, sf, plan):
    reports = fx.emails_report(fx.table(spark, sf, "events"))
    template = templates.load_template(TEMPLATE)
    for rows in template_intake(reports, template):
        text = plan(rows)
        assert text.count("ArrowEvalPython") == text.count("FileScan") == 1
    off = templates.load_template(TEMPLATE.replace("header_row: 0", "header_row: 0\n  enabled: false"))
    rows, log = template_intake(reports, off)
    assert rows.count() == log.count() == templates.select_messages(reports, off).count()
    assert "subject_text" not in rows.columns
    assert {r.status for r in log.select("status").distinct().collect()} == {"SUCCESS"}


TEMPLATE = """
pipeline_name: weekly
filter:
  top_n: 25
  sender_contains: ["noreply@reports"]
  subject_must_contain: "WEEKLY report"
metadata_extractors:
  - {name: info, source: subject_or_body, regex: '(?P<kind>click|view)'}
table_extraction:
  header_row: 0
  column_mapping: {Task: subject_text, Hours: status_text}
sink: {data_table: d, audit_table: a, save_mode: append}
"""


def test_template(spark, sf):
    template = templates.load_template(TEMPLATE)
    assert (template.top_n, template.header_row, template.audit_table) == (25, 0, "a")
    reports = fx.emails_report(fx.table(spark, sf, "events"))
    chosen = templates.select_messages(reports, template)
    assert chosen.count() == reports.count()  # top_n never cuts the intake
    rows = templates.map_columns(templates.with_tables(chosen), template.column_mapping)
    assert rows.select("subject_text", "status_text").distinct().count() > 1


def test_message_filter(spark):
    df = mails(
        spark,
        {"subject": "Hello", "html_body": "", "has_attachments": True},
        {"subject": "hello", "html_body": "", "email_sender": "AR@Other.example"},
    )
    f = gates.MessageFilter(df).by_subject("HELL")
    assert f.results().count() == 2
    assert one(f.by_sender("other.EXAMPLE").df).id == "m1"
    assert one(f.by_has_attachments().df).id == "m0"


def test_gates_on_an_empty_target(spark):
    df = mails(spark, {"subject": "a", "html_body": ""})
    empty = df.filter("false").select(F.col("id").alias("email_unique_id"), "received_ts")
    assert gates.after_watermark(df, empty).count() == 1
    assert gates.unprocessed(df, empty).count() == 1


def test_landed_attachment_files(spark, tmp_path):
    schema = "store string, qty int"
    (tmp_path / "a.csv").write_text("store,qty\nx,1\ny,2\n")
    (tmp_path / "b.bin").write_bytes(b"\x00\x01")
    read = attachments.read_csv(spark, str(tmp_path / "a.csv"), StructType.fromDDL(schema))
    assert sorted(tuple(r) for r in read.collect()) == [("x", 1), ("y", 2)]
    files = attachments.attachment_files(spark, str(tmp_path), "*.bin")
    assert one(files).length == 2


def test_mixed_rules_read_each_body_once(spark, plan):
    conf = {
        "Table": {
            "match": {"subject_regex": "t"}, "strategy": "zip_headers_to_row",
            "amount_source": {"table_index": 0, "target_regex": "支払額"},
        },
        "Text": {"subject_regex": "x"},
        "Bare": {"subject_regex": "b", "strategy": "zip_rows_in_same_table"},
    }
    rules = load_rules({"customers": conf})
    df = mails(
        spark,
        {"subject": "t", "html_body": table(["項目", "A1"], ["支払額", "¥1"])},
        {"subject": "x", "html_body": "<p>Customer ID: ABC</p><p>Total Due: $2,000</p>"},
        {"subject": "b", "html_body": table(["コード", "B2"], ["支払額", "¥3"])},
        {"subject": "t", "html_body": ""},
    )
    routed = routing.route_first(df, rules)
    assert sorted((r.customer_code, r.payment_amount) for r in routed.collect()) == [
        ("A1", 1.0), ("ABC", 2000.0), ("B2", 3.0),
    ]
    assert plan(routed).count("html_body(") == 1


def test_messages_without_an_id_are_kept(spark):
    df = mails(
        spark,
        {"id": None, "subject": "x", "html_body": "<p>Customer ID: ABC</p><p>Total Due: $2,000</p>"},
        {"id": None, "subject": "x", "html_body": "<p>Customer ID: DEF</p><p>Total Due: $3,000</p>"},
        {"id": "m", "subject": "x", "html_body": "<p>Customer ID: GHI</p><p>Total Due: $4,000</p>"},
        {"id": "m", "subject": "x", "html_body": "<p>Customer ID: GHI</p><p>Total Due: $4,000</p>"},
    )
    rules = load_rules({"customers": {"X": {"subject_regex": "x"}}})
    kept = routing.newest_extract(routing.extract_first(df, rules))
    codes = sorted(r.customer_code for r in routing.explode_records(kept).collect())
    assert codes == ["ABC", "DEF", "GHI"]


def test_one_form_for_every_list_length(spark, sf, plan):
    """Only constants grow with the list: the extraction is in the plan once."""
    df = fx.emails_kv(fx.table(spark, sf, "orders"))
    others = {f"P{i}": {"subject_regex": f"^partner {i} "} for i in range(40)}
    sizes = []
    for more in ({}, others):
        rules = load_rules({"customers": {**more, **fx.KV_RULES["customers"]}})
        text = plan(routing.route_first(df, rules))
        sizes.append((text.count("ArrowEvalPython"), text.count("aggregate(")))
    assert sizes[0] == sizes[1]


def test_rules_after_the_first_success_are_not_tried(spark):
    """Under ANSI a division by zero in a later rule would end the job."""

    def fails(body, rule):
        return F.when(F.lit(1) / F.size(body_size()) > 0, F.array().cast(strategies.EXTRACTS))

    def body_size():
        return F.filter(F.array(F.lit(1)), lambda x: x > 1)

    strategies.register_strategy("fails", fails)
    conf = {"A": {"subject_regex": "."}, "B": {"subject_regex": ".", "strategy": "fails"}}
    df = mails(spark, {"subject": "s", "html_body": lines("Customer ID: A11", "Total Due: ¥100")})
    rules = load_rules({"customers": conf})
    assert [r.customer_name for r in routing.route_first(df, rules).collect()] == ["A"]
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        routing.route_all(df, rules).collect()


def test_rule_checks_follow_the_strategy():
    table_rule = {"subject_regex": "x", "code_source": {"target_regex": "(a)b"}}
    with pytest.raises(ValueError):
        load_rules({"customers": {"B": table_rule}})
    named = {"subject_regex": "x", "code_source": {"table_index": 1}, "params": {"code_regex": "Ref"}}
    assert load_rules({"customers": {"B": named}})[0].code_regex == "Ref"


def test_three_hundred_rules(spark, sf):
    others = {f"P{i}": {"subject_regex": f"^partner {i} "} for i in range(300)}
    rules = load_rules({"customers": {**others, **fx.KV_RULES["customers"]}})
    df = fx.emails_kv(fx.table(spark, sf, "orders"))
    few = routing.route_first(df, load_rules(fx.KV_RULES))
    assert Counter(routing.route_first(df, rules).collect()) == Counter(few.collect())


def test_template_run_reads_bodies_once_in_all(spark, sf, plan):
    """Rows and log of one run come from what was read; the tables hold what two passes give."""
    reports = fx.emails_report(fx.table(spark, sf, "events"))
    stored = []
    for at_once in (True, False):
        names = {"data_table": fresh_table("d"), "audit_table": fresh_table("a")}
        template = replace(templates.load_template(TEMPLATE), **names)
        if at_once:
            intake.run_template_intake(reports, template, as_of="2024-01-31 00:00:00")
        else:
            rows, log = template_intake(reports, template, as_of="2024-01-31 00:00:00")
            intake.save_template_intake(rows, log, template, as_of="2024-01-31 00:00:00")
        stored.append([spark.table(t) for t in names.values()])
    for one, two in zip(*stored):
        assert one.columns == two.columns and one.count() == two.count() > 0
        assert one.exceptAll(two).isEmpty()
    with RunFolder(spark, "template") as run:
        for frame in template_intake(reports, template, run=run):
            assert "ArrowEvalPython" not in plan(frame)
    with pytest.raises(ValueError, match="save mode"):
        intake.run_template_intake(reports, replace(template, save_mode="merge"))
