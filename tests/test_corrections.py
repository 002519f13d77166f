"""Corrections in state: winners of a merge key, the look-back and the size of the state."""

from __future__ import annotations

import datetime as dt
import inspect
import random
import re
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from mailtally.plans.registry import fresh_table
from mailtally.sources.rules import load_rules
from mailtally.streaming import corrections
from mailtally.streaming.intake import batch_stream, drain

RULES = [
    replace(r, merge_keys=keys)
    for r, keys in zip(
        load_rules({"customers": {"One": {"subject_regex": "one"}, "Two": {"subject_regex": "two"}}}),
        (("customer_code",), ("customer_code", "payment_due_label")),
        strict=True,
    )
]
FIELDS = (
    "customer_name string, customer_code string, payment_due_label string, payment_amount double, "
    "email_unique_id string, received_at string"
)


@pytest.fixture
def run(spark, tmp_path):
    """Each call sends rows as one micro-batch and gives what went on to the table."""
    inbox, offsets = str(tmp_path / "in"), str(tmp_path / "offsets")

    def send(*rows, days=7):
        spark.createDataFrame(rows, FIELDS).coalesce(1).write.mode("append").json(inbox)
        records = spark.readStream.schema(FIELDS).json(inbox)
        timed = records.withColumn("received_ts", F.to_timestamp("received_at"))
        won = corrections.winners(corrections.with_look_back(timed, days), RULES)
        got = []
        drain(batch_stream(won, lambda batch, _: got.extend(batch.collect()), offsets))
        return sorted((r.customer_code or "-", r.email_unique_id or "-", r.payment_amount) for r in got)

    send.offsets = offsets
    return send


def note(code, id_, at, amount=1.0, name="One", label="due"):
    return (name, code, label, amount, id_, at)


def states(spark, offsets):
    rows = spark.read.format("statestore").load(offsets)
    return {r.key["_key"]: r.value for r in rows.collect()}


def test_one_winner_of_each_key_and_batch(spark, run):
    first = run(
        note("a", "m1", "2024-01-01 08:00:00"),
        note("a", "m2", "2024-01-01 09:00:00", 2.0),
        note("b", "m3", "2024-01-01 08:00:00"),
    )
    assert first == [("a", "m2", 2.0), ("b", "m3", 1.0)]
    # older, equal in time with a smaller id, a copy of the stored one; one with a larger id
    assert run(note("a", "m0", "2024-01-01 08:30:00")) == []
    assert run(note("a", "m1", "2024-01-01 09:00:00", 5.0)) == []
    assert run(note("a", "m2", "2024-01-01 09:00:00", 2.0)) == []
    assert run(note("a", "m4", "2024-01-01 09:00:00", 4.0)) == [("a", "m4", 4.0)]


def test_keys_follow_the_rule(run):
    rows = [
        note("a", "m1", "2024-01-01 08:00:00", name=name, label=label)
        for name in ("One", "Two")
        for label in ("x", "y")
    ]
    assert len(run(*rows)) == 3  # One has a key without the label


def test_records_without_key_or_time_go_through(spark, run):
    odd = [
        note(None, "m1", "2024-01-01 08:00:00"),
        note(None, "m2", "2024-01-01 08:00:00"),
        note("a", "m3", None),
        note("b", None, "2024-01-01 08:00:00"),
    ]
    assert run(*odd) == [("-", "m1", 1.0), ("-", "m2", 1.0), ("a", "m3", 1.0), ("b", "-", 1.0)]
    assert run(*odd[:3]) == [("-", "m1", 1.0), ("-", "m2", 1.0), ("a", "m3", 1.0)]
    held = [k for k, v in states(spark, run.offsets).items() if v["groupState"] is not None]
    assert len(held) == 1


def test_late_ones_are_ignored_and_state_expires(spark, run):
    assert len(run(note("a", "m1", "2024-01-01 08:00:00"), note("b", "m2", "2024-01-02 08:00:00"))) == 2
    assert len(states(spark, run.offsets)) == 2
    # the watermark moves to 13 January; both keys are behind it from then on
    assert len(run(note("c", "m3", "2024-01-20 08:00:00"))) == 1
    assert run(note("a", "m9", "2024-01-12 08:00:00"), note("a", "m8", "2024-01-14 08:00:00")) == [
        ("a", "m8", 1.0)
    ]
    assert sorted(k[:1] for k in states(spark, run.offsets)) == ["{", "{"]
    assert any('"a"' in k for k in states(spark, run.offsets))
    assert not any('"b"' in k for k in states(spark, run.offsets))


def test_a_hot_key_comes_as_one_winner(run):
    rows = [note("hot", f"m{i:05}", "2024-01-01 08:00:00", float(i)) for i in range(5000)]
    assert run(*rows) == [("hot", "m04999", 4999.0)]


def test_records_pass_the_state_as_one_text(spark, tmp_path):
    kinds = f"{FIELDS}, received_ts timestamp"
    records = spark.readStream.schema(kinds).json(str(tmp_path))
    won = corrections.winners(corrections.with_look_back(records, 7), RULES)
    assert won.schema == records.schema
    plan = won._jdf.queryExecution().analyzed().toString()
    given = re.search(r"newest_of_key\(([^)]*)\)", plan).group(1)
    names = [x.split("#")[0].strip() for x in given.split(",")]
    assert names == ["_key", "_record", "received_ts"]


def test_packed_records_come_back_whole(spark):
    rows = [
        (1, 'a "b"\n\\c\u3000\u00e9', float("inf"), dt.datetime(2024, 1, 1, 8, 0, 0, 123456), None),
        (2, "", -0.1, dt.datetime(1969, 12, 31, 23, 59, 59, 999999), Decimal("12.340")),
        (None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, "n long, s string, d double, received_ts timestamp, x decimal(9,3)")
    text = df.select(corrections.packed(df).alias(corrections.RECORD))
    back = corrections.unpacked(text, df.schema)
    assert back.schema == df.schema
    assert back.collect() == df.collect()


def in_slots(spark, folder, slots, batches, days=7):
    """What goes on of each batch, and the state's rows after it, with keys dealt to slots."""
    inbox, offsets, out = str(folder / "in"), str(folder / "offsets"), []
    for rows in batches:
        spark.createDataFrame(rows, FIELDS).coalesce(1).write.mode("append").json(inbox)
        records = spark.readStream.schema(FIELDS).json(inbox)
        timed = records.withColumn("received_ts", F.to_timestamp("received_at"))
        won = corrections.winners(corrections.with_look_back(timed, days), RULES, slots)
        assert won.schema == timed.schema
        got = []
        drain(batch_stream(won, lambda batch, _: got.extend(batch.collect()), offsets))  # noqa: B023
        out.append((sorted(map(str, got)), spark.read.format("statestore").load(offsets).collect()))
    return out


def test_slots_give_the_winners_of_keys(spark, tmp_path):
    """Old and new, late and expired ones, copies, ones without id, key or time, in any order."""
    rng = random.Random(7)
    batches = []
    for first, last in ((1, 9), (3, 12), (8, 28), (8, 28)):
        rows = [
            note(f"k{rng.randrange(25)}", f"m{rng.randrange(40):02}", f"2024-01-{rng.randint(first, last):02} 08:00:0{rng.randrange(3)}",
                 float(i), rng.choice(["One", "Two"]), rng.choice("xy"))
            for i in range(150)
        ]
        rows += [note("k1", None, f"2024-01-{last:02} 08:00:00", 900.0), note(None, "m1", f"2024-01-{last:02} 08:00:00", 901.0)]
        rows += [note("k2", "m2", None, 902.0), note("old", "m3", "1969-12-30 08:00:00", 903.0)]
        batches.append(rows)
    want = in_slots(spark, tmp_path / "keys", None, batches)
    got = in_slots(spark, tmp_path / "slots", 3, batches)
    assert [x for x, _ in got] == [x for x, _ in want]
    assert [len(x) for x, _ in want] > [30, 10, 30, 1]
    for (_, slots), (_, keys) in zip(got, want, strict=True):
        assert len(slots) <= 3 < len(keys)
        assert {k for r in slots for k in r.value["groupState"]["keys"]} <= {r.key["_key"] for r in keys}


def test_keys_of_a_slot_expire_one_by_one(spark, tmp_path):
    batches = [
        [note("a", "m1", "2024-01-01 08:00:00"), note("b", "m2", "2024-01-15 08:00:00")],
        [note("c", "m3", "2024-01-20 08:00:00")],
        [note("c", "m4", "2024-02-20 08:00:00", None)],
        [note(None, "m5", "2024-03-20 08:00:00")],
    ]
    states = [rows for _, rows in in_slots(spark, tmp_path, 1, batches)]
    held = [sorted(re.findall('"customer_code":"(.)"', str(rows))) for rows in states]
    assert held == [["b"], ["b", "c"], ["c"], []]


def test_the_stream_groups_by_slots(spark, tmp_path):
    """The state function is called for slots, however many keys there are."""
    inbox, offsets, table = str(tmp_path / "in"), str(tmp_path / "offsets"), fresh_table("slots")
    rules = load_rules({"customers": {"One": {"subject_regex": "one", "params": {"code_regex": "code", "amount_regex": "due"}}}})
    body = F.format_string("<p>code: %05d</p><table><tr><td>due</td><td>%d</td></tr></table>", "id", "id")
    spark.range(100, 300).select(
        F.format_string("m%05d", "id").alias("id"), F.lit("one").alias("subject"), F.lit("a@b.example").alias("email_sender"),
        F.lit("2024-01-01T08:00:00Z").alias("received_at"), body.alias("html_body"), F.lit("c").alias("conversation_id"),
        F.lit("x").alias("sender_name"), F.lit(False).alias("has_attachments"), F.lit(False).alias("is_read"),
    ).write.json(inbox)
    flat = spark.readStream.schema(spark.read.json(inbox).schema).json(inbox)
    flat = flat.withColumn("received_ts", F.to_timestamp("received_at"))
    drain(corrections.correction_stream(flat, rules, table, offsets, slots=5, label_mode="normalized"))
    assert spark.table(table).count() == 200
    rows = spark.read.format("statestore").load(offsets).collect()
    assert sorted(r.key["_slot"] for r in rows) == [0, 1, 2, 3, 4]
    assert sum(len(r.value["groupState"]["keys"]) for r in rows) == 200
    assert corrections.SLOTS and inspect.signature(corrections.correction_stream).parameters["slots"].default == corrections.SLOTS
