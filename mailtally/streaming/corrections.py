"""Corrections in state: of each merge key only what won goes on to the table.

``upsert_stream`` hands every record of a micro-batch to the upsert, which then reads the
table to find that most are older than what is stored. Here a keyed state holds the time and
the message id of the newest record of each merge key, so a micro-batch carries at most one
record of a key, and none of a key whose newest one has been seen.

A state row goes once the watermark has passed its time: older records of that key are late
from then on and dropped before they reach the state, so nothing is left to compare with. The
state is therefore as large as the number of keys inside the look-back.

Defined cases: equal times are decided by the larger message id; of copies of one message, the
first counts. Records without a time, or with a null in a merge key, go through as they are, as
in ``upsert_all``, and leave no state. Records of one key meet in one task, batch by batch; their
number is bounded by the source's limit for a micro-batch (``maxFilesPerTrigger``).

The state function is called once for each group, and each column costs it time in every call. So
a record goes through it as one text, and ``correction_stream`` groups by slots of merge keys and not
by keys: a slot's state holds the time and id of each of its keys, and a batch has as many calls as
slots at most, however many keys it has. A slot's state is written anew when a record of one of its
keys comes. Winners are the same for any number of slots; a stream keeps the number it began with.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from mailtally.operators.gates import LOOK_BACK_DAYS
from mailtally.operators.routing import route_first
from mailtally.operators.upsert import key_groups, upsert_grouped
from mailtally.sources.rules import Rule
from mailtally.streaming.intake import batch_stream

KEY, RECORD, SLOT = "_key", "_record", "_slot"
#: Begins the keys of records that take no part; merge keys are JSON objects.
FREE = "-"
STATE = "moment long, id string"
SLOT_STATE = "keys array<string>, moments array<long>, ids array<string>"
#: Slots of a stream: at some millions of keys inside the look-back, each holds a thousand.
SLOTS = 4096


def merge_key(rules: list[Rule]) -> Column:
    """The merge key of a record as text, by the rule it came from; null if a part is null."""
    found = F.lit(None).cast("string")
    for number, (keys, names) in enumerate(key_groups(rules).items()):
        whole = F.lit(True)
        for k in keys:
            whole &= F.col(k).isNotNull()
        text = F.to_json(F.struct(F.lit(number).alias("group"), *keys))
        found = F.when(F.col("customer_name").isin(*names) & whole, text).otherwise(found)
    return found


def packed(records: DataFrame) -> Column:
    """A record as one text. Times are whole microseconds, which JSON would cut."""
    return F.to_json(
        F.struct(
            *[
                (F.unix_micros(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)).alias(f.name)
                for f in records.schema.fields
            ]
        )
    )


def unpacked(stored: DataFrame, schema: T.StructType) -> DataFrame:
    """The records of ``packed`` texts."""
    times = [f.name for f in schema.fields if isinstance(f.dataType, T.TimestampType)]
    kinds = T.StructType(
        [T.StructField(f.name, T.LongType() if f.name in times else f.dataType) for f in schema.fields]
    )
    rows = stored.select(F.from_json(RECORD, kinds, {"mode": "FAILFAST"}).alias(RECORD))
    return rows.select(
        *[
            (F.timestamp_micros(F.col(f"{RECORD}.{c}")) if c in times else F.col(f"{RECORD}.{c}")).alias(c)
            for c in schema.names
        ]
    )


def newest_of_key(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Gives on a key's newest record if it is newer than the one in state.

    There are about as many calls as records, most with one row, so a frame has few columns
    and a row is handed on without a copy.
    """
    if state.hasTimedOut:
        state.remove()
        return
    if key[0].startswith(FREE):
        yield from frames
        return
    best = tuple(state.get) if state.exists else None
    winner = None
    for pdf in frames:
        for at, text in enumerate(pdf[RECORD].tolist()):
            record = json.loads(text)
            place = record["received_ts"], record.get("email_unique_id", "")
            # the first of equal ones stays
            if best is None or place > best:
                best, winner = place, (pdf, at)
    if best is None:
        return
    if winner is not None:
        pdf, at = winner
        state.update(best)
        yield pdf if len(pdf) == 1 else pdf.iloc[[at]]
    # the first millisecond at which the watermark is past the record's time
    state.setTimeoutTimestamp(max(best[0] // 1000, state.getCurrentWatermarkMs()) + 1)


def newest_of_slot(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """``newest_of_key`` for all keys of a slot in one call."""
    best: dict[str, tuple[int, str]] = {}
    if state.exists:
        keys, moments, ids = state.get
        best = dict(zip(keys, zip(moments, ids, strict=True), strict=True))
    won: dict[str, str] = {}
    if not state.hasTimedOut:
        for pdf in frames:
            free = []
            for name, text in zip(pdf[KEY].tolist(), pdf[RECORD].tolist(), strict=True):
                if name.startswith(FREE):
                    free.append(text)
                    continue
                record = json.loads(text)
                place = record["received_ts"], record.get("email_unique_id", "")
                # the first of equal ones stays
                if name not in best or place > best[name]:
                    best[name], won[name] = place, text
            if free:
                yield pd.DataFrame({RECORD: free})
        if won:
            yield pd.DataFrame({RECORD: list(won.values())})
    watermark = state.getCurrentWatermarkMs()
    # without those that the watermark has passed: no record up to it comes in from now on
    held = {name: place for name, place in best.items() if place[0] > watermark * 1000 or watermark <= 0}
    if held:
        moments, ids = zip(*held.values(), strict=True)
        if won or len(held) < len(best):
            state.update((list(held), list(moments), list(ids)))
        # the first millisecond at which the watermark is past one of them
        state.setTimeoutTimestamp(max(min(moments) // 1000, watermark) + 1)
    elif state.exists:
        state.remove()


def winners(records: DataFrame, rules: list[Rule], slots: int | None = None) -> DataFrame:
    """The records of a stream that are, when they come, the newest of their merge key.

    ``records`` come from ``route_first`` over messages with a watermark on ``received_ts``
    (``with_look_back``). With ``slots``, keys are dealt to so many, and each slot's keys share
    a call of the state function and a row of the state; without, each key has its own.
    """
    content = F.sha2(F.to_json(F.struct(*records.columns)), 256)
    key = merge_key(rules)
    held = key.isNotNull() & F.col("received_ts").isNotNull()
    keyed = records.select(
        # a record that takes no part has a key of its own, so that such ones do not meet
        F.when(held, key).otherwise(F.concat(F.lit(FREE), content)).alias(KEY),
        packed(records).alias(RECORD),
        # for the watermark; the state function does not read it
        "received_ts",
    )
    if slots:
        keyed = keyed.withColumn(SLOT, F.pmod(F.xxhash64(KEY), F.lit(slots)))
        group, newest, out, kept = SLOT, newest_of_slot, f"{RECORD} string", SLOT_STATE
    else:
        group, newest, out, kept = KEY, newest_of_key, keyed.schema, STATE
    found = keyed.groupBy(group).applyInPandasWithState(
        newest,
        outputStructType=out,
        stateStructType=kept,
        outputMode="append",
        timeoutConf=GroupStateTimeout.EventTimeTimeout,
    )
    return unpacked(found, records.schema)


def with_look_back(messages: DataFrame, days: int = LOOK_BACK_DAYS) -> DataFrame:
    """Messages with the watermark that lets corrections come in for so many days."""
    return messages.withWatermark("received_ts", f"{days} days")


def correction_stream(
    messages: DataFrame,
    rules: list[Rule],
    table: str,
    checkpoint: str,
    days: int = LOOK_BACK_DAYS,
    tz: str = "Asia/Tokyo",
    as_of: str | None = None,
    trigger: dict[str, Any] | None = None,
    store: dict[str, Any] | None = None,
    slots: int | None = SLOTS,
    **route: Any,
) -> StreamingQuery:
    """Route a stream and upsert only the records that won their merge key.

    Records behind the look-back are ignored. A replayed micro-batch starts from the state
    before it and so gives the same winners; the upsert is by key and changes nothing then.
    ``slots`` is as in ``winners``; it belongs to the checkpoint, as the merge keys do.
    """
    won = winners(route_first(with_look_back(messages, days), rules, **route), rules, slots)

    def each(batch: DataFrame, _: int) -> None:
        upsert_grouped(batch, rules, table, tz, as_of, **(store or {}))

    return batch_stream(won, each, checkpoint, trigger)
