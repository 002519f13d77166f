"""Structured Streaming form of the intake.

Each function is the twin of a batch one and drains what is there with ``availableNow``;
run it on a schedule, or pass another trigger for a standing query.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from mailtally.operators.gates import LOOK_BACK_DAYS, after_watermark
from mailtally.operators.routing import explode_records, extract_every, newest_extract, route_first
from mailtally.operators.sinks import audit_extracts, create_table, stamp, state_row
from mailtally.operators.upsert import upsert_grouped
from mailtally.session import RunFolder
from mailtally.sources.messages import standardize
from mailtally.sources.rules import Rule

AVAILABLE = {"availableNow": True}


def messages_stream(raw: DataFrame) -> DataFrame:
    """Flat messages from a payload stream."""
    return standardize(raw)


def dedup_stream(messages: DataFrame, days: int = LOOK_BACK_DAYS) -> DataFrame:
    """First copy of each message id inside the look-back; older messages are late.

    The state holds one id per message of the look-back and nothing of the body. Messages
    without a time are left to ``untimed``: they would never leave the state. A message
    without an id is told apart by its whole content.
    """
    content = F.sha2(F.to_json(F.struct(*messages.columns)), 256)
    keyed = messages.withColumn("_key", F.coalesce(F.col("id"), content))
    timed = keyed.filter(F.col("received_ts").isNotNull())
    late = timed.withWatermark("received_ts", f"{days} days")
    return late.dropDuplicatesWithinWatermark(["_key"]).drop("_key")


def untimed(messages: DataFrame) -> DataFrame:
    """Messages without a readable time. No watermark can hold them, so they have a branch of
    their own, as audit rows; run it next to the intake."""
    return messages.filter(F.col("received_ts").isNull()).select(
        F.col("id").alias("message_id"),
        "conversation_id",
        "received_at",
        F.current_timestamp().alias("processed_at"),
        F.lit("FAILED").alias("status"),
        F.lit(0).cast("long").alias("rows_extracted"),
        F.lit("no readable receive time").alias("error_message"),
    )


def append_stream(
    df: DataFrame, path: str, checkpoint: str, trigger: dict[str, Any] | None = None
) -> StreamingQuery:
    """Append a stream to a parquet folder, exactly once through the sink's file log."""
    return (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or AVAILABLE))
        .start()
    )


def batch_stream(
    df: DataFrame,
    each: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: dict[str, Any] | None = None,
) -> StreamingQuery:
    return (
        df.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE))
        .start()
    )


def upsert_stream(
    messages: DataFrame,
    rules: list[Rule],
    table: str,
    checkpoint: str,
    tz: str = "Asia/Tokyo",
    as_of: str | None = None,
    trigger: dict[str, Any] | None = None,
    store: dict[str, Any] | None = None,
    **route: Any,
) -> StreamingQuery:
    """Route and upsert every micro-batch. Replaying a batch changes nothing, since the
    upsert is by key and takes over only rows that are not older. ``store`` holds options of
    ``upsert_all``: with ``buckets``, a batch rewrites the buckets of its keys only."""

    def each(batch: DataFrame, _: int) -> None:
        upsert_grouped(route_first(batch, rules, **route), rules, table, tz, as_of, **(store or {}))

    return batch_stream(messages, each, checkpoint, trigger)


def intake_stream(
    messages: DataFrame,
    rules: list[Rule],
    table: str,
    audit_table: str,
    state_table: str,
    checkpoint: str,
    pipeline: str = "intake",
    tz: str = "Asia/Tokyo",
    as_of: str | None = None,
    trigger: dict[str, Any] | None = None,
    label_mode: str = "line",
    store: dict[str, Any] | None = None,
) -> StreamingQuery:
    """The scheduled intake as a stream: upsert, audit and state of every micro-batch, once.

    A micro-batch is replayed if its run broke off. Audit and state rows therefore go to a
    partition of their own, named by the query and the batch, which a replay overwrites; the
    upsert is by key. The state row is written last, so it also is the ledger: a batch that has
    one is complete, and its replay does nothing. The query's name is the id in its checkpoint,
    so a stream that starts anew does not touch the rows of the one before.

    There is one partition for each micro-batch in the audit and state tables; choose the
    trigger accordingly. ``store`` holds options of ``upsert_all``, such as ``buckets``.
    """
    spark = messages.sparkSession

    def each(batch: DataFrame, number: int) -> None:
        name = spark.read.json(f"{checkpoint}/metadata").first()["id"]
        before = spark.table(state_table) if spark.catalog.tableExists(state_table) else None
        if before is not None and not before.filter(_own(name, number)).isEmpty():
            return
        with RunFolder(spark, "batch") as run:
            extracts = newest_extract(extract_every(batch, rules, label_mode=label_mode))
            extracts = run.keep(extracts, "extracts")
            timed = extracts.filter(F.col("received_ts").isNotNull())
            upsert_grouped(explode_records(timed), rules, table, tz, as_of, stored=True, **(store or {}))
            log = stamp(audit_extracts(extracts, as_of=as_of), tz, as_of)
            replace_batch(log, audit_table, name, number)
            state = run.keep(stamp(state_row(extracts, pipeline, before, as_of), tz, as_of), "state")
            replace_batch(state, state_table, name, number)

    return batch_stream(messages, each, checkpoint, trigger)


def _own(name: str, number: int) -> Column:
    return (F.col("query") == name) & (F.col("batch") == number)


def replace_batch(rows: DataFrame, table: str, name: str, number: int) -> None:
    """Write the rows of a micro-batch to its partition of the table, in place of any there."""
    spark = rows.sparkSession
    if not spark.catalog.tableExists(table):
        kinds = T.StructType(
            [*rows.schema.fields, T.StructField("query", T.StringType()), T.StructField("batch", T.LongType())]
        )
        create_table(spark, table, kinds, partition_by=["query", "batch"])
    stored = [c for c in spark.table(table).columns if c not in ("query", "batch")]
    spark.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION (query = '{name}', batch = {number}) "
        "SELECT * FROM {rows}",
        rows=rows.select(*stored),
    )


def drain(query: StreamingQuery) -> None:
    """Wait for a bounded query and raise what it raised."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def late_corrections(messages: DataFrame, target: DataFrame, days: int = LOOK_BACK_DAYS) -> DataFrame:
    """Batch twin of the watermark: messages behind the look-back are ignored."""
    return after_watermark(messages, target, days)
