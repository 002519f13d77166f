"""Filters before extraction: allow lists, watermarks, processed ids, date guards.

Bounds that come from data are scalar subqueries inside the plan: nothing is collected,
and the bound reaches the scan as a pushed filter.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from mailtally.operators.latest import OWN, number_null_keys

# --- fixed value: how far the intake re-reads behind the newest stored message ---
LOOK_BACK_DAYS = 7
# --- end of fixed values ---


def by_sender(messages: DataFrame, allowed: Sequence[str]) -> DataFrame:
    """Sender contains one of the strings, whatever the case."""
    sender = F.lower("email_sender")
    return messages.filter(reduce(or_, [sender.contains(a.lower()) for a in allowed], F.lit(False)))


def by_subject(messages: DataFrame, part: str) -> DataFrame:
    """Subject contains the string, whatever the case."""
    return messages.filter(F.lower("subject").contains(part.lower()))


def by_attachments(messages: DataFrame, wanted: bool = True) -> DataFrame:
    return messages.filter(F.col("has_attachments") == wanted)


class MessageFilter:
    """Chainable form of the filters above; ``df`` is the result."""

    def __init__(self, df: DataFrame) -> None:
        self.df = df

    def by_sender(self, *allowed: str) -> MessageFilter:
        return MessageFilter(by_sender(self.df, allowed))

    def by_subject(self, part: str) -> MessageFilter:
        return MessageFilter(by_subject(self.df, part))

    def by_has_attachments(self, wanted: bool = True) -> MessageFilter:
        return MessageFilter(by_attachments(self.df, wanted))

    def by_received(self, since: str | datetime, until: str | datetime | None = None) -> MessageFilter:
        dtype = self.df.schema["received_ts"].dataType
        kept = self.df.filter(F.col("received_ts") >= F.lit(since).cast(dtype))
        if until is not None:
            kept = kept.filter(F.col("received_ts") < F.lit(until).cast(dtype))
        return MessageFilter(kept)

    def results(self) -> DataFrame:
        return self.df


def watermark(target: DataFrame, days: int = LOOK_BACK_DAYS, col: str = "received_ts") -> Column:
    """Newest stored time minus the look-back, as a scalar; null for an empty target."""
    newest = target.agg((F.max(col) - F.make_interval(days=F.lit(days))).alias("w"))
    return newest.scalar()


def after_watermark(
    messages: DataFrame, target: DataFrame, days: int = LOOK_BACK_DAYS, col: str = "received_ts"
) -> DataFrame:
    """Messages inside the look-back; every message when nothing is stored yet.

    Messages without a time cannot be behind it and are kept.
    """
    bound = watermark(target, days, col)
    return messages.filter(bound.isNull() | (F.col(col) >= bound) | F.col(col).isNull())


def unprocessed(
    messages: DataFrame,
    processed: DataFrame,
    id_col: str = "email_unique_id",
    col: str = "received_ts",
    days: int | None = LOOK_BACK_DAYS,
) -> DataFrame:
    """Messages whose id is not among the processed ids of the look-back.

    ``processed`` is the sink table or the audit log. Null ids there are ignored. The id
    side is restricted to the look-back first, so it does not grow with the table's age.
    """
    recent = processed if days is None else after_watermark(processed, processed, days, col)
    return without_ids(messages, recent.select(F.col(id_col).alias("_done")))


def without_ids(messages: DataFrame, done: DataFrame) -> DataFrame:
    """Messages whose id is not in the single column ``_done``; those without an id stay.

    Messages without an id are numbered next to the key: they would all meet in one task.
    """
    ids = done.filter(F.col("_done").isNotNull()).withColumn("_none", F.lit(-1).cast("long"))
    tagged = number_null_keys(messages, ["id"])
    same = (F.col("id") == F.col("_done")) & (F.col(OWN) == F.col("_none"))
    return tagged.join(ids, same, "left_anti").drop(OWN)


# --- fixed values: audit statuses that need no second reading ---
FINAL_STATUSES = ("SUCCESS", "NO_TABLE_FOUND", "SCHEMA_MISMATCH")
# --- end of fixed values ---


def unaudited(messages: DataFrame, log: DataFrame, bound: Column) -> DataFrame:
    """Messages that the audit log has not settled; ``bound`` cuts the log to the look-back."""
    received = F.try_to_timestamp(F.col("received_at"))
    recent = log.filter(bound.isNull() | received.isNull() | (received >= bound))
    settled = recent.filter(F.col("status").isin(*FINAL_STATUSES))
    return without_ids(messages, settled.select(F.col("message_id").alias("_done")))


# --- business-date guards -----------------------------------------------------------------


def anchor_date(spark: SparkSession, tz: str, as_of: str | None = None) -> date:
    """The business date of a zone, read once; pass it to every later guard."""
    instant = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    row = spark.range(1).select(F.to_date(F.from_utc_timestamp(instant, tz))).first()
    return row[0]


def guard(df: DataFrame, col: str, day: date | Column, days: int = 1) -> DataFrame:
    """Rows of one business day (or several) as a half-open range on the raw column."""
    dtype = df.schema[col].dataType
    low = F.lit(day) if isinstance(day, date) else day
    return df.filter(
        (F.col(col) >= low.cast(dtype)) & (F.col(col) < F.date_add(low, days).cast(dtype))
    )


def last_loaded_date(
    source: DataFrame, target: DataFrame, col: str, anchor: date, out: str = "loaded_date"
) -> DataFrame:
    """Newest date, not after the anchor, that has rows on both sides. One row."""

    def days(df: DataFrame) -> DataFrame:
        dtype = df.schema[col].dataType
        upto = df.filter(F.col(col) < F.date_add(F.lit(anchor), 1).cast(dtype))
        return upto.select(F.to_date(col).alias(out)).distinct()

    return days(source).join(days(target), out, "left_semi").agg(F.max(out).alias(out))
