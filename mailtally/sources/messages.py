"""Message scans: landed payloads to the flat message frame."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from mailtally.operators.latest import first_n_per_key
from mailtally.schemas import PAYLOAD


def read_messages(
    spark: SparkSession, path: str, schema: T.StructType = PAYLOAD, multiline: bool = False
) -> DataFrame:
    """Landed payloads with a fixed projection: one JSON object per line, which splits, or
    per file."""
    return spark.read.schema(schema).json(path, multiLine=multiline)


def read_wrapped(
    spark: SparkSession, path: str, schema: T.StructType = PAYLOAD, multiline: bool = False
) -> DataFrame:
    """Landed service responses ``{"value": [payload, ...]}``."""
    wrapper = T.StructType([T.StructField("value", T.ArrayType(schema))])
    return spark.read.schema(wrapper).json(path, multiLine=multiline).select(F.inline("value"))


def stream_messages(
    spark: SparkSession, path: str, schema: T.StructType = PAYLOAD, max_files: int | None = None
) -> DataFrame:
    """Streaming twin of :func:`read_messages`."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def standardize(raw: DataFrame) -> DataFrame:
    """Flatten a payload to the nine message fields plus ``received_ts``."""

    def text(col: str) -> Column:
        return F.coalesce(F.col(col), F.lit(""))

    def flag(col: str) -> Column:
        return F.coalesce(F.col(col), F.lit(False))

    return raw.select(
        "id",
        text("subject").alias("subject"),
        text("from.emailAddress.address").alias("email_sender"),
        text("from.emailAddress.name").alias("sender_name"),
        F.col("receivedDateTime").alias("received_at"),
        text("body.content").alias("html_body"),
        flag("hasAttachments").alias("has_attachments"),
        flag("isRead").alias("is_read"),
        F.col("conversationId").alias("conversation_id"),
        F.try_to_timestamp(F.col("receivedDateTime")).alias("received_ts"),
    )


def latest_n(
    messages: DataFrame, n: int, by: str = "received_ts", tie: str = "id", per: str | None = None
) -> DataFrame:
    """The newest ``n`` messages, over all or per mailbox."""
    order = [F.col(by).desc(), F.col(tie).desc()]
    if per is None:
        return messages.orderBy(*order).limit(n)
    return first_n_per_key(messages, [per], order, n)


def add_time_part(
    df: DataFrame, col: str = "received_ts", part: str = "received_part", unit: str = "month"
) -> DataFrame:
    """The first day of the ``unit`` (day, week, month, quarter, year) of a time, to store by."""
    return df.withColumn(part, _time_part(F.col(col), unit))


def _time_part(time: Column, unit: str) -> Column:
    day = time.cast("date")
    return day if unit == "day" else F.trunc(day, unit)


def _not_before(
    messages: DataFrame, bound: Column, col: str, part: str | None, unit: str
) -> DataFrame:
    """``col >= bound``, and the same of the stored part: a literal that prunes folders.

    The part's bound lies a day earlier, as writers and readers may be in different time zones.
    """
    kept = messages.filter(F.col(col) >= bound)
    if part is None:
        return kept
    return kept.filter(F.col(part) >= _time_part(F.date_sub(bound.cast("date"), 1), unit))


def since(
    messages: DataFrame,
    ts: str | datetime,
    col: str = "received_ts",
    part: str | None = None,
    unit: str = "month",
) -> DataFrame:
    """Messages received at or after a time; the literal reaches the scan.

    ``part`` names the partition column made by :func:`add_time_part`, if they are stored by
    it: then only the folders from the time's own on are opened.
    """
    dtype = messages.schema[col].dataType
    return _not_before(messages, F.lit(ts).cast(dtype), col, part, unit)


def days_back(
    messages: DataFrame,
    days: int,
    as_of: str | datetime,
    col: str = "received_ts",
    part: str | None = None,
    unit: str = "month",
) -> DataFrame:
    """Messages of the last ``days`` days before ``as_of``; ``part`` as in :func:`since`."""
    dtype = messages.schema[col].dataType
    bound = F.lit(as_of).cast(dtype) - F.make_interval(days=F.lit(days))
    return _not_before(messages, bound, col, part, unit)
