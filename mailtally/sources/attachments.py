"""Attachments: list per message to rows, and delimited text to typed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T


#: Stands for a quoted line break while the text is cut: two characters of private use.
BREAK = "\ue000\ue001"


def attachments(raw: DataFrame) -> DataFrame:
    """One row per attachment of a landed payload; messages without one keep a null row."""
    exploded = raw.select(F.col("id").alias("message_id"), F.explode_outer("attachments").alias("a"))
    return exploded.select(
        "message_id",
        F.col("a.id").alias("attachment_id"),
        F.col("a.name").alias("name"),
        F.col("a.contentType").alias("content_type"),
        F.col("a.size").alias("size"),
        F.unbase64("a.contentBytes").alias("content"),
    )


def attachment_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Landed attachment files as binary rows."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)


def attachment_csv(
    df: DataFrame, schema: T.StructType, text: str = "text", header: bool = True, sep: str = ","
) -> DataFrame:
    """Delimited text of each row to typed columns, one row per record.

    Line breaks inside quotes belong to the value, so a record may span lines: the text is
    cut only at breaks outside of quotes. The other columns and the record number stay. A record that does not fit gives nulls.
    """
    # what stands between quotes has an odd place among the parts that quotes separate
    hidden = F.transform(
        F.split(F.col(text), '"'),
        lambda part, i: F.when(i % 2 == 1, F.replace(part, F.lit("\n"), F.lit(BREAK))).otherwise(part),
    )
    lines = F.transform(
        F.split(F.array_join(hidden, '"'), r"\r?\n"),
        lambda line: F.replace(line, F.lit(BREAK), F.lit("\n")),
    )
    rest = [c for c in df.columns if c != text]
    numbered = df.select(*rest, F.posexplode(lines).alias("line_number", "_line"))
    wanted = F.col("_line") != ""
    if header:
        wanted = wanted & (F.col("line_number") > 0)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parsed = F.from_csv("_line", ddl, {"sep": sep, "mode": "PERMISSIVE", "multiLine": "true", "escape": '"'})
    return numbered.filter(wanted).select(*rest, "line_number", parsed.alias("_row")).select(
        *rest, "line_number", "_row.*"
    )


def read_csv(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> DataFrame:
    """Landed delimited files with a header line."""
    return spark.read.schema(schema).csv(path, header=True, sep=sep)
