"""Checks on free-text answers that should hold one JSON object."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

# --- fixed value: below this the description is withheld ---
CONFIDENCE = 0.9
# --- end of fixed values ---

RESPONSE = T.StructType(
    [
        T.StructField("table_description", T.StringType()),
        T.StructField("column_descriptions", T.MapType(T.StringType(), T.StringType())),
        T.StructField("data_quality_notes", T.ArrayType(T.StringType())),
        T.StructField("questions_for_steward", T.ArrayType(T.StringType())),
        T.StructField("steward_facts", T.MapType(T.StringType(), T.StringType())),
        T.StructField("confidence", T.DoubleType()),
    ]
)


def extract_json(col: Column, schema: T.StructType = RESPONSE) -> Column:
    """The outermost ``{...}`` span parsed by a schema; null when there is none or it is broken."""
    span = F.regexp_extract(col, r"(?s)\{.*\}", 0)
    checked = T.StructType(schema.fields + [T.StructField("_corrupt", T.StringType())])
    options = {"columnNameOfCorruptRecord": "_corrupt", "allowSingleQuotes": "false"}
    parsed = F.from_json(span, checked, options)
    kept = F.struct(*[parsed[f.name].alias(f.name) for f in schema.fields])
    return F.when((span != "") & parsed["_corrupt"].isNull(), kept)


def with_json(df: DataFrame, col: str = "response", out: str = "doc") -> DataFrame:
    """Add the parsed object and ``json_error``."""
    parsed = df.withColumn(out, extract_json(F.col(col)))
    error = F.when(F.col(out).isNull(), F.lit("no valid JSON object"))
    return parsed.withColumn("json_error", error)


def unknown_columns(df: DataFrame, key: str, columns: DataFrame | Iterable[str], doc: str = "doc") -> DataFrame:
    """Described columns that the table does not have: ``key, column``.

    ``columns`` is a list of names (becomes a literal) or a dictionary frame with a
    ``column`` column (becomes an anti join).
    """
    named = df.select(key, F.explode(F.map_keys(F.col(f"{doc}.column_descriptions"))).alias("column"))
    if isinstance(columns, DataFrame):
        known = columns.select(F.col("column").alias("_known"))
        return named.join(known, F.col("column") == F.col("_known"), "left_anti")
    return named.filter(~F.col("column").isin(list(columns)))


def gate(df: DataFrame, minimum: float = CONFIDENCE, doc: str = "doc") -> DataFrame:
    """Withhold descriptions below the confidence; keep the first question instead."""
    confidence = F.coalesce(F.col(f"{doc}.confidence"), F.lit(0.0))
    sure = confidence >= minimum
    return df.select(
        "*",
        F.when(sure, F.coalesce(F.col(f"{doc}.table_description"), F.lit("")))
        .otherwise(F.lit(""))
        .alias("description"),
        F.when(~sure, F.get(F.col(f"{doc}.questions_for_steward"), F.lit(0))).alias("question"),
        sure.alias("accepted"),
    )
