"""Samples, column dictionary, persisted statistics and the file-arrival log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from mailtally.operators.profile import null_profile


def sample_rows(df: DataFrame, n: int = 10, order: Sequence[str] = ()) -> DataFrame:
    """A few rows; with ``order`` always the same ones (a top-n, not a full sort)."""
    return df.orderBy(*order).limit(n) if order else df.limit(n)


def data_dictionary(df: DataFrame) -> DataFrame:
    """Name, type, nullability and comment per column, from the schema alone."""
    rows = [
        (i, f.name, f.dataType.simpleString(), f.nullable, (f.metadata or {}).get("comment", ""))
        for i, f in enumerate(df.schema.fields)
    ]
    return df.sparkSession.createDataFrame(
        rows, "position int, column string, data_type string, nullable boolean, comment string"
    )


def documented_columns(df: DataFrame) -> DataFrame:
    """Column dictionary together with the share of nulls: the input of a documentation run."""
    return data_dictionary(df).join(null_profile(df), "column").select(
        "column", "data_type", "comment", "null_pct"
    )


def analyze(spark: SparkSession, table: str) -> DataFrame:
    """Compute column statistics into the catalog and read them back."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")
    result = None
    for column in spark.table(table).columns:
        info = spark.sql(f"DESCRIBE EXTENDED {table} `{column}`").filter(
            F.col("info_name").isin("min", "max", "num_nulls", "distinct_count")
        )
        row = info.groupBy(F.lit(column).alias("column")).pivot(
            "info_name", ["min", "max", "num_nulls", "distinct_count"]
        ).agg(F.first("info_value"))
        result = row if result is None else result.unionByName(row)
    return result


def file_audit(df: DataFrame) -> DataFrame:
    """One row per landed file: rows, size and load status."""
    meta = df.select(
        F.col("_metadata.file_path").alias("input_file_name"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_modification_time").alias("arrived_at"),
    )
    return meta.groupBy("input_file_name").agg(
        F.count(F.lit(1)).alias("rows"),
        F.max("file_size").alias("file_size"),
        F.max("arrived_at").alias("arrived_at"),
        F.lit("LOADED").alias("bronze_status"),
    )


BROKEN = "_broken_record"


def file_arrivals(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "json",
    **options: str,
) -> DataFrame:
    """One row per file below a folder, whether it could be read or not.

    The listing is joined with what a full read finds: ``rows``, ``blank_rows`` (all values
    null) and ``broken_rows`` (JSON and CSV records that do not fit the schema). A file is
    FAILED, with a ``reason``, if it is empty, gives no record (also if it cannot be read at
    all) or holds broken records; else LOADED. Every column is read, since only that shows
    that a file can be. A compressed text that is cut short counts with the rows before the cut.

    Scans leave out files of no bytes, so names come from the listing, which the driver holds
    for any scan of the folder. Empty files have no ``arrived_at``.
    """
    texts = fmt in ("json", "csv")
    wanted = T.StructType([*schema.fields, T.StructField(BROKEN, T.StringType())]) if texts else schema
    read = spark.read.format(fmt).options(**options).option("recursiveFileLookup", "true")
    found = (
        read.schema(wanted)
        .option("ignoreCorruptFiles", "true")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BROKEN)
        .load(path)
    )
    whole = F.col(BROKEN).isNull() if texts else F.lit(True)
    some = F.lit(False)
    for field in schema.fields:
        some = some | F.col(f"`{field.name}`").isNotNull()
    # the kind needs all columns: a value that is not read cannot break its record
    kind = F.when(~whole, "broken").when(~some, "blank").otherwise("full")
    kinds = found.groupBy(F.col("_metadata.file_path").alias("_file"), kind.alias("_kind")).count()
    of_kind = lambda k: F.sum(F.when(F.col("_kind") == k, F.col("count")).otherwise(0))
    counts = kinds.groupBy("_file").agg(
        (of_kind("full") + of_kind("blank")).alias("_rows"),
        of_kind("blank").alias("_blank"),
        of_kind("broken").alias("_broken"),
    )
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    sizes = files.select(
        F.col("_metadata.file_path").alias("_listed"),
        F.col("_metadata.file_size").alias("_size"),
        F.col("_metadata.file_modification_time").alias("arrived_at"),
    )
    names = spark.createDataFrame([(f,) for f in files.inputFiles()], "input_file_name string")
    # the two write an empty authority differently: file:/a and file:///a
    place = lambda c: F.regexp_replace(c, "^([^:/]+):/+", "$1:/")
    listed = names.join(sizes, place("input_file_name") == place("_listed"), "left").withColumn(
        "file_size", F.coalesce("_size", F.lit(0))
    )
    number = lambda c: F.coalesce(F.col(c), F.lit(0))
    reason = (
        F.when(F.col("file_size") == 0, "empty file")
        .when(number("_rows") + number("_broken") == 0, "no readable record")
        .when(number("_broken") > 0, F.concat(number("_broken").cast("string"), F.lit(" broken records")))
    )
    return listed.join(counts, F.col("_listed") == F.col("_file"), "left").select(
        "input_file_name",
        "file_size",
        "arrived_at",
        number("_rows").alias("rows"),
        number("_blank").alias("blank_rows"),
        number("_broken").alias("broken_rows"),
        F.when(reason.isNull(), "LOADED").otherwise("FAILED").alias("bronze_status"),
        reason.alias("reason"),
    )
