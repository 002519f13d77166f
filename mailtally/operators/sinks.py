"""Appends, audit rows, incremental state and partitioned output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql import types as T

from mailtally.operators.latest import OWN, number_null_keys

ROW_LEVEL_FORMATS = {"delta", "iceberg"}


def audit_time(tz: str, as_of: str | None = None) -> Column:
    """Wall clock of a zone: now, or a fixed UTC time."""
    instant = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    return F.from_utc_timestamp(instant, tz)


def stamp(df: DataFrame, tz: str = "Asia/Tokyo", as_of: str | None = None) -> DataFrame:
    """Add the audit column ``last_update_s``."""
    return df.withColumn("last_update_s", audit_time(tz, as_of))


def table_format(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Provider'")
    first = rows.select("data_type").first()
    return (first[0] if first else "parquet").lower()


def table_location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'")
    return rows.select("data_type").first()[0].rstrip("/")


def create_table(
    spark: SparkSession, table: str, schema: T.StructType, fmt: str = "parquet", path: str | None = None,
    partition_by: Sequence[str] = (),
) -> None:
    """``CREATE TABLE IF NOT EXISTS`` with an explicit schema, in the warehouse or at ``path``."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    location = "" if path is None else f" LOCATION '{path}'"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING {fmt}{parts}{location}")


def append(
    df: DataFrame,
    table: str,
    tz: str = "Asia/Tokyo",
    as_of: str | None = None,
    fmt: str = "parquet",
    evolve: bool = False,
    overwrite: bool = False,
) -> int:
    """Append rows with the audit column; the count comes from the same write.

    ``evolve`` lets new columns in; without it a batch that has columns which the table
    lacks is refused. ``overwrite`` replaces the stored rows.
    """
    spark = df.sparkSession
    seen = Observation()
    rows = stamp(df, tz, as_of).observe(seen, F.count(F.lit(1)).alias("rows"))
    if not spark.catalog.tableExists(table):
        rows.write.format(fmt).saveAsTable(table)
    elif evolve and fmt in ROW_LEVEL_FORMATS:
        mode = "overwrite" if overwrite else "append"
        rows.write.format(fmt).mode(mode).option("mergeSchema", "true").saveAsTable(table)
    else:
        stored = spark.table(table).schema
        new = [c for c in rows.columns if c not in stored.names]
        if new and not evolve:
            raise ValueError(f"{table} lacks the columns {', '.join(new)}; pass evolve=True")
        if new:
            _add_columns(spark, table, rows.schema)
            stored = spark.table(table).schema
        aligned = [
            F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in stored.fields
        ]
        rows.select(*aligned).write.insertInto(table, overwrite=overwrite)
    return int(seen.get["rows"])


def _add_columns(spark: SparkSession, table: str, schema: T.StructType) -> None:
    have = set(spark.table(table).columns)
    new = [f for f in schema.fields if f.name not in have]
    if new:
        added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({added})")


def union_evolved(*frames: DataFrame) -> DataFrame:
    """Rows of frames with different columns; what is missing is null."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def audit(
    messages: DataFrame,
    records: DataFrame | Column,
    expected: Column | None = None,
    id_col: str = "email_unique_id",
    tz: str = "UTC",
    as_of: str | None = None,
) -> DataFrame:
    """One audit row per message: status, rows extracted, error.

    ``messages`` may carry ``has_table`` (a table was found), ``parse_failed`` and
    ``missing_columns``; ``expected`` overrides the schema-mismatch condition. Records
    are counted per message before the join, so the join is one row to one row; a column with
    their number per message needs no join.
    """
    if isinstance(records, Column):
        joined, rows = messages, F.coalesce(records, F.lit(0)).cast("long")
    else:
        # messages without an id have no records; numbered, they do not meet in one task
        counts = (
            records.filter(F.col(id_col).isNotNull())
            .groupBy(F.col(id_col).alias("_mid"))
            .agg(F.count(F.lit(1)).alias("_rows"))
            .withColumn("_none", F.lit(-1).cast("long"))
        )
        same = (F.col("id") == F.col("_mid")) & (F.col(OWN) == F.col("_none"))
        joined = number_null_keys(messages, ["id"]).join(counts, same, "left")
        rows = F.coalesce(F.col("_rows"), F.lit(0))
    false = F.lit(False)
    failed = F.col("parse_failed") if "parse_failed" in messages.columns else false
    no_table = ~F.col("has_table") if "has_table" in messages.columns else rows == 0
    missing = F.col("missing_columns") if "missing_columns" in messages.columns else F.lit("")
    mismatch = expected if expected is not None else missing != ""
    return joined.select(
        F.col("id").alias("message_id"),
        "conversation_id",
        "received_at",
        audit_time(tz, as_of).alias("processed_at"),
        F.when(failed, F.lit("FAILED"))
        .when(no_table, F.lit("NO_TABLE_FOUND"))
        .when(mismatch, F.lit("SCHEMA_MISMATCH"))
        .otherwise(F.lit("SUCCESS"))
        .alias("status"),
        rows.alias("rows_extracted"),
        F.when(failed, F.lit("body could not be parsed"))
        .when(no_table, F.lit("no table in body"))
        .when(mismatch, F.concat(F.lit("missing columns: "), missing))
        .alias("error_message"),
    )


def audit_extracts(extracts: DataFrame, tz: str = "UTC", as_of: str | None = None) -> DataFrame:
    """Audit rows of routed messages (``extract_every``): each row knows its own outcome."""
    untimed = F.col("received_ts").isNull()
    rows = F.size("records").cast("long")
    outcome = (
        F.when(F.col("parse_failed"), F.array(F.lit("FAILED"), F.lit("body could not be parsed")))
        .when(untimed, F.array(F.lit("FAILED"), F.lit("no readable receive time")))
        .when(~F.col("matched"), F.array(F.lit("NO_TABLE_FOUND"), F.lit("no rule matches")))
        .when(rows == 0, F.array(F.lit("NO_TABLE_FOUND"), F.lit("no record in body")))
        .otherwise(F.array(F.lit("SUCCESS"), F.lit(None)))
    )
    return extracts.select(
        F.col("email_unique_id").alias("message_id"),
        "conversation_id",
        F.col("email_received_at").alias("received_at"),
        audit_time(tz, as_of).alias("processed_at"),
        outcome[0].alias("status"),
        F.when(untimed, F.lit(0)).otherwise(rows).cast("long").alias("rows_extracted"),
        outcome[1].alias("error_message"),
    )


def audit_failures(log: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Messages per status and their share, over all or per group."""
    counts = log.groupBy(*by, "status").agg(F.count(F.lit(1)).alias("messages"))
    if not by:
        total = log.agg(F.count(F.lit(1)).alias("n")).scalar()
        share = F.col("messages") / total
        return counts.withColumn("share", share)
    totals = counts.groupBy(*[F.col(c).alias(f"_{c}") for c in by]).agg(
        F.sum("messages").alias("_total")
    )
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    return counts.join(totals, same).select(
        *by, "status", "messages", (F.col("messages") / F.col("_total")).alias("share")
    )


def state_row(
    extracts: DataFrame, pipeline: str, before: DataFrame | None = None, as_of: str | None = None
) -> DataFrame:
    """The incremental state after a run: position and counts. One row.

    The token is the newest receive time among the run's messages, or the last stored one
    (``before``, the state table) if that is newer or the run has seen none.
    """
    instant = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    newest = F.date_format(F.max("received_ts"), "yyyy-MM-dd'T'HH:mm:ss.SSS")
    run = extracts.agg(
        newest.alias("token"),
        F.count(F.lit(1)).alias("emails_processed"),
        F.coalesce(F.sum(F.when(F.col("received_ts").isNotNull(), F.size("records"))), F.lit(0))
        .cast("long")
        .alias("records_extracted"),
    )
    token = F.col("token")
    if before is not None:
        token = F.greatest(token, latest_state(before, pipeline).agg(F.max("delta_token")).scalar())
    return run.select(
        F.lit(pipeline).alias("pipeline"),
        token.alias("delta_token"),
        "emails_processed",
        "records_extracted",
        instant.alias("updated_at"),
    )


def latest_state(state: DataFrame, pipeline: str | None = None) -> DataFrame:
    """Newest token of one pipeline, or of each."""
    rows = state if pipeline is None else state.filter(F.col("pipeline") == pipeline)
    return rows.groupBy("pipeline").agg(
        F.max_by("delta_token", "updated_at").alias("delta_token"),
        F.max("updated_at").alias("updated_at"),
    )


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], fmt: str = "parquet") -> None:
    """Partitioned append.

    A rebalance on the partition columns keeps the file count low and splits a partition
    that holds most of the rows over several tasks.
    """
    df.hint("rebalance", *[F.col(c) for c in by]).write.format(fmt).mode("append").partitionBy(
        *by
    ).save(path)
