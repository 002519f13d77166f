"""Queries of landing folders, stored statistics, positions and hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from mailtally.operators import observe, recon, statistics, upsert
from mailtally.operators.latest import version_resends
from mailtally.operators.profile import DISTINCT_RSD
from mailtally.plans import fixtures as fx
from mailtally.plans.oracle import KV, RECON, RUNS
from mailtally.plans.queries_messages import kv
from mailtally.plans.queries_recon import FULL, r_full
from mailtally.plans.queries_tables import LINEAGE, SCD2, j_stale_jobs
from mailtally.plans.registry import query
from mailtally.session import scratch_path
from mailtally.sources import catalog, messages as msg

# --- landing folders --------------------------------------------------------------------------


@query(
    """
WITH landed AS (
  SELECT strftime(o_orderdate, '%Y-%m') AS folder, month(o_orderdate) AS m,
         month(o_orderdate) = 5 AND o_orderkey % 7 = 0 AS cut FROM orders),
files AS (
  SELECT folder, CASE WHEN m = 7 THEN 0 ELSE count_if(NOT cut) END AS rows,
         CASE WHEN m = 7 THEN 0 ELSE count_if(cut) END AS broken_rows FROM landed GROUP BY folder, m)
SELECT folder, rows, broken_rows, CASE WHEN rows = 0 OR broken_rows > 0 THEN 'FAILED' ELSE 'LOADED' END AS bronze_status,
       CASE WHEN rows + broken_rows = 0 THEN 'no readable record'
            WHEN broken_rows > 0 THEN broken_rows || ' broken records' END AS reason
FROM files
"""
)
def s_file_arrivals(spark: SparkSession, sf: str) -> DataFrame:
    """One file a month; those of May hold lines that were cut, those of July only blank lines."""
    line = F.to_json(F.struct("o_orderkey", "o_totalprice"))
    month = F.month("o_orderdate")
    cut = (month == 5) & (F.col("o_orderkey") % 7 == 0)
    landed = fx.table(spark, sf, "orders").withColumn("json", line).select(
        F.date_format("o_orderdate", "yyyy-MM").alias("folder"),
        F.when(month == 7, F.lit("")).when(cut, F.left("json", F.lit(8))).otherwise(F.col("json")).alias("value"),
    )
    path = scratch_path(spark, "arrivals")
    landed.repartition("folder").write.partitionBy("folder").text(path)
    schema = fx.table(spark, sf, "orders").select("o_orderkey", "o_totalprice").schema
    log = catalog.file_arrivals(spark, path, schema)
    folder = F.regexp_extract("input_file_name", "folder=([^/]+)/", 1)
    return log.select(folder.alias("folder"), "rows", "broken_rows", "bronze_status", "reason")


@query(f"WITH {KV} SELECT id, received_at FROM kv WHERE ts >= TIMESTAMP '1999-06-01 00:00:00'")
def s_since_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Messages stored by month: older folders are not opened."""
    path = scratch_path(spark, "by-month")
    stored = msg.add_time_part(kv(spark, sf).select("id", "received_at", "received_ts"))
    stored.hint("rebalance", "received_part").write.partitionBy("received_part").parquet(path)
    messages = spark.read.schema(stored.schema).parquet(path)
    return msg.since(messages, "1999-06-01 00:00:00", part="received_part").select("id", "received_at")


# --- statistics -------------------------------------------------------------------------------

MEASURED = {"l_orderkey": True, "l_partkey": True, "l_quantity": True, "l_linestatus": False}


def _stored_profile_sql(columns: dict[str, bool]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS total_rows, count(*) - count({c}) AS null_count,
        {f'CAST(min({c}) AS DOUBLE)' if n else 'CAST(NULL AS DOUBLE)'} AS min_value,
        {f'CAST(max({c}) AS DOUBLE)' if n else 'CAST(NULL AS DOUBLE)'} AS max_value,
        count(DISTINCT {c}) AS exact_distinct, true AS distinct_close,
        {'true' if n else 'CAST(NULL AS BOOLEAN)'} AS median_close FROM lineitem"""
        for c, n in columns.items()
    )


@query(_stored_profile_sql(MEASURED))
def a_profile_stored(spark: SparkSession, sf: str) -> DataFrame:
    """A table by year: statistics of the years up to 1997, then of the others, then the profile."""
    lines = fx.table(spark, sf, "lineitem").select(*MEASURED, F.year("l_shipdate").alias("ship_year"))
    path, stats = scratch_path(spark, "by-year"), scratch_path(spark, "statistics")
    lines.hint("rebalance", "ship_year").write.partitionBy("ship_year").parquet(path)
    table = spark.read.schema(lines.schema).parquet(path)
    statistics.refresh_statistics(table.where("ship_year <= 1997"), ["ship_year"], stats)
    found = statistics.profile_from(statistics.refresh_statistics(table, ["ship_year"], stats))
    exact = None
    for c, numeric in MEASURED.items():
        groups = lines.groupBy(F.col(c).alias("v")).agg(F.count(F.lit(1)).alias("n"))
        value = F.col("v").cast("double") if numeric else F.lit(None).cast("double")
        one = groups.select(value.alias("v"), "n", F.lit(c).alias("_column"))
        exact = one if exact is None else exact.union(one)
    # ranks of the approximate median, from counts of the values and not from the sketch
    ranked = exact.join(found.select("column", "median_value"), F.col("_column") == F.col("column"))
    ranks = ranked.groupBy("_column").agg(
        F.count(F.lit(1)).alias("exact_distinct"),
        (F.sum(F.when(F.col("v") < F.col("median_value"), F.col("n")).otherwise(0)) / F.sum("n")).alias("below"),
        (F.sum(F.when(F.col("v") <= F.col("median_value"), F.col("n")).otherwise(0)) / F.sum("n")).alias("up_to"),
    )
    off = F.abs(F.col("distinct_count") - F.col("exact_distinct"))
    close = (F.col("below") <= 0.53) & (F.col("up_to") >= 0.47)
    return found.join(ranks, F.col("column") == F.col("_column")).select(
        "column", "total_rows", "null_count", "min_value", "max_value", "exact_distinct",
        (off <= 3 * DISTINCT_RSD * F.col("exact_distinct") + 1).alias("distinct_close"),
        F.when(F.col("median_value").isNotNull(), close).alias("median_close"),
    )


# --- positions and bursts ---------------------------------------------------------------------


@query(
    f"""
WITH {RUNS}, {SCD2}, own AS (SELECT * FROM runs WHERE run_type = 'JOB_RUN'),
last AS (
  SELECT workspace_id, job_id, name, (SELECT max(period_start_time) FROM own
         WHERE own.job_id = cur.job_id AND own.workspace_id = cur.workspace_id) AS last_executed_at
  FROM cur)
SELECT workspace_id, job_id, name, last_executed_at,
       row_number() OVER (ORDER BY last_executed_at ASC NULLS FIRST, job_id, workspace_id) AS position
FROM last WHERE last_executed_at IS NULL OR last_executed_at <= TIMESTAMP '2024-01-29 00:00:00'
"""
)
def l_stale_order(spark: SparkSession, sf: str) -> DataFrame:
    stale = observe.stale_positions(j_stale_jobs(spark, sf))
    return stale.select("workspace_id", "job_id", "name", "last_executed_at", F.col("position").cast("long").alias("position"))


@query(
    f"""
WITH {LINEAGE} SELECT source_table_full_name, target_table_full_name, event_time,
       row_number() OVER (ORDER BY event_time DESC, source_table_full_name NULLS FIRST, target_table_full_name NULLS FIRST) AS position
FROM lin WHERE direct_access
"""
)
def l_lineage_order(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.lineage(fx.table(spark, sf, "lineitem")).where("direct_access")
    return observe.lineage_positions(rows).select(
        "source_table_full_name", "target_table_full_name", "event_time", F.col("position").cast("long").alias("position")
    )


@query(
    f"""
WITH {RECON}, {FULL} SELECT return_flag AS key_col1_value, line_status AS key_col2_value, ship_month AS key_col3_value, kpis,
       row_number() OVER (ORDER BY return_flag DESC NULLS LAST, kpis NULLS FIRST, line_status NULLS FIRST, ship_month NULLS FIRST) AS position
FROM full_out
"""
)
def l_presentation_order(spark: SparkSession, sf: str) -> DataFrame:
    rows = recon.presentation_positions(r_full(spark, sf))
    return rows.select(
        *[f"key_col{i}_value" for i in (1, 2, 3)], "kpis", F.col("position").cast("long").alias("position")
    )


@query(
    """
WITH sent AS (SELECT 'e-' || event_id AS id, CASE WHEN event_id % 3 = 0 THEN 'hot' ELSE 'u-' || user_id END AS report,
                     CASE WHEN event_id % 3 = 0 THEN TIMESTAMP '2024-01-15 08:00:00' ELSE ts END AS received_ts FROM events)
SELECT id, report, received_ts, row_number() OVER (PARTITION BY report ORDER BY received_ts, id) AS version FROM sent
"""
)
def w_resend_burst(spark: SparkSession, sf: str) -> DataFrame:
    """A report that holds a third of all rows, all resent in one second."""
    hot = F.col("event_id") % 3 == 0
    sent = fx.table(spark, sf, "events").select(
        F.concat(F.lit("e-"), "event_id").alias("id"),
        F.when(hot, F.lit("hot")).otherwise(F.concat(F.lit("u-"), "user_id")).alias("report"),
        F.when(hot, F.lit("2024-01-15 08:00:00").cast("timestamp")).otherwise(F.col("ts").cast("timestamp")).alias("received_ts"),
    )
    numbered = version_resends(sent, ["report"], bursts=True)
    return numbered.select("id", "report", "received_ts", F.col("version").cast("long").alias("version"))


# --- match join -------------------------------------------------------------------------------


@query(
    """
WITH t AS (SELECT CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_partkey END AS part_key, l_orderkey AS order_key,
                  l_linenumber AS line, l_quantity AS quantity FROM lineitem),
s AS (SELECT CASE p_partkey % 10 WHEN 0 THEN p_partkey + 100000000 ELSE p_partkey END AS part_key, CAST(p_size AS DOUBLE) AS quantity FROM part
      UNION ALL SELECT 0, -1.0)
SELECT t.part_key, order_key, line, COALESCE(s.quantity, t.quantity) AS quantity FROM t LEFT JOIN s USING (part_key)
UNION ALL SELECT part_key, NULL, NULL, quantity FROM s ANTI JOIN t USING (part_key)
"""
)
def j_match_hot(spark: SparkSession, sf: str) -> DataFrame:
    """Every line of a part takes the source's quantity; one part has a third of all lines."""
    target = fx.table(spark, sf, "lineitem").select(
        F.when(F.col("l_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("l_partkey")).alias("part_key"),
        F.col("l_orderkey").alias("order_key"), F.col("l_linenumber").alias("line"), F.col("l_quantity").alias("quantity"),
    )
    key = F.col("p_partkey")
    parts = fx.table(spark, sf, "part").select(
        F.when(key % 10 == 0, key + 100000000).otherwise(key).alias("part_key"),
        F.col("p_size").cast("double").alias("quantity"),
    )
    source = parts.union(spark.range(1).select(F.lit(0).cast("long"), F.lit(-1.0)))
    return upsert.merge_frames(target, source, "part_key", guard=None, hot_keys=True)
