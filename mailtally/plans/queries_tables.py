"""Queries of the profile, quality, window, enrichment and observability operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from mailtally.operators import observe, profile as prof
from mailtally.operators.enrich import enrich, intake_summary, weekly
from mailtally.operators.latest import latest_per_key, scd2_current, version_resends
from mailtally.operators.routing import route_first
from mailtally.operators.sinks import audit_failures
from mailtally.operators.templates import extract_metadata
from mailtally.plans import fixtures as fx
from mailtally.plans.oracle import META, RECORDS, RUNS
from mailtally.plans.queries_extract import META_REGEX, meta
from mailtally.plans.queries_messages import kv, kv_rules
from mailtally.plans.registry import query

# --- profiles ---------------------------------------------------------------------------------


def _nullable(spark: SparkSession, sf: str) -> DataFrame:
    return fx.documents_with_labels(fx.table(spark, sf, "documents"), fx.table(spark, sf, "labels"))


def _profile_sql(columns: dict[str, bool]) -> str:
    parts = []
    for name, numeric in columns.items():
        skew = "CAST(NULL AS DOUBLE)"
        if numeric:
            # Population skewness: third central moment over the 1.5th power of the variance.
            skew = (
                f"(SELECT round(avg(power({name} - m, 3)) / power(avg(power({name} - m, 2)), 1.5), 4) "
                f"FROM base, (SELECT avg({name}) AS m FROM base))"
            )
        parts.append(
            f"SELECT '{name}' AS \"column\", count(*) AS total_rows, count(*) - count({name}) AS null_count, "
            f"round((count(*) - count({name})) / count(*) * 100, 2) AS null_pct, {skew} AS skewness, "
            f"{'TRUE' if numeric else 'FALSE'} AS is_numeric FROM base"
        )
    return " UNION ALL ".join(parts)


DOC_COLUMNS = {
    "doc_id": True, "lang": False, "source": False, "n_chars": True, "quality": True, "toxic": True,
}


@query(
    "WITH base AS (SELECT doc_id, lang, source, n_chars, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)) "
    + _profile_sql(DOC_COLUMNS)
)
def a_profile(spark: SparkSession, sf: str) -> DataFrame:
    return prof.profile(_nullable(spark, sf), distinct=False)


PROFILED = (
    "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
)


@query(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS total_rows, count(*) - count({c}) AS null_count,
        count(DISTINCT {c}) AS exact_distinct, true AS within_three_deviations FROM orders"""
        for c in PROFILED
    )
)
def a_profile_distinct(spark: SparkSession, sf: str) -> DataFrame:
    """The whole profile, its approximate distinct counts next to exact ones."""
    orders = fx.table(spark, sf, "orders").select(*PROFILED)
    exact = None
    for c in PROFILED:
        one = orders.select(c).distinct().agg(F.lit(c).alias("_column"), F.count(c).alias("exact_distinct"))
        exact = one if exact is None else exact.union(one)
    both = prof.profile(orders).join(exact, F.col("column") == F.col("_column"))
    off = F.abs(F.col("distinct_count") - F.col("exact_distinct"))
    return both.select(
        "column", "total_rows", "null_count", "exact_distinct",
        (off <= 3 * prof.DISTINCT_RSD * F.col("exact_distinct") + 1).alias("within_three_deviations"),
    )


@query(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST(min(v) AS DOUBLE) AS min_value, CAST(max(v) AS DOUBLE) AS max_value,
        round(CAST(sum(v) AS DOUBLE) / count(v), 6) AS avg_value, CAST(sum(v) AS DECIMAL(38,3)) AS sum_value
        FROM (SELECT CAST(CAST({c} AS DECIMAL(18,2)) / 10 AS DECIMAL(20,3)) AS v FROM lineitem)"""
        for c in ("l_tax", "l_discount")
    )
)
def a_numeric_profile_fine(spark: SparkSession, sf: str) -> DataFrame:
    """Values with three decimals keep them."""
    line = fx.table(spark, sf, "lineitem").select(
        *[(F.col(c).cast("decimal(18,2)") / 10).cast("decimal(20,3)").alias(c) for c in ("l_tax", "l_discount")]
    )
    return prof.numeric_profile(line, line.columns).withColumn("avg_value", F.round("avg_value", 6))


@query(
    "WITH base AS (SELECT doc_id, lang, source, n_chars, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS null_pct FROM base"
        for c in DOC_COLUMNS
    )
)
def a_null_profile(spark: SparkSession, sf: str) -> DataFrame:
    return prof.null_profile(_nullable(spark, sf))


@query(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST(min(v) AS DOUBLE) AS min_value, CAST(max(v) AS DOUBLE) AS max_value,
        round(CAST(sum(v) AS DOUBLE) / count(v), 4) AS avg_value, CAST(sum(v) AS DECIMAL(38,2)) AS sum_value
        FROM (SELECT CAST({c} AS DECIMAL(18,2)) AS v FROM lineitem)"""
        for c in ("l_quantity", "l_extendedprice", "l_tax")
    )
)
def a_numeric_profile(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["l_quantity", "l_extendedprice", "l_tax"]
    line = fx.table(spark, sf, "lineitem").select(*columns)
    profiled = prof.numeric_profile(line, columns, "decimal(18,2)")
    return profiled.withColumn("avg_value", F.round("avg_value", 4))


@query(
    """
SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS key_groups, count(*) FILTER (n > 1) AS duplicate_groups,
       CAST(sum(n - 1) AS BIGINT) AS duplicate_rows, max(n) AS largest_group, CAST(0 AS BIGINT) AS null_key_rows,
       count(*) FILTER (n > 1) = 0 AS is_unique
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
"""
)
def a_grain(spark: SparkSession, sf: str) -> DataFrame:
    return prof.grain_check(fx.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


CANDIDATES = [
    ["l_orderkey"],
    ["l_orderkey", "l_linenumber"],
    ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"],
    ["l_returnflag", "l_linestatus"],
]


@query(
    " UNION ALL ".join(
        f"SELECT '{', '.join(keys)}' AS key_set, CAST({len(keys)} AS INTEGER) AS key_count, count(*) AS distinct_keys, "
        f"CAST(sum(n) AS BIGINT) AS total_rows, round(count(*) / sum(n), 6) AS distinctness "
        f"FROM (SELECT count(*) AS n FROM lineitem GROUP BY {', '.join(keys)})"
        for keys in CANDIDATES
    )
)
def a_grain_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return prof.grain_candidates(fx.table(spark, sf, "lineitem"), CANDIDATES)


@query(
    """
SELECT count(*) FILTER (quality IS NULL) AS dq_errors, count(quality) AS clean_rows,
       count(DISTINCT CASE WHEN quality IS NOT NULL THEN source END) AS latest_rows
FROM documents LEFT JOIN labels USING (doc_id)
"""
)
def a_dq_counts(spark: SparkSession, sf: str) -> DataFrame:
    return prof.dq_counts(_nullable(spark, sf), "quality", ["source"])


@query(
    f"""
WITH {RECORDS} SELECT customer_name, count(*) AS records, CAST(sum(CAST(payment_amount AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total_amount
FROM rec GROUP BY 1
"""
)
def a_intake_summary(spark: SparkSession, sf: str) -> DataFrame:
    return intake_summary(route_first(kv(spark, sf), kv_rules()))


@query(
    """
SELECT event_type AS pipeline, CASE event_type WHEN 'error' THEN 'FAILED' ELSE CASE WHEN value > 100 THEN 'SCHEMA_MISMATCH' ELSE 'SUCCESS' END END AS status,
       count(*) AS messages, count(*) / sum(count(*)) OVER (PARTITION BY event_type) AS share
FROM events GROUP BY 1, 2
"""
)
def a_audit_failures(spark: SparkSession, sf: str) -> DataFrame:
    log = fx.table(spark, sf, "events").select(
        F.col("event_type").alias("pipeline"),
        F.when(F.col("event_type") == "error", F.lit("FAILED"))
        .when(F.col("value") > 100, F.lit("SCHEMA_MISMATCH"))
        .otherwise(F.lit("SUCCESS"))
        .alias("status"),
    )
    return audit_failures(log, ["pipeline"])


# --- joins with master data -------------------------------------------------------------------


def _enriched(spark: SparkSession, sf: str) -> DataFrame:
    line = fx.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice"
    )
    part, supplier = fx.table(spark, sf, "part"), fx.table(spark, sf, "supplier")
    with_part = enrich(line, part, {"l_partkey": "p_partkey"}, ["p_brand", "p_type"])
    return enrich(with_part, supplier, {"l_suppkey": "s_suppkey"}, ["s_name"])


@query(
    """
SELECT l_orderkey, l_partkey, l_suppkey, l_quantity, p_brand, p_type, s_name
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey
"""
)
def j_enrich(spark: SparkSession, sf: str) -> DataFrame:
    return _enriched(spark, sf).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "p_brand", "p_type", "s_name"
    )


@query(
    """
SELECT l_partkey, p_brand, CAST(date_trunc('week', l_shipdate) AS DATE) AS week_start, count(*) AS line_count,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS quantity,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS amount
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3
"""
)
def a_weekly(spark: SparkSession, sf: str) -> DataFrame:
    kpis = {
        "line_count": F.count(F.lit(1)),
        "quantity": F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("decimal(28,2)"),
        "amount": F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("decimal(28,2)"),
    }
    line = fx.table(spark, sf, "lineitem").select("l_partkey", "l_shipdate", "l_quantity", "l_extendedprice")
    # Aggregate first: the join then carries one row per part and week.
    per_week = weekly(line, ["l_partkey"], "l_shipdate", kpis)
    named = enrich(per_week, fx.table(spark, sf, "part"), {"l_partkey": "p_partkey"}, ["p_brand"])
    return named.select("l_partkey", "p_brand", "week_start", *kpis)


# --- windows ----------------------------------------------------------------------------------


@query(
    """
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
"""
)
def w_latest(spark: SparkSession, sf: str) -> DataFrame:
    orders = fx.table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return latest_per_key(orders, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])


SCD2 = """
cur AS (SELECT * FROM (
  SELECT o_custkey % 3 AS workspace_id, o_custkey AS job_id, 'job-' || o_custkey AS name, o_orderdate AS change_time,
         CASE WHEN o_orderstatus = 'F' AND o_orderkey % 5 = 0 THEN o_orderdate END AS delete_time, o_orderpriority AS tags
  FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
  WHERE delete_time IS NULL)
"""


@query(f"WITH {SCD2} SELECT workspace_id, job_id, name, change_time, tags FROM cur")
def w_scd2(spark: SparkSession, sf: str) -> DataFrame:
    defs = fx.job_defs(fx.table(spark, sf, "orders"))
    current = scd2_current(defs, observe.JOB, "change_time", "delete_time", ["version_id"])
    return current.select("workspace_id", "job_id", "name", "change_time", "tags")


@query(
    f"""
WITH {META} SELECT id, year, week, report_name,
       row_number() OVER (PARTITION BY year, week, report_name ORDER BY ts, id) AS version FROM meta
"""
)
def w_resend(spark: SparkSession, sf: str) -> DataFrame:
    found = extract_metadata(meta(spark, sf), META_REGEX)
    slim = found.select("id", "year", "week", "report_name", "received_ts")
    numbered = version_resends(slim, ["year", "week", "report_name"])
    return numbered.select("id", "year", "week", "report_name", F.col("version").cast("long").alias("version"))


@query(
    f"""
WITH {META} SELECT id, year, week, report_name FROM meta
QUALIFY row_number() OVER (PARTITION BY year, week, report_name ORDER BY ts DESC, id DESC) = 1
"""
)
def w_resend_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    found = extract_metadata(meta(spark, sf), META_REGEX)
    slim = found.select("id", "year", "week", "report_name", "received_ts")
    return version_resends(slim, ["year", "week", "report_name"], mode="overwrite").drop("received_ts")


# --- observability ----------------------------------------------------------------------------


def runs(spark: SparkSession, sf: str) -> DataFrame:
    return fx.job_runs(fx.table(spark, sf, "events"))


@query(
    f"""
WITH {RUNS} SELECT workspace_id, job_id, period_start_time AS last_executed_at FROM runs WHERE run_type = 'JOB_RUN'
QUALIFY row_number() OVER (PARTITION BY workspace_id, job_id ORDER BY period_start_time DESC) = 1
"""
)
def a_last_seen(spark: SparkSession, sf: str) -> DataFrame:
    return observe.last_seen(runs(spark, sf))


@query(
    f"""
WITH {RUNS} SELECT workspace_id, job_id, count(*) AS runs, count(*) FILTER (result_state = 'SUCCEEDED') AS succeeded,
       count(*) FILTER (result_state = 'FAILED') AS failed, count(*) FILTER (result_state = 'TIMED_OUT') AS timed_out,
       round(avg(CASE WHEN result_state = 'SUCCEEDED' THEN 1.0 ELSE 0.0 END), 6) AS success_rate
FROM runs GROUP BY 1, 2
"""
)
def a_success_rate(spark: SparkSession, sf: str) -> DataFrame:
    return observe.success_rate(runs(spark, sf))


@query(
    f"""
WITH {RUNS} SELECT workspace_id, job_id, run_id, result_state,
       CAST(CAST(value / 10 AS DECIMAL(18,4)) * CAST(CASE event_id % 3 WHEN 0 THEN '0.15' WHEN 1 THEN '0.30' ELSE '0.55' END AS DECIMAL(6,2)) AS DECIMAL(28,6)) AS cost
FROM runs JOIN events ON event_id = run_id
"""
)
def a_cost_per_run(spark: SparkSession, sf: str) -> DataFrame:
    return observe.cost_per_run(runs(spark, sf), fx.job_usage(fx.table(spark, sf, "events")))


@query(
    f"""
WITH {RUNS}, recent AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY period_start_time DESC, run_id DESC) <= 10)
SELECT job_id, count(*) AS runs,
       arg_max(run_id, struct_pack(d := execution_duration, r := run_id)) AS slowest_run_id, max(execution_duration) AS slowest_duration,
       arg_min(run_id, struct_pack(d := execution_duration, r := run_id)) AS fastest_run_id, min(execution_duration) AS fastest_duration
FROM recent GROUP BY 1
"""
)
def a_run_extremes(spark: SparkSession, sf: str) -> DataFrame:
    return observe.run_extremes(runs(spark, sf))


@query(
    f"""
WITH {RUNS} SELECT job_id, run_id, setup_duration, execution_duration,
       CASE WHEN setup_duration > execution_duration THEN 'INFRA' ELSE 'CODE' END AS bottleneck FROM runs
"""
)
def a_bottleneck(spark: SparkSession, sf: str) -> DataFrame:
    return observe.bottleneck(runs(spark, sf))


@query(
    """
SELECT event_id % 20 AS stage_id, CAST(sum(k * 1024) AS BIGINT) AS memory_spilled, CAST(sum(k * 512) AS BIGINT) AS disk_spilled, count(*) AS attempts
FROM (SELECT event_id, CAST(regexp_extract(props, '(\\d+)', 1) AS BIGINT) AS k FROM events)
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10
"""
)
def a_spill(spark: SparkSession, sf: str) -> DataFrame:
    return observe.spill_rank(fx.stage_metrics(fx.table(spark, sf, "events")), 10)


@query(
    """
SELECT user_id AS run_id, 'task-' || (event_id % 20) AS task_key, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS duration, count(*) AS attempts,
       CASE WHEN sum(sum(CAST(value AS DECIMAL(18,2)))) OVER (PARTITION BY user_id) > 0 THEN
       round(CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / CAST(sum(sum(CAST(value AS DECIMAL(18,2)))) OVER (PARTITION BY user_id) AS DOUBLE), 6) END AS share
FROM events GROUP BY 1, 2
"""
)
def a_task_breakdown(spark: SparkSession, sf: str) -> DataFrame:
    return observe.task_breakdown(fx.task_runs(fx.table(spark, sf, "events")))


@query(
    """
SELECT 'stmt-' || (event_id % 20) AS statement_id, count(*) AS executions, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS duration,
       CAST(sum(k * 1024) AS BIGINT) AS spilled_bytes, CAST(sum(k * 4096) AS BIGINT) AS read_bytes
FROM (SELECT *, CAST(regexp_extract(props, '(\\d+)', 1) AS BIGINT) AS k FROM events)
GROUP BY 1 ORDER BY duration DESC, statement_id LIMIT 5
"""
)
def a_heavy_queries(spark: SparkSession, sf: str) -> DataFrame:
    return observe.heavy_queries(fx.query_history(fx.table(spark, sf, "events")), 5)


@query(
    f"""
WITH {RUNS}, {SCD2}, own AS (SELECT * FROM runs WHERE run_type = 'JOB_RUN')
SELECT workspace_id, job_id, name, change_time AS last_modified_at, tags,
       (SELECT arg_max(period_start_time, period_start_time) FROM own
        WHERE own.job_id = cur.job_id AND own.workspace_id = cur.workspace_id) AS last_executed_at
FROM cur WHERE NOT EXISTS (SELECT 1 FROM own WHERE own.job_id = cur.job_id
                           AND own.workspace_id = cur.workspace_id AND period_start_time > TIMESTAMP '2024-01-29 00:00:00')
"""
)
def j_stale_jobs(spark: SparkSession, sf: str) -> DataFrame:
    defs = fx.job_defs(fx.table(spark, sf, "orders"))
    return observe.stale_jobs(defs, runs(spark, sf), "2024-02-28 00:00:00", tie=["version_id"])


LINEAGE = """
lin AS (
  SELECT CASE WHEN l_linenumber <> 4 THEN 'p_' || l_partkey END AS source_table_full_name, 's_' || l_suppkey AS target_table_full_name,
         CASE WHEN l_linenumber = 4 THEN '/lake/p_' || l_partkey END AS source_path, l_returnflag <> 'R' AS direct_access,
         l_orderkey % 150 AS job_id, l_orderkey AS job_run_id, l_shipdate AS event_time
  FROM lineitem)
"""


@query(
    f"""
WITH {RUNS}, {LINEAGE}
SELECT source_table_full_name, target_table_full_name, lin.job_id AS producing_job_id, result_state, period_end_time AS last_run_completed_at
FROM lin LEFT JOIN runs ON lin.job_id = runs.job_id AND lin.job_run_id = runs.run_id WHERE direct_access
"""
)
def j_producers(spark: SparkSession, sf: str) -> DataFrame:
    return observe.producers(fx.lineage(fx.table(spark, sf, "lineitem")), runs(spark, sf))


@query(
    f"""
WITH {LINEAGE} SELECT source_table_full_name, target_table_full_name, source_path, job_id, event_time FROM lin
WHERE source_table_full_name = 'p_7' OR target_table_full_name = 'p_7' OR source_path = '/lake/p_7'
"""
)
def j_lineage_of(spark: SparkSession, sf: str) -> DataFrame:
    rows = observe.lineage_of(fx.lineage(fx.table(spark, sf, "lineitem")), "p_7", "/lake/p_7")
    return rows.select(
        "source_table_full_name", "target_table_full_name", "source_path",
        F.col("entity_metadata.job_info.job_id").alias("job_id"), "event_time",
    )


@query(
    f"""
WITH {RUNS} SELECT workspace_id, job_id, run_id, period_start_time, period_end_time, result_state, termination_code, run_duration_seconds
FROM runs WHERE period_start_time > TIMESTAMP '2024-01-24 00:00:00'
QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY period_start_time DESC, run_id DESC) = 1
"""
)
def l_last_run(spark: SparkSession, sf: str) -> DataFrame:
    return observe.last_run(runs(spark, sf), fx.AS_OF_EVENTS)
