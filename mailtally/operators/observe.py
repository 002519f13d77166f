"""Job, run, cost and lineage questions over ordinary tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from mailtally.operators.latest import first_n_per_key, latest_per_key, scd2_current, with_position

# --- fixed values: states and run types of the run timeline ---
JOB_RUN = "JOB_RUN"
SUCCEEDED, FAILED, TIMED_OUT = "SUCCEEDED", "FAILED", "TIMED_OUT"
STALE_DAYS, RECENT_DAYS = 30, 7
INFRA, CODE = "INFRA", "CODE"
# --- end of fixed values ---

JOB = ["workspace_id", "job_id"]

STAGE = T.StructType(
    [
        T.StructField("stageId", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("memoryBytesSpilled", T.LongType()),
        T.StructField("diskBytesSpilled", T.LongType()),
        T.StructField("executorRunTime", T.DoubleType()),
    ]
)


def last_seen(runs: DataFrame) -> DataFrame:
    """Last start of every job, job runs only."""
    return (
        runs.filter(F.col("run_type") == JOB_RUN)
        .groupBy(*JOB)
        .agg(F.max("period_start_time").alias("last_executed_at"))
    )


def stale_jobs(
    jobs: DataFrame, runs: DataFrame, as_of: str | datetime, days: int = STALE_DAYS,
    tie: Sequence[str] = (),
) -> DataFrame:
    """Live jobs that never ran or not within the last days. Both sides are one row per job."""
    live = scd2_current(jobs, JOB, "change_time", "delete_time", tie)
    joined = live.join(last_seen(runs), JOB, "left")
    bound = F.date_sub(F.to_date(F.lit(as_of)), days)
    ran = F.col("last_executed_at")
    return joined.filter(ran.isNull() | (ran <= bound)).select(
        *JOB, "name", F.col("change_time").alias("last_modified_at"), "last_executed_at", "tags"
    )


def last_run(
    runs: DataFrame, as_of: str | datetime, job_id: int | None = None, days: int = RECENT_DAYS
) -> DataFrame:
    """Newest run of the last days, of one job or of each."""
    dtype = runs.schema["period_start_time"].dataType
    after = F.lit(as_of).cast(dtype) - F.make_interval(days=F.lit(days))
    recent = runs.filter(F.col("period_start_time") > after)
    order = [F.col("period_start_time").desc(), F.col("run_id").desc()]
    columns = [
        "workspace_id", "job_id", "run_id", "period_start_time", "period_end_time",
        "result_state", "termination_code", "run_duration_seconds",
    ]
    if job_id is not None:
        return recent.filter(F.col("job_id") == job_id).orderBy(*order).limit(1).select(*columns)
    return latest_per_key(recent.select(*columns), ["job_id"], order)


def success_rate(runs: DataFrame, by: Sequence[str] = JOB) -> DataFrame:
    state = F.col("result_state")
    return runs.groupBy(*by).agg(
        F.count(F.lit(1)).alias("runs"),
        F.count_if(state == SUCCEEDED).alias("succeeded"),
        F.count_if(state == FAILED).alias("failed"),
        F.count_if(state == TIMED_OUT).alias("timed_out"),
        F.round(F.avg(F.when(state == SUCCEEDED, 1.0).otherwise(0.0)), 6).alias("success_rate"),
    )


def cost_per_run(runs: DataFrame, usage: DataFrame) -> DataFrame:
    """Cost of each run. Usage is summed per run before the join."""
    cost = usage.groupBy("run_id").agg(
        F.sum(F.col("usage") * F.col("price")).cast("decimal(28,6)").alias("cost")
    )
    zero = F.lit(0).cast("decimal(28,6)")
    return runs.select(*JOB, "run_id", "result_state").join(cost, "run_id", "left").select(
        *JOB, "run_id", "result_state", F.coalesce("cost", zero).alias("cost")
    )


def run_extremes(runs: DataFrame, n: int = 10) -> DataFrame:
    """Slowest and fastest of the last ``n`` runs of every job."""
    order = [F.col("period_start_time").desc(), F.col("run_id").desc()]
    slim = runs.select("job_id", "run_id", "period_start_time", "execution_duration")
    recent = first_n_per_key(slim, ["job_id"], order, n)
    # unfinished runs have no duration: they count as runs and are neither slow nor fast
    run = F.when(F.col("execution_duration").isNotNull(), F.struct("execution_duration", "run_id"))
    return recent.groupBy("job_id").agg(
        F.count(F.lit(1)).alias("runs"),
        F.max(run)["run_id"].alias("slowest_run_id"),
        F.max("execution_duration").alias("slowest_duration"),
        F.min(run)["run_id"].alias("fastest_run_id"),
        F.min("execution_duration").alias("fastest_duration"),
    )


def bottleneck(runs: DataFrame) -> DataFrame:
    """Is a run bound by cluster setup or by its code?"""
    setup, execution = F.col("setup_duration"), F.col("execution_duration")
    return runs.select(
        "job_id",
        "run_id",
        "setup_duration",
        "execution_duration",
        F.when(setup > execution, F.lit(INFRA)).otherwise(F.lit(CODE)).alias("bottleneck"),
    )


def spill_rank(stages: DataFrame, k: int | None = 10, col: str = "stage") -> DataFrame:
    """Stages by spilled memory, from exported stage records (JSON text)."""
    read = stages.select(F.from_json(col, STAGE).alias("s")).select("s.*")
    ranked = read.groupBy("stageId").agg(
        F.sum("memoryBytesSpilled").alias("memory_spilled"),
        F.sum("diskBytesSpilled").alias("disk_spilled"),
        F.count(F.lit(1)).alias("attempts"),
    ).withColumnRenamed("stageId", "stage_id")
    if k is None:
        return ranked
    return ranked.orderBy(F.col("memory_spilled").desc(), F.col("stage_id").asc()).limit(k)


def task_breakdown(tasks: DataFrame) -> DataFrame:
    """Time per task of a run and its share. Totals come from the per-task sums."""
    per_task = tasks.groupBy("run_id", "task_key").agg(
        F.sum("duration").cast("decimal(28,2)").alias("duration"), F.count(F.lit(1)).alias("attempts")
    )
    totals = per_task.groupBy(F.col("run_id").alias("_run")).agg(F.sum("duration").alias("_total"))
    joined = per_task.join(totals, F.col("run_id").eqNullSafe(F.col("_run")))
    share = F.col("duration").cast("double") / F.col("_total").cast("double")
    return joined.select(
        "run_id", "task_key", "duration", "attempts",
        F.when(F.col("_total") > 0, F.round(share, 6)).alias("share"),
    )


def heavy_queries(history: DataFrame, k: int = 10, by: str = "duration") -> DataFrame:
    """Statements with the largest duration, spill or bytes read."""
    totals = history.groupBy("statement_id").agg(
        F.count(F.lit(1)).alias("executions"),
        F.sum("duration").cast("decimal(28,2)").alias("duration"),
        F.sum("spilled_bytes").alias("spilled_bytes"),
        F.sum("read_bytes").alias("read_bytes"),
    )
    return totals.orderBy(F.col(by).desc(), F.col("statement_id").asc()).limit(k)


# --- lineage ------------------------------------------------------------------------------


def producers(lineage: DataFrame, runs: DataFrame, table: str | None = None) -> DataFrame:
    """Jobs that wrote a table directly, with the state of the writing run.

    For one table, or for every table. A run timeline has a row per slice of a long run;
    only the last slice of each (job, run) is joined, so slices do not multiply the writes.
    """
    direct = lineage.filter(F.col("direct_access"))
    if table is not None:
        direct = direct.filter(F.col("target_table_full_name") == table)
    job = F.col("entity_metadata.job_info.job_id")
    run = F.col("entity_metadata.job_info.job_run_id")
    writes = direct.select(
        "source_table_full_name",
        "target_table_full_name",
        job.alias("producing_job_id"),
        run.alias("_run_id"),
    )
    end = F.struct("period_end_time", "result_state")
    last = F.max(F.struct(F.coalesce("period_end_time", "period_start_time"), end))
    known = (
        runs.groupBy(F.col("job_id").alias("_job"), F.col("run_id").alias("_run"))
        .agg(last["col2"].alias("_last"))
        .select(
            "_job",
            "_run",
            F.col("_last.result_state").alias("result_state"),
            F.col("_last.period_end_time").alias("last_run_completed_at"),
        )
    )
    same = (F.col("producing_job_id") == F.col("_job")) & (F.col("_run_id") == F.col("_run"))
    return writes.join(known, same, "left").select(
        "source_table_full_name", "target_table_full_name", "producing_job_id",
        "result_state", "last_run_completed_at",
    )


def lineage_of(lineage: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Lineage rows of a table in either direction, by name or by storage path."""

    def named(col: str, value: str) -> Column:
        return F.coalesce(F.col(col) == value, F.lit(False))

    hit = named("source_table_full_name", name) | named("target_table_full_name", name)
    if path is not None:
        hit = hit | named("source_path", path) | named("target_path", path)
    return lineage.filter(hit)


# --- orders for display ------------------------------------------------------------------------
# As a global sort for results that people look at, or as a position that stays with the row.


def _stale_order() -> list[Column]:
    return [F.col("last_executed_at").asc_nulls_first(), F.col("job_id").asc()]


def _lineage_order(time: str) -> list[Column]:
    names = [F.col(c).asc() for c in ("source_table_full_name", "target_table_full_name")]
    return [F.col(time).desc(), *names]


def stale_order(stale: DataFrame) -> DataFrame:
    """Jobs that never ran first, then those that ran longest ago."""
    return stale.orderBy(*_stale_order())


def lineage_order(lineage: DataFrame, time: str = "event_time") -> DataFrame:
    """Newest lineage rows first."""
    return lineage.orderBy(*_lineage_order(time))


def stale_positions(stale: DataFrame, tie: Sequence[str] = ("workspace_id",)) -> DataFrame:
    """The rows of :func:`stale_order` with their ``position``."""
    return with_position(stale, [*_stale_order(), *map(F.col, tie)])


def lineage_positions(lineage: DataFrame, time: str = "event_time") -> DataFrame:
    """The rows of :func:`lineage_order` with their ``position``."""
    return with_position(lineage, _lineage_order(time))
