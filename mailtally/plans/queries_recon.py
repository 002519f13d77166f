"""Queries of the reconciliation operators."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, functions as F

from mailtally.operators import recon
from mailtally.plans import fixtures as fx
from mailtally.plans.oracle import RECON
from mailtally.plans.registry import query

GRAIN = ["return_flag", "line_status", "ship_month"]
KPIS = ["quantity", "amount", "line_count"]


def kpi_columns() -> dict:
    """KPIs over amounts in hundredths."""

    def total(col: str):
        return (F.sum(col).cast("decimal(24,0)") * F.lit(Decimal("0.01"))).cast("decimal(28,2)")

    return {
        "quantity": total("quantity"),
        "amount": total("amount"),
        "line_count": F.count(F.lit(1)),
    }


def sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    line = fx.table(spark, sf, "lineitem")
    return fx.recon_source(line), fx.recon_target(line)


def aggregates(spark: SparkSession, sf: str, grain: list[str] = GRAIN) -> tuple[DataFrame, DataFrame]:
    source, target = sides(spark, sf)
    return (
        recon.agg_at_grain(source, grain, kpi_columns()),
        recon.agg_at_grain(target, grain, kpi_columns()),
    )


@query(
    f"""
WITH {RECON} SELECT return_flag, line_status, ship_month, CAST(quantity AS DECIMAL(28,2)) AS quantity,
       CAST(amount AS DECIMAL(28,2)) AS amount, line_count FROM tagg
"""
)
def a_agg_grain(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates(spark, sf)[1]


@query(f"WITH {RECON} SELECT max(loaded_at) AS source_last_refresh_time FROM src")
def a_refresh(spark: SparkSession, sf: str) -> DataFrame:
    return recon.refresh_time(sides(spark, sf)[0], "loaded_at", "source_last_refresh_time")


@query(f"WITH {RECON} SELECT * FROM skpi")
def u_unpivot(spark: SparkSession, sf: str) -> DataFrame:
    return recon.unpivot_kpis(aggregates(spark, sf)[0], GRAIN, KPIS)


@query(f"WITH {RECON} SELECT return_flag, line_status, ship_month, kpis, CAST(source_value AS DECIMAL(28,4)) AS source_value, CAST(target_value AS DECIMAL(28,4)) AS target_value FROM base")
def j_recon(spark: SparkSession, sf: str) -> DataFrame:
    """Join of unpivoted KPIs, the direct form."""
    source, target = aggregates(spark, sf)
    return recon.recon_join(
        recon.unpivot_kpis(source, GRAIN, KPIS), recon.unpivot_kpis(target, GRAIN, KPIS), GRAIN
    )


@query(
    f"""
WITH {RECON} SELECT return_flag, line_status, ship_month, kpis, CAST(source_value AS DECIMAL(28,4)) AS source_value,
       CAST(target_value AS DECIMAL(28,4)) AS target_value, CAST(target_value - source_value AS DECIMAL(28,4)) AS delta,
       CASE WHEN target_value <> 0 THEN CAST((CAST(target_value - source_value AS DOUBLE) / CAST(target_value AS DOUBLE)) * 100 AS DECIMAL(38,2)) END AS delta_pct
FROM base
"""
)
def j_delta(spark: SparkSession, sf: str) -> DataFrame:
    source, target = aggregates(spark, sf)
    return recon.delta_at_grain(source, target, GRAIN, KPIS, recon.VALUE)


FULL = """
full_out AS (
  SELECT *, CASE WHEN target_value <> 0 THEN (CAST(target_value - source_value AS DOUBLE) / CAST(target_value AS DOUBLE)) * 100 END AS pct,
         (SELECT max(loaded_at) FROM src) AS sr, (SELECT max(loaded_at) FROM tgt) AS tr FROM base)
"""


@query(
    f"""
WITH {RECON}, {FULL}
SELECT 'return_flag' AS key_col1, return_flag AS key_col1_value, 'line_status' AS key_col2, line_status AS key_col2_value,
       'ship_month' AS key_col3, ship_month AS key_col3_value, 'line_summary' AS target_table, 'line_fact' AS source_table, kpis,
       CAST(source_value AS DECIMAL(28,4)) AS source_value, CAST(target_value AS DECIMAL(28,4)) AS target_value,
       round(target_value - source_value, 2) AS absolute_diff,
       CASE WHEN target_value = 0 AND source_value = 0 THEN '0%' WHEN target_value = 0 THEN NULL
            ELSE CAST(CAST(pct AS DECIMAL(38,2)) AS VARCHAR) || '%' END AS diff_percentage,
       CASE WHEN target_value = 0 AND source_value = 0 THEN 'MATCH' WHEN abs(COALESCE(pct, 9999)) <= 0.0 THEN 'WITHIN_THRESHOLD' ELSE 'DISCREPANCY' END AS status,
       sr AS source_last_refresh_time, tr AS target_last_refresh_time,
       CASE WHEN sr IS NULL OR tr IS NULL THEN 'Unknown' WHEN tr >= sr THEN 'Yes' ELSE 'No' END AS target_up_to_date_flag,
       TIMESTAMP '2001-08-31 09:00:00' AS reconciliation_time
FROM full_out
"""
)
def r_full(spark: SparkSession, sf: str) -> DataFrame:
    source, target = sides(spark, sf)
    source_agg, target_agg = aggregates(spark, sf)
    return recon.reconcile(
        source_agg,
        target_agg,
        recon.refresh_time(source, "loaded_at", "source_last_refresh_time"),
        recon.refresh_time(target, "loaded_at", "target_last_refresh_time"),
        GRAIN,
        KPIS,
        "line_fact",
        "line_summary",
        as_of=fx.AS_OF_ORDERS,
        kind=recon.VALUE,
    )


@query(
    f"""
WITH {RECON}
SELECT return_flag, line_status, ship_month, kpis,
       CASE WHEN abs(target_value - source_value) <= 0.01 THEN 'PASS' WHEN abs(target_value - source_value) <= abs(target_value) * 0.01 THEN 'WARNING' ELSE 'FAIL' END AS status
FROM base
"""
)
def r_pass_warn_fail(spark: SparkSession, sf: str) -> DataFrame:
    source, target = aggregates(spark, sf)
    rows = recon.recon_wide(source, target, GRAIN, KPIS, recon.VALUE)
    return rows.select(*GRAIN, "kpis", recon.pass_warn_fail().alias("status"))


@query(
    f"""
WITH {RECON},
s AS (SELECT ship_date AS load_date, count(*) AS n FROM src GROUP BY 1),
t AS (SELECT ship_date AS load_date, count(*) AS n FROM tgt GROUP BY 1),
b AS (SELECT load_date, COALESCE(s.n, 0) AS source_rows, COALESCE(t.n, 0) AS target_rows FROM s FULL OUTER JOIN t USING (load_date)),
m AS (SELECT *, median(source_rows) OVER w AS ms, median(target_rows) OVER w AS mt FROM b
      WINDOW w AS (ORDER BY load_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
SELECT load_date, source_rows, target_rows,
       CASE WHEN source_rows = 0 OR target_rows = 0 OR COALESCE(source_rows < ms * 0.5, FALSE) OR COALESCE(target_rows < mt * 0.5, FALSE) THEN 'PARTIAL' ELSE 'FULL' END AS load_state
FROM m
"""
)
def r_partial_days(spark: SparkSession, sf: str) -> DataFrame:
    source, target = sides(spark, sf)
    return recon.partial_days(source, target, "ship_date")


@query(
    f"""
WITH {RECON}, d AS (SELECT return_flag, line_status, kpis, ship_month, target_value - source_value AS v FROM base),
g AS (SELECT return_flag, line_status, kpis, count(*) AS dates, min(v) AS min_residual, max(v) AS max_residual, sum(v) AS total_residual,
             count(*) FILTER (v > 0) AS positive_dates, count(*) FILTER (v < 0) AS negative_dates,
             arg_max(v, ship_month) AS last_residual, arg_min(v, ship_month) AS first_residual FROM d GROUP BY 1, 2, 3)
SELECT return_flag, line_status, kpis, dates, min_residual, max_residual, total_residual, positive_dates, negative_dates, last_residual, first_residual,
       CASE WHEN total_residual > 0 THEN 'TARGET_HIGH' WHEN total_residual < 0 THEN 'TARGET_LOW' ELSE 'NONE' END AS direction,
       positive_dates = 0 OR negative_dates = 0 AS consistent, last_residual - first_residual AS change
FROM g
"""
)
def w_residual(spark: SparkSession, sf: str) -> DataFrame:
    source, target = aggregates(spark, sf)
    deltas = recon.delta_at_grain(source, target, GRAIN, KPIS, recon.VALUE)
    return recon.residual_trend(deltas, ["return_flag", "line_status", "kpis"], "ship_month")


@query(
    """
SELECT count(*) AS total_rows, count(*) FILTER (a <> b) AS mismatch_rows, max(abs(a - b)) AS max_abs_diff, sum(a) AS sum_a, sum(b) AS sum_b
FROM (SELECT CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS a,
             CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,2)) AS DECIMAL(24,4)) AS b FROM lineitem)
"""
)
def u_formula_ab(spark: SparkSession, sf: str) -> DataFrame:
    """A revenue formula at full scale against the same one rounded to cents per line."""
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    a = (price * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))).cast("decimal(24,4)")
    b = a.cast("decimal(18,2)").cast("decimal(24,4)")
    return recon.compare_formulas(fx.table(spark, sf, "lineitem"), a, b)


FINE_SQL = """
SELECT l_shipmode AS ship_mode, 'rate' AS kpis, CAST(sum(l_discount) / 10000 AS DECIMAL(38,6)) AS source_value,
       CAST(sum(l_tax) / 10000 AS DECIMAL(38,6)) AS target_value,
       CAST((sum(l_tax) - sum(l_discount)) / 10000 AS DECIMAL(38,6)) AS delta
FROM (SELECT l_returnflag || l_linestatus AS l_shipmode, CAST(l_discount AS DECIMAL(20,2)) AS l_discount,
      CAST(l_tax AS DECIMAL(20,2)) AS l_tax FROM lineitem) GROUP BY 1
"""


@query(FINE_SQL)
def j_delta_fine(spark: SparkSession, sf: str) -> DataFrame:
    """KPIs far below a cent: nothing is rounded away."""
    line = fx.table(spark, sf, "lineitem").withColumn("ship_mode", F.concat("l_returnflag", "l_linestatus"))

    def rate(col: str) -> DataFrame:
        total = F.sum(F.col(col).cast("decimal(20,2)")) * F.lit("0.0001").cast("decimal(5,4)")
        return line.groupBy("ship_mode").agg(total.cast("decimal(30,6)").alias("rate"))

    fine = recon.delta_at_grain(rate("l_discount"), rate("l_tax"), ["ship_mode"], ["rate"])
    return fine.drop("delta_pct")
