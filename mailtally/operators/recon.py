"""Source-to-target reconciliation at a grain of up to three columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from mailtally.operators.latest import with_position

# --- fixed values: status texts, the stand-in for division by zero, output padding ---
MATCH, WITHIN, DISCREPANCY = "MATCH", "WITHIN_THRESHOLD", "DISCREPANCY"
PASS, WARNING, FAIL = "PASS", "WARNING", "FAIL"
NO_TARGET_PERCENT = 9999
MAX_GRAIN = 3
NO_KEY = "NA"
PASS_ABSOLUTE, WARNING_PERCENT = 0.01, 1.0
# --- end of fixed values ---

VALUE = "decimal(28,4)"  # a kind for callers that want a fixed one


def value_kind(source: DataFrame, target: DataFrame, kpis: Sequence[str]) -> str:
    """One kind that holds the KPIs of both sides without rounding: the finest decimal, or
    double if a KPI is a floating-point number."""
    kinds = [df.schema[k].dataType for df in (source, target) for k in kpis]
    if any(isinstance(t, (T.FloatType, T.DoubleType, T.StringType)) for t in kinds):
        return "double"
    return f"decimal(38,{max((getattr(t, 'scale', 0) for t in kinds), default=0)})"


def agg_at_grain(df: DataFrame, grain: Sequence[str], kpis: Mapping[str, Column]) -> DataFrame:
    """KPIs per grain; partial sums are combined before the shuffle."""
    return df.groupBy(*grain).agg(*[c.alias(name) for name, c in kpis.items()])


def refresh_time(df: DataFrame, col: str, out: str) -> DataFrame:
    """Newest load time. One row, under the same filters as the aggregate."""
    return df.agg(F.max(col).alias(out))


def unpivot_kpis(df: DataFrame, grain: Sequence[str], kpis: Sequence[str], kind: str = VALUE) -> DataFrame:
    """Grain columns plus ``kpis`` and ``value``, from one scan."""
    typed = df.select(*grain, *[F.col(k).cast(kind).alias(k) for k in kpis])
    return typed.unpivot(list(grain), list(kpis), "kpis", "value")


def check_inputs(
    source: DataFrame, target: DataFrame, source_refresh: DataFrame, target_refresh: DataFrame,
    grain: Sequence[str], kpis: Sequence[str],
) -> None:
    """Refuse incomplete inputs before anything runs."""
    frames = {
        "source_agg": source,
        "target_agg": target,
        "source_refresh": source_refresh,
        "target_refresh": target_refresh,
    }
    absent = [name for name, df in frames.items() if df is None]
    if absent:
        raise ValueError(f"missing inputs: {', '.join(absent)}")
    if not grain or len(grain) > MAX_GRAIN:
        raise ValueError(f"the grain needs 1 to {MAX_GRAIN} columns, got {len(grain)}")
    if not kpis:
        raise ValueError("no KPIs given")
    for name in ("source_agg", "target_agg"):
        lacking = [c for c in [*grain, *kpis] if c not in frames[name].columns]
        if lacking:
            raise ValueError(f"{name} lacks {', '.join(lacking)}")
    for name in ("source_refresh", "target_refresh"):
        if len(frames[name].columns) != 1:
            raise ValueError(f"{name} must have one column")


def _full_join(source: DataFrame, target: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Null-safe full outer join: keys once, values as ``source_*`` and ``target_*``."""
    s = source.select(*[F.col(k).alias(f"_s_{k}") for k in keys],
                      *[F.col(v).alias(f"source_{v}") for v in values], F.lit(True).alias("_s"))
    t = target.select(*[F.col(k).alias(f"_t_{k}") for k in keys],
                      *[F.col(v).alias(f"target_{v}") for v in values])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"_s_{k}").eqNullSafe(F.col(f"_t_{k}"))
    key = [
        F.when(F.col("_s").isNotNull(), F.col(f"_s_{k}")).otherwise(F.col(f"_t_{k}")).alias(k)
        for k in keys
    ]
    sides = [c for v in values for c in (f"source_{v}", f"target_{v}")]
    return s.join(t, same, "full").select(*key, *sides)


def recon_join(source_kpis: DataFrame, target_kpis: DataFrame, grain: Sequence[str]) -> DataFrame:
    """Full join of unpivoted KPIs; a NULL grain value meets NULL, a missing side is 0."""
    joined = _full_join(source_kpis, target_kpis, [*grain, "kpis"], ["value"])
    zero = F.lit(0).cast(source_kpis.schema["value"].dataType)
    return joined.select(
        *grain,
        "kpis",
        F.coalesce("source_value", zero).alias("source_value"),
        F.coalesce("target_value", zero).alias("target_value"),
    )


def recon_wide(
    source: DataFrame, target: DataFrame, grain: Sequence[str], kpis: Sequence[str],
    kind: str | None = None,
) -> DataFrame:
    """The same rows as unpivoting both sides first, with a join that is KPI-times smaller.

    Both aggregates have one row per grain value, so they are joined wide and unpivoted
    after the join: the shuffle carries each grain value once, not once per KPI. Values are of
    ``kind``, by default one that does not round them.
    """
    kind = kind or value_kind(source, target, kpis)
    left, right = _typed(source, grain, kpis, kind), _typed(target, grain, kpis, kind)
    wide = _full_join(left, right, grain, kpis)
    zero = F.lit(0).cast(kind)
    rows = F.array(
        *[
            F.struct(
                F.lit(k).alias("kpis"),
                F.coalesce(F.col(f"source_{k}"), zero).alias("source_value"),
                F.coalesce(F.col(f"target_{k}"), zero).alias("target_value"),
            )
            for k in kpis
        ]
    )
    return wide.select(*grain, F.inline(rows))


def _typed(df: DataFrame, grain: Sequence[str], kpis: Sequence[str], kind: str) -> DataFrame:
    return df.select(*grain, *[F.col(k).cast(kind).alias(k) for k in kpis])


# --- measures -----------------------------------------------------------------------------


def absolute_diff() -> Column:
    return F.round(F.col("target_value") - F.col("source_value"), 2)


def percent() -> Column:
    """Difference in percent of the target; null when the target is 0."""
    diff = (F.col("target_value") - F.col("source_value")).cast("double")
    return F.when(F.col("target_value") != 0, diff / F.col("target_value").cast("double") * 100)


def _both_zero() -> Column:
    return (F.col("target_value") == 0) & (F.col("source_value") == 0)


def diff_percentage() -> Column:
    """Percent as text: ``0%`` when both are 0, null when only the target is."""
    text = F.concat(percent().cast("decimal(38,2)").cast("string"), F.lit("%"))
    return F.when(_both_zero(), F.lit("0%")).otherwise(text)


def status(threshold: float = 0.0) -> Column:
    within = F.abs(F.coalesce(percent(), F.lit(float(NO_TARGET_PERCENT)))) <= threshold
    return (
        F.when(_both_zero(), F.lit(MATCH))
        .when(within, F.lit(WITHIN))
        .otherwise(F.lit(DISCREPANCY))
    )


def pass_warn_fail(absolute: float = PASS_ABSOLUTE, pct: float = WARNING_PERCENT) -> Column:
    """PASS up to an absolute difference, WARNING up to a percent of the target, else FAIL."""
    gap = F.abs(F.col("target_value") - F.col("source_value")).cast("double")
    bound = F.abs(F.col("target_value")).cast("double") * (pct / 100)
    return (
        F.when(gap <= absolute, F.lit(PASS)).when(gap <= bound, F.lit(WARNING)).otherwise(F.lit(FAIL))
    )


def up_to_date(source_refresh: Column, target_refresh: Column) -> Column:
    return (
        F.when(source_refresh.isNull() | target_refresh.isNull(), F.lit("Unknown"))
        .when(target_refresh >= source_refresh, F.lit("Yes"))
        .otherwise(F.lit("No"))
    )


def reconcile(
    source: DataFrame,
    target: DataFrame,
    source_refresh: DataFrame,
    target_refresh: DataFrame,
    grain: Sequence[str],
    kpis: Sequence[str],
    source_table: str,
    target_table: str,
    threshold: float = 0.0,
    tz: str = "Asia/Tokyo",
    as_of: str | None = None,
    kind: str | None = None,
) -> DataFrame:
    """The fixed 18-column reconciliation output.

    The refresh times are scalar subqueries, so there is no join with the one-row frames.
    """
    check_inputs(source, target, source_refresh, target_refresh, grain, kpis)
    instant = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    base = recon_wide(source, target, grain, kpis, kind).select(
        "*",
        source_refresh.scalar().alias("source_last_refresh_time"),
        target_refresh.scalar().alias("target_last_refresh_time"),
    )
    keys: list[Column] = []
    for i in range(MAX_GRAIN):
        has = i < len(grain)
        value = F.col(grain[i]).cast("string") if has else F.lit(None).cast("string")
        keys.append(F.lit(grain[i] if has else NO_KEY).alias(f"key_col{i + 1}"))
        keys.append(value.alias(f"key_col{i + 1}_value"))
    return base.select(
        *keys,
        F.lit(target_table).alias("target_table"),
        F.lit(source_table).alias("source_table"),
        "kpis",
        "source_value",
        "target_value",
        absolute_diff().alias("absolute_diff"),
        diff_percentage().alias("diff_percentage"),
        status(threshold).alias("status"),
        "source_last_refresh_time",
        "target_last_refresh_time",
        up_to_date(
            F.col("source_last_refresh_time"), F.col("target_last_refresh_time")
        ).alias("target_up_to_date_flag"),
        F.from_utc_timestamp(instant, tz).alias("reconciliation_time"),
    )


def presentation_order(recon: DataFrame) -> DataFrame:
    """Key descending, KPI ascending; for display only."""
    return recon.orderBy(F.col("key_col1_value").desc(), F.col("kpis").asc())


def presentation_positions(recon: DataFrame) -> DataFrame:
    """The rows of :func:`presentation_order` with their ``position``; the other keys break ties."""
    others = [F.col(f"key_col{i}_value").asc() for i in (2, 3)]
    return with_position(recon, [F.col("key_col1_value").desc(), F.col("kpis").asc(), *others])


def delta_at_grain(
    source: DataFrame, target: DataFrame, grain: Sequence[str], kpis: Sequence[str],
    kind: str | None = None,
) -> DataFrame:
    """Numeric deltas for a validation table: values, delta, delta percent."""
    kind = kind or value_kind(source, target, kpis)
    return recon_wide(source, target, grain, kpis, kind).select(
        *grain,
        "kpis",
        "source_value",
        "target_value",
        (F.col("target_value") - F.col("source_value")).cast(kind).alias("delta"),
        percent().cast("decimal(38,2)").alias("delta_pct"),
    )


def compare_formulas(df: DataFrame, a: Column, b: Column, tolerance: float = 0.0) -> DataFrame:
    """Two formulas on the same rows: mismatches and the largest gap. One row."""
    gap = F.abs(a - b)
    one_null = a.isNull() != b.isNull()
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.coalesce(gap > tolerance, one_null)).alias("mismatch_rows"),
        F.max(gap).alias("max_abs_diff"),
        F.sum(a).alias("sum_a"),
        F.sum(b).alias("sum_b"),
    )


def _median(ordered: Column) -> Column:
    """Median of a short sorted array; null for an empty one."""
    n = F.size(ordered)
    low, high = F.floor((n - 1) / 2).cast("int"), F.floor(n / 2).cast("int")
    return F.when(n > 0, (F.get(ordered, low) + F.get(ordered, high)) / 2)


def partial_days(
    source: DataFrame, target: DataFrame, day: str, share: float = 0.5, trailing: int = 7
) -> DataFrame:
    """Fully loaded or partial, per date: rows on both sides against the days before.

    A day is partial when a side has fewer than ``share`` of the median of its trailing
    days. Counts per date are aggregated first, so the window sees one row per date.
    """

    def counts(df: DataFrame) -> DataFrame:
        return df.groupBy(F.to_date(day).alias("load_date")).agg(F.count(F.lit(1)).alias("rows"))

    both = _full_join(counts(source), counts(target), ["load_date"], ["rows"]).select(
        "load_date",
        F.coalesce("source_rows", F.lit(0)).alias("source_rows"),
        F.coalesce("target_rows", F.lit(0)).alias("target_rows"),
    )
    # One row per calendar date by now, also if the column holds times: the window over all
    # of them is bounded by the calendar (thirty years are 11,000 rows), not by the data.
    before = Window.orderBy("load_date").rowsBetween(-trailing, -1)

    def usual(rows: str) -> Column:
        return _median(F.sort_array(F.collect_list(rows).over(before)))

    judged = both.select(
        "*", usual("source_rows").alias("_s"), usual("target_rows").alias("_t")
    )

    def low(rows: str, median: str) -> Column:
        return F.coalesce(F.col(rows) < F.col(median) * share, F.lit(False)) | (F.col(rows) == 0)

    return judged.select(
        "load_date",
        "source_rows",
        "target_rows",
        F.when(low("source_rows", "_s") | low("target_rows", "_t"), F.lit("PARTIAL"))
        .otherwise(F.lit("FULL"))
        .alias("load_state"),
    )


def residual_trend(deltas: DataFrame, by: Sequence[str], day: str, delta: str = "delta") -> DataFrame:
    """Direction, size, bounds and consistency of a residual over its dates."""
    value = F.col(delta)
    summary = deltas.groupBy(*by).agg(
        F.count(F.lit(1)).alias("dates"),
        F.min(value).alias("min_residual"),
        F.max(value).alias("max_residual"),
        F.sum(value).alias("total_residual"),
        F.count_if(value > 0).alias("positive_dates"),
        F.count_if(value < 0).alias("negative_dates"),
        F.max_by(value, F.col(day)).alias("last_residual"),
        F.min_by(value, F.col(day)).alias("first_residual"),
    )
    one_sided = (F.col("positive_dates") == 0) | (F.col("negative_dates") == 0)
    return summary.select(
        "*",
        F.when(F.col("total_residual") > 0, F.lit("TARGET_HIGH"))
        .when(F.col("total_residual") < 0, F.lit("TARGET_LOW"))
        .otherwise(F.lit("NONE"))
        .alias("direction"),
        one_sided.alias("consistent"),
        (F.col("last_residual") - F.col("first_residual")).alias("change"),
    )
