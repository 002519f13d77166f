"""Master-data lookups and the weekly aggregate on top of them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from mailtally.operators.latest import latest_per_key


def enrich(
    fact: DataFrame, dim: DataFrame, keys: Mapping[str, str], columns: Sequence[str],
    order: Sequence[Column] = (),
) -> DataFrame:
    """Left join of a fact with a dimension on ``{fact column: dimension key}``.

    No broadcast is forced: Spark broadcasts the dimension when its measured size is under
    the session's threshold, and AQE splits hot fact keys of the sort-merge join else.
    With ``order`` the dimension is first reduced to one row per key.
    """
    names = list(keys.values())
    slim = dim.select(*dict.fromkeys([*names, *columns])) if not order else dim
    if order:
        slim = latest_per_key(slim, names, order).select(*dict.fromkeys([*names, *columns]))
    same = F.lit(True)
    for fact_col, dim_col in keys.items():
        same = same & (fact[fact_col] == slim[dim_col])
    return fact.join(slim, same, "left").select(
        *[fact[c] for c in fact.columns], *[slim[c] for c in columns]
    )


def weekly(
    df: DataFrame, keys: Sequence[str], ts: str, kpis: Mapping[str, Column], out: str = "week_start"
) -> DataFrame:
    """One row per key and week, weeks starting on Monday."""
    week = F.to_date(F.date_trunc("week", ts))
    return df.groupBy(*keys, week.alias(out)).agg(*[c.alias(n) for n, c in kpis.items()])


def total_amount(col: str = "payment_amount", kind: str = "decimal(28,2)") -> Column:
    """Exact sum of the amounts that fit the kind; the others are left out, not raised."""
    return F.sum(F.col(col).try_cast(kind)).cast(kind)


def unfit_amounts(col: str = "payment_amount", kind: str = "decimal(28,2)") -> Column:
    """How many amounts are there that do not fit the kind."""
    return F.count_if(F.col(col).isNotNull() & F.col(col).try_cast(kind).isNull())


def intake_summary(records: DataFrame) -> DataFrame:
    """Records, messages and amounts per partner."""
    return records.groupBy("customer_name").agg(
        F.count(F.lit(1)).alias("records"),
        total_amount().alias("total_amount"),
    )
