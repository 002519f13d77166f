"""SQL-text building blocks and evaluate-once bindings.

The extraction rules become large nested lambdas. Written as SQL text they are one parsed
expression per rule; built call by call they are thousands of round trips to the JVM.
Catalyst shares repeated subexpressions only outside of lambdas, and the filters it infers
for generators repeat their input, so values used more than once are bound to a variable.
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

_numbers = itertools.count()


def quote(value: str | None) -> str:
    """A SQL string literal."""
    if value is None:
        return "CAST(NULL AS STRING)"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n") + "'"


def constant(value: object, kind: str) -> str:
    """SQL of a nested constant. As JSON it is one literal, which the optimizer reads once; large
    constants written out are slow to parse."""
    return f"from_json({quote(json.dumps({'v': value}, ensure_ascii=False))}, 'v {kind}').v"


def variable(stem: str = "v") -> str:
    """A lambda variable name that no enclosing lambda uses."""
    return f"{stem}_{next(_numbers)}"


def let(value: str, body: Callable[[str], str]) -> str:
    """SQL of ``body(value)`` with ``value`` evaluated once."""
    x = variable()
    return f"get(transform(array({value}), {x} -> {body(x)}), 0)"


def keep_if(value: str, test: Callable[[str], str]) -> str:
    """SQL of ``value`` if the test holds, else null, with ``value`` evaluated once."""
    x = variable()
    return f"get(filter(array({value}), {x} -> {test(x)}), 0)"


def each(array: str, body: Callable[[str], str]) -> str:
    x = variable()
    return f"transform({array}, {x} -> {body(x)})"


def only(array: str, test: Callable[[str], str]) -> str:
    x = variable()
    return f"filter({array}, {x} -> {test(x)})"


def present(array: str) -> str:
    return only(array, lambda x: f"{x} IS NOT NULL")


def last(array: str) -> str:
    return f"try_element_at({array}, -1)"


def bind(value: Column, body: Callable[[str], str]) -> Column:
    """Column of SQL ``body`` over a Column, with the Column evaluated once."""
    x = variable()
    return F.get(F.call_function("transform", F.array(value), F.expr(f"{x} -> {body(x)}")), F.lit(0))


def over(col: Column | str, body: Callable[[str], str]) -> Column:
    """SQL ``body`` over a column name (compiled as it stands) or over any Column (bound)."""
    return F.expr(body(col)) if isinstance(col, str) else bind(col, body)


def non_empty(rows: Column) -> Column:
    """An array if it has items, else null, evaluated once."""
    return F.get(F.filter(F.array(rows), lambda x: F.size(x) > 0), F.lit(0))


def inline_rows(df: DataFrame, rows: Column, first_field: str, *keep: Column | str) -> DataFrame:
    """Explode an array of structs next to the kept columns; no rows for null or empty.

    The outer form plus a filter on a field that is never null: for the inner form the
    optimizer adds a filter on the array below the generator, which computes an expensive
    array once more for the test and once more for the rows.
    """
    return df.select(F.inline_outer(rows), *keep).filter(F.col(first_field).isNotNull())
