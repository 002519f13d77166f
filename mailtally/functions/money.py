"""Currency text to double, as native expressions."""

from __future__ import annotations

from pyspark.sql import Column

from mailtally.functions.bind import over, quote

# --- fixed values: what counts as empty, which characters an amount may hold ---
STRICT_NULLS = ["", "-", "―", "ー", "/", "#DIV/0!", "#N/A", "#VALUE!", "nan", "None", "null"]
LENIENT_NULLS = ["", "-", "―", "ー", "#DIV/0!", "#N/A", "nan"]
STRICT_SHAPE = r"(?diU)^(?:[0-9,\.\s$€£¥￥₹₩△▲\(\)\-円]|JPY|USD|EUR|GBP)*$"
LENIENT_REMOVED = r"(?U)[¥￥\\,△▲\(\)\s円-]"
# --- end of fixed values ---

_BLANK = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
_NUMBER = r"^[+]?(?:\d+(?:_\d+)*\.?(?:\d+(?:_\d+)*)?|\.\d+(?:_\d+)*)(?:[eE]\+?\d+(?:_\d+)*)?$"
_INFINITY = r"^(?i)\+?inf(?:inity)?$"


def strip_sql(x: str) -> str:
    """Trim every Unicode blank at both ends (``trim`` keeps U+3000 and NBSP)."""
    return f"regexp_replace({x}, {quote(_BLANK)}, '')"


def _negative_sql(x: str) -> str:
    """Minus sign, accounting triangle, or a text fully in parentheses."""
    wrapped = f"(startswith({x}, '(') AND endswith({x}, ')'))"
    return f"({x} RLIKE '[-△▲]' OR {wrapped})"


def _among(x: str, values: list[str]) -> str:
    return f"{x} IN ({', '.join(map(quote, values))})"


def strict_sql(x: str) -> str:
    """Strict cleaning of a text that has no outer blanks."""
    number = f"try_cast(regexp_replace({x}, '[^0-9.]', '') AS DOUBLE)"
    return (
        f"CASE WHEN NOT {_among(x, STRICT_NULLS)} AND {x} RLIKE {quote(STRICT_SHAPE)} "
        f"THEN IF({_negative_sql(x)}, -{number}, {number}) END"
    )


def yen_sql(x: str) -> str:
    """Lenient yen cleaning of a text that has no outer blanks."""
    digits = (
        f"translate(regexp_replace({x}, {quote(LENIENT_REMOVED)}, ''), '０１２３４５６７８９', '0123456789')"
    )
    number = (
        f"CASE WHEN {digits} RLIKE {quote(_NUMBER)} THEN try_cast(replace({digits}, '_', '') AS DOUBLE) "
        f"WHEN {digits} RLIKE {quote(_INFINITY)} THEN double('inf') END"
    )
    return (
        f"CASE WHEN NOT {_among(x, LENIENT_NULLS)} "
        f"THEN IF({_negative_sql(x)}, -({number}), {number}) END"
    )


def strip(col: Column | str) -> Column:
    return over(col, strip_sql)


def clean_amount(col: Column | str) -> Column:
    """International amount text to double; anything that is not an amount is null."""
    return over(col, lambda x: strict_sql(strip_sql(x)))


def clean_number(col: Column | str) -> Column:
    """The same for a column that is already numeric: NaN is null."""
    return over(col, lambda x: f"CASE WHEN NOT isnan({x}) THEN CAST({x} AS DOUBLE) END")


def clean_amount_yen(col: Column | str) -> Column:
    """Yen cell text to double: backslash counts as a yen sign, other symbols are refused."""
    return over(col, lambda x: yen_sql(strip_sql(x)))


