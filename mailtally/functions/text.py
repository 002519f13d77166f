"""Text search over message lines: width folding, codes and amounts near labels."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

from mailtally.functions.bind import each, keep_if, let, only, over, present, quote, variable
from mailtally.functions.money import strict_sql, strip_sql
from mailtally.functions.regex import java_pattern

# --- fixed values: default label patterns and number shapes of the message formats ---
DEFAULT_CODE_REGEX = r"請求先コード|コード|Customer\s*ID|Account\s*No|Invoice\s*No"
DEFAULT_AMOUNT_REGEX = r"支払額|振込金額|入金額|支払予定|Payment\s*Amount|Total\s*Due"
CODE_TOKEN = r"[A-Za-z0-9\-_]{3,25}"
LINE_AMOUNT = r"[$€£¥￥₹₩△▲\-]?\s*[\d,]{3,}(?:\.\d+)?|\b\d+(?:\.\d+)?\s*円"
COLON_AMOUNT = r"[:：]\s*([$€£¥￥₹₩△▲\-]?\s*[\d,]+(?:\.\d+)?|\d+\s*円)"
SYMBOL_AMOUNT = r"[$€£¥￥₹₩△▲]\s*[\d,]{3,}(?:\.\d+)?"
AFTER_CODE_LABEL = r"\s*[:：\s]*"
NOT_AN_AMOUNT_LINE = r"コード|日付|番号|ID|No|締日|明細|様"
# --- end of fixed values ---

# Wider forms used with strict_sign=True: any run of signs and symbols, optional parentheses.
_SIGNED_LINE_AMOUNT = (
    r"\(?[$€£¥￥₹₩△▲\-]*\s*[\d,]{3,}(?:\.\d+)?\)?|[△▲\-]?\b\d+(?:\.\d+)?\s*円"
)
_SIGNED_SYMBOL_AMOUNT = (
    r"\(?[△▲\-]*[$€£¥￥₹₩△▲][△▲\-]*\s*[\d,]{3,}(?:\.\d+)?\)?"
)

# A whole amount with its signs, symbols and unit, for labels without amounts.
_AMOUNT_TOKEN = r"[$€£¥￥₹₩△▲\-(]*\s*[\d,]{3,}(?:\.\d+)?\s*[円)]?|\b\d+(?:\.\d+)?\s*円"

Hit = Callable[[str, str], str]

_FULL_WIDTH = "０１２３４５６７８９，．（）－：　"
_ASCII_WIDTH = "0123456789,.()-: "


def _exact(pattern: str) -> str:
    return quote(java_pattern(pattern, ignore_case=False))


def _folded(pattern: str) -> str:
    return quote(java_pattern(pattern))


def lines_of(text: Column | str) -> Column:
    """Lines of a normalised text (already stripped, no blank line)."""
    return F.split(text, "\n")


def fold_width(col: Column | str) -> Column:
    """Full-width digits and number punctuation to ASCII, JVM side."""
    return F.translate(col, _FULL_WIDTH, _ASCII_WIDTH)


@F.arrow_udf(T.StringType())
def normalize_width(values: pa.Array) -> pa.Array:
    """NFKC: full-width letters, digits and signs to ASCII, half-width kana to full width."""
    return pa.array(
        [None if v is None else unicodedata.normalize("NFKC", v) for v in values.to_pylist()],
        pa.string(),
    )


def prefix_sql(code: str, prefix: str) -> str:
    """Put a prefix (SQL) before a code that does not have it yet."""
    if prefix == "''":
        return code
    return f"IF({code} = '' OR startswith({code}, {prefix}), {code}, concat({prefix}, {code}))"


def prefix_code(code: Column | str, prefix: str | None) -> Column:
    return over(code, lambda x: prefix_sql(x, quote(prefix or "")))


def rlike(value: str, pattern: str) -> str:
    """Search for a literal pattern, compiled once per task."""
    return f"{value} RLIKE {pattern}"


def near_code_pattern(pattern: str, whole: bool = False) -> str:
    """Java pattern of a label followed by a code.

    The format takes the first 25 characters of a longer code. With ``whole`` a code that is
    longer is none, so that two codes with one beginning never become one.
    """
    token = rf"({CODE_TOKEN}+)(?![A-Za-z0-9\-_])" if whole else f"({CODE_TOKEN})"
    return java_pattern(f"(?:{pattern}){AFTER_CODE_LABEL}{token}")


def code_sql(text: str, lines: str, near: str, label: str, hit: Hit = rlike) -> str:
    """Code after a label anywhere in the text, else the whole line below a label line.

    ``near`` and ``label`` are SQL of Java patterns, ``hit`` is the SQL of a search.
    """
    direct = keep_if(f"regexp_extract({text}, {near}, 1)", lambda c: f"{c} <> ''")
    line, i = variable("line"), variable("i")
    below = (
        f"transform({lines}, ({line}, {i}) -> CASE WHEN {hit(line, label)} "
        f"AND get({lines}, {i} + 1) RLIKE {_exact(f'^{CODE_TOKEN}$')} THEN get({lines}, {i} + 1) END)"
    )
    return f"coalesce({direct}, get({present(below)}, 0))"


def extract_code(
    text: str, lines: str, pattern: str = DEFAULT_CODE_REGEX, whole: bool = False
) -> Column:
    """Code near a label; ``text`` and ``lines`` are column names, ``whole`` as above."""
    near = quote(near_code_pattern(pattern, whole))
    return F.expr(code_sql(text, lines, near, _folded(pattern)))


def amount_sql(lines: str, label: str, strict_sign: bool = False, hit: Hit = rlike) -> str:
    """``struct<amount, label>`` of the labelled amount, or null.

    Label lines are tried in order: number on the line, number after a colon, then a
    next line that is an amount as a whole. Without any, the first number that carries
    a currency symbol counts. The label is the whole line.
    """
    on_line = _exact(_SIGNED_LINE_AMOUNT if strict_sign else LINE_AMOUNT)
    symbol = _exact(_SIGNED_SYMBOL_AMOUNT if strict_sign else SYMBOL_AMOUNT)
    line, i = variable("line"), variable("i")
    candidates = (
        f"transform({lines}, ({line}, {i}) -> CASE WHEN {hit(line, label)} "
        f"THEN named_struct('label', {line}, 'below', get({lines}, {i} + 1)) END)"
    )

    def number(found: str) -> str:
        return let(strip_sql(found), strict_sql)

    def value(x: str) -> str:
        # coalesce stops at the first amount, so the later searches seldom run.
        tries = [
            number(f"regexp_extract({x}.label, {on_line}, 0)"),
            number(f"regexp_extract({x}.label, {_exact(COLON_AMOUNT)}, 1)"),
            f"IF({x}.below RLIKE {_folded(NOT_AN_AMOUNT_LINE)}, NULL, {strict_sql(f'{x}.below')})",
        ]
        return f"named_struct('amount', coalesce({', '.join(tries)}), 'label', {x}.label)"

    def symbol_value(x: str) -> str:
        found = number(f"regexp_extract({x}, {symbol}, 0)")
        return f"named_struct('amount', {found}, 'label', {x})"

    def first_amount(array: str) -> str:
        return f"get({only(array, lambda x: f'{x}.amount IS NOT NULL')}, 0)"

    by_label = first_amount(each(present(candidates), value))
    by_symbol = first_amount(each(only(lines, lambda x: f"{x} RLIKE {symbol}"), symbol_value))
    return f"coalesce({by_label}, {by_symbol})"


def extract_amount(
    lines: str, pattern: str = DEFAULT_AMOUNT_REGEX, strict_sign: bool = False
) -> Column:
    """Amount near a label as ``struct<amount, label>``; ``lines`` is a column name."""
    return F.expr(amount_sql(lines, _folded(pattern), strict_sign))


def short_label_sql(label: str) -> str:
    """A label line without its amounts, so that a corrected amount keeps the same key."""
    return strip_sql(f"regexp_replace({label}, {_exact(_AMOUNT_TOKEN)}, '')")


def normalized_label(label: Column | str) -> Column:
    return over(label, short_label_sql)
