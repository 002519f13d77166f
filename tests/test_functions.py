"""Amounts, codes, labels, patterns and JSON answers: golden values."""

import math
import re

import pytest
from pyspark.sql import functions as F

from mailtally.functions import money, regex, responses, text

# Amounts are put together from their parts: sign or symbol, digits in groups, decimals.
DIGITS = {"7": 7.0, "4,200": 4200.0, "61,000,009": 61000009.0, "83.25": 83.25}
PLAIN = {f"{mark}{d}": v for d, v in DIGITS.items() for mark in ("", "$", "£", "€", "¥", "￥", "　¥")}
STRICT = {
    **PLAIN,
    **{f"{mark}{d}": -v for d, v in DIGITS.items() for mark in ("△", "▲", "¥-", "$-")},
    **{f"({d})": -v for d, v in DIGITS.items()},
    **{f"{d}円": v for d, v in DIGITS.items()},
    **{f"{word} {d}": v for d, v in DIGITS.items() for word in ("JPY", "usd")},
    # no amount at all, or no single one
    **dict.fromkeys(["-", "", "  ", ".", "#VALUE!", "n.n", "word", "word 12", "6.5.4", "５", "none"]),
    # traps of the format that the cleaner keeps
    "40-7": -407.0, "8,1": 81.0, "1999-12-05": -19991205.0, None: None,
}

YEN = {
    **{f"{mark}{d}": v for d, v in DIGITS.items() for mark in ("", "+", "¥", "￥", "\\")},
    **{f"{mark}{d}": -v for d, v in DIGITS.items() for mark in ("△", "▲", "¥-", "-¥")},
    **{f"({d})": -v for d, v in DIGITS.items()},
    **dict.fromkeys(["", "-", "#VALUE!", "#REF!", "$4", "9 apples", "_4", "4__0", "4d", "0b1"]),
    "４２": 42.0, "3e2": 300.0, "2_500": 2500.0, "inf": math.inf, None: None,
}


@pytest.mark.parametrize("by_name", [True, False])
@pytest.mark.parametrize("clean, cases", [("clean_amount", STRICT), ("clean_amount_yen", YEN)])
def test_amounts(spark, clean, cases, by_name):
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    fn = getattr(money, clean)
    got = {r.v: r.a for r in df.select("v", fn("v" if by_name else F.col("v")).alias("a")).collect()}
    assert got == cases


def test_numeric_input(spark):
    df = spark.createDataFrame([(1.5,), (float("nan"),), (None,)], "v double")
    assert [r.a for r in df.select(money.clean_number("v").alias("a")).collect()] == [1.5, None, None]


def test_codes_longer_than_the_format(spark):
    long = "X" * 31
    body = f"Ref: {long}"
    assert _code(spark, body, "Ref") == long[:25]
    df = spark.createDataFrame([(body,), ("Ref: AB-1",)], "text string").withColumn("lines", text.lines_of("text"))
    got = [r.c for r in df.select(text.extract_code("text", "lines", "Ref", whole=True).alias("c")).collect()]
    assert got == [None, "AB-1"]


def _code(spark, body, pattern=text.DEFAULT_CODE_REGEX):
    df = spark.createDataFrame([(body,)], "text string").withColumn("lines", text.lines_of("text"))
    return df.select(text.extract_code("text", "lines", pattern).alias("c")).first().c


def _amount(spark, body, pattern=text.DEFAULT_AMOUNT_REGEX, strict_sign=False):
    df = spark.createDataFrame([(body,)], "text string").withColumn("lines", text.lines_of("text"))
    due = df.select(text.extract_amount("lines", pattern, strict_sign).alias("d")).first().d
    return due and (due.amount, due.label)


def test_codes(spark):
    assert _code(spark, "請求先コード： 7910890000\nx") == "7910890000"
    assert _code(spark, "CUSTOMER  ID:\n  AB-12_x") == "AB-12_x"
    assert _code(spark, "コード 番号\n12345") == "12345"  # exact code on the next line
    assert _code(spark, "コード 番号\n12345 x") is None
    assert _code(spark, "コード: " + "9" * 30) == "9" * 25
    assert _code(spark, "nothing here") is None


def test_amount_on_line_colon_next_line_and_fallback(spark):
    assert _amount(spark, "支払額 ¥1,234 (x)") == (1234.0, "支払額 ¥1,234 (x)")
    assert _amount(spark, "支払額: ¥0") == (0.0, "支払額: ¥0")
    assert _amount(spark, "支払額\n¥99") == (99.0, "支払額")
    assert _amount(spark, "支払額\nID 1234") is None
    assert _amount(spark, "支払額 なし\n支払額 5,000円") == (5000.0, "支払額 5,000円")
    assert _amount(spark, "other ¥7,000 line") == (7000.0, "other ¥7,000 line")
    assert _amount(spark, "other 7,000 line") is None


def test_known_traps_of_the_label_search(spark):
    assert _amount(spark, "2026/3/31 支払額 ¥1,000")[0] == 2026.0
    assert _amount(spark, "支払額 △¥4,200,000")[0] == 4200000.0
    assert _amount(spark, "支払額 △¥4,200,000", strict_sign=True)[0] == -4200000.0
    assert _amount(spark, "支払額 (1,000)")[0] == 1000.0
    assert _amount(spark, "支払額 (1,000)", strict_sign=True)[0] == -1000.0


def test_short_labels(spark):
    labels = {
        "3/31 支払額 ¥1,234": "3/31 支払額", "支払額 ¥-5,000": "支払額", "支払額 1,234円": "支払額",
        "支払額 ▲9,999 済": "支払額 済", "支払額 $1,234.00": "支払額",
    }
    df = spark.createDataFrame([(k,) for k in labels], "v string")
    got = {r.v: r.s for r in df.select("v", text.normalized_label("v").alias("s")).collect()}
    assert got == labels


def test_prefix(spark):
    df = spark.createDataFrame([("1089555",), ("7912",), ("",)], "c string")
    got = [r.p for r in df.select(text.prefix_code("c", "79").alias("p")).collect()]
    assert got == ["791089555", "7912", ""]


@pytest.mark.parametrize(
    "pattern, subject",
    [
        (r"(?P<a_b>\d{4})_(?P<c>\w+)", "x 2026_31W"),
        (r"[[a]b", "[b"),
        (r"[^]x]+", "abc]"),
        (r"a{,2}b", "aab"),
        (r"(?P<q>['\"])x(?P=q)", "say 'x'"),
        (r"end\Z", "the end"),
        (r"[a&&b]+", "&&"),
        (r"\d+円", "１２円"),
    ],
)
def test_patterns_behave_as_in_python(spark, pattern, subject):
    df = spark.createDataFrame([(subject,)], "s string")
    java = regex.java_pattern(pattern)
    row = df.select(F.regexp_extract("s", java, 0).alias("m")).first()
    assert row.m == re.search(pattern, subject, re.IGNORECASE).group(0)


def test_group_numbers():
    assert regex.group_index(r"(x)(?P<year>\d)(?P<week>\d)") == {"year": 2, "week": 3}
    with pytest.raises(re.error):
        regex.java_pattern("(")


def test_json_answers(spark):
    rows = [
        ('Sure!\n{"table_description": "d", "confidence": 0.95}\nbye',),
        ("no json",),
        ("{broken",),
        ('{"confidence": 0.5, "questions_for_steward": ["unit?"]}',),
    ]
    df = responses.gate(responses.with_json(spark.createDataFrame(rows, "response string")))
    got = [(r.description, r.question, r.accepted, r.json_error is None) for r in df.collect()]
    assert got == [
        ("d", None, True, True), ("", None, False, False), ("", None, False, False),
        ("", "unit?", False, True),
    ]


def test_unknown_columns_by_list_and_by_frame(spark):
    answer = '{"column_descriptions": {"a": "x", "ghost": "y"}}'
    df = responses.with_json(spark.createDataFrame([(1, answer)], "k int, response string"))
    known = spark.createDataFrame([("a",)], "column string")
    for columns in (["a"], known):
        assert [tuple(r) for r in responses.unknown_columns(df, "k", columns).collect()] == [(1, "ghost")]
