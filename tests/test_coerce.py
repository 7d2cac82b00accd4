"""Coercion, staging and derived columns on literal rows."""

import datetime
import decimal
import math
import time

import pytest
from pyspark.sql import functions as F

from cohortspark import (
    is_finite,
    is_missing,
    label_of,
    stage,
    to_code,
    to_number,
    value_band,
    years_and_months,
)
from cohortspark.functions.coerce import code_literal
from cohortspark.functions.derive import BANDS, band_rank
from cohortspark.functions.text import SPACE, strip

UNKNOWN = "DESCONOCIDO"


def texts(spark, values):
    # Two partitions, so that the plan runs as generated code, not as constants.
    rows = list(enumerate(values))
    return spark.createDataFrame(rows, "i int, x string").repartition(2)


def column(df, expression):
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


CODES = [
    ("1", "1", "1", "1"),
    ("1.0", "1", "1", "1"),
    (" 2.00 ", "2", "2", "2"),
    ("0", "0", "0", UNKNOWN),
    ("0.0", "0", "0", UNKNOWN),
    ("007", "007", "7", UNKNOWN),
    ("+5", "+5", "5", UNKNOWN),
    ("1e2", "1e2", "100", UNKNOWN),
    ("-0.0", "-0", "0", UNKNOWN),
    ("1.5", "1.5", "1.5", UNKNOWN),
    ("1.", "1.", "1", UNKNOWN),
    ("nan", "nan", None, UNKNOWN),
    ("", None, None, UNKNOWN),
    ("   ", None, None, UNKNOWN),
    (None, None, None, UNKNOWN),
    ("1_000", "1_000", "1000", UNKNOWN),
    ("-12.000", "-12", "-12", UNKNOWN),
    ("9" * 30, "9" * 30, "9" * 30, UNKNOWN),
    ("A1", "A1", "A1", UNKNOWN),
]


def test_codes(spark):
    df = texts(spark, [c[0] for c in CODES])
    x = F.col("x")
    assert column(df, to_code(x)) == [c[1] for c in CODES]
    assert column(df, to_code(x, canonical=True)) == [c[2] for c in CODES]
    assert column(df, to_code(x, valid=[1, "2.0", 3.0, "4"])) == [c[3] for c in CODES]


def test_code_literals():
    values = [1, 2.0, "3.0", "007", "1e2", True, " x ", "", "nan"]
    assert [code_literal(v) for v in values] == ["1", "2", "3", "7", "100", "1", "x", None, None]


NUMBERS = {
    "1": 1.0,
    ".5": 0.5,
    "5.": 5.0,
    "-1e3": -1000.0,
    " 7 ": 7.0,
    "nan": math.nan,
    "NaN": math.nan,
    "inf": math.inf,
    "+Infinity": math.inf,
    "-Inf": -math.inf,
    "1e999": math.inf,
    "": None,
    "abc": None,
    "1,000": None,
    "1_000": None,
    "1 2": None,
    "1d": None,
    "1f": None,
    "0x1p3": None,
    "+NaN": None,
    ".": None,
    "\t7": None,
}


def test_numbers(spark):
    df = texts(spark, list(NUMBERS))
    got = column(df, to_number(F.col("x")))
    for text, value, wanted in zip(NUMBERS, got, NUMBERS.values()):
        same = value == wanted or (wanted is not None and math.isnan(wanted) and math.isnan(value))
        assert same, text
    finite = column(df, is_finite(to_number(F.col("x"))))
    assert finite == [v is not None and math.isfinite(v) for v in NUMBERS.values()]


def test_missing(spark):
    cases = {None: True, "": True, "  ": True, "nan": True, "NaN": True, "0": False, "abc": False}
    df = texts(spark, [*cases, "inf"])
    assert column(df, is_missing(F.col("x"))) == [*cases.values(), False]
    doubles = spark.createDataFrame([(0, math.nan), (1, None), (2, 0.0)], "i int, x double")
    assert column(doubles, is_missing(F.col("x"))) == [True, True, False]


def test_duration_and_label(spark):
    df = spark.createDataFrame([(0, 2.0, 6.0), (1, None, 6.0), (2, 2.0, None)], "i int, y double, m double")
    assert column(df, years_and_months(F.col("y"), F.col("m"))) == [2.5, None, None]
    codes = texts(spark, ["1", "9", None])
    assert column(codes, label_of(F.col("x"), {"1": "one"})) == ["one", UNKNOWN, UNKNOWN]


def test_bands(spark):
    values = [10.0, 10.01, 20.0, 30.0, 40.0, 41.0, None, math.nan]
    df = spark.createDataFrame(list(enumerate(values)), "i int, x double")
    band = value_band(F.col("x"), [10, 20, 30, 40])
    wanted = ["p0-p25", "p25-p50", "p25-p50", "p50-p75", "p75-p95", "p95+", "p95+", "p95+"]
    assert column(df, band) == wanted
    assert column(df, band_rank(band)) == [BANDS.index(b) + 1 for b in wanted]
    with pytest.raises(ValueError):
        value_band(F.col("x"), [1, 2])


def test_staged_text(spark):
    schema = "i int, d double, b boolean, n decimal(10,2), t timestamp_ntz, s string"
    day = datetime.datetime(2025, 1, 2, 3, 4, 5)
    rows = [
        (0, 3.0, True, decimal.Decimal("1.50"), day, " a "),
        (1, 0.05, False, None, day.replace(microsecond=120), "\t"),
        (2, 12345678.5, None, None, None, None),
        (3, 1.5e-7, None, None, None, "x"),
        (4, math.nan, None, None, None, ""),
        (5, -math.inf, None, None, None, "y"),
        (6, -0.0, None, None, None, "z"),
        (7, 1e22, None, None, None, "z"),
    ]
    got = stage(spark.createDataFrame(rows, schema)).orderBy("i").collect()
    assert [r["d"] for r in got] == [
        "3", "0.05", "12345678.5", "1.5e-07", None, "-inf", "0", "1" + "0" * 22
    ]
    assert [r["b"] for r in got[:3]] == ["1", "0", None]
    assert got[0]["n"] == "1.50"
    assert [r["t"] for r in got[:3]] == ["2025-01-02T03:04:05", "2025-01-02T03:04:05.000120", None]
    assert [r["s"] for r in got[:3]] == ["a", None, None] and got[4]["s"] is None


def test_texts_of_plain_form_need_no_pattern(spark):
    values = ["5", "-5", "+.5", "5.", "1e5", "1d", "2F", "0x1p3", "0X1P3", " 7 ", "\t7", "7\t", "7\n", "-", ",5", "5/", ".", "", "nan", "-inf", "Infinity", None]
    df = texts(spark, values)
    pattern = r"^ *([+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i)(nan|[+-]?inf(inity)?)) *$"
    old = F.when(F.col("x").rlike(pattern), F.col("x").try_cast("double"))
    assert list(map(str, column(df, to_number(F.col("x"))))) == list(map(str, column(df, old)))
    codes = ["5.0", "5.00\n", " 5.0 ", "5.05", "x.0", ".0", "5", "10", "1.00.0", "", None]
    df = texts(spark, codes)
    short = F.regexp_replace(F.trim("x"), r"^([+-]?\d+)\.0+$", "$1")
    assert column(df, to_code(F.col("x"))) == column(df, F.nullif(short, F.lit("")))


def test_strip_needs_a_pattern_only_at_odd_ends(spark):
    values = ["a", " a b ", " a　", "é a", "a é ", "\x1ca", "a\x1f", "~", "!", "\x7f", "", " ", None]
    df = texts(spark, values)
    old = F.regexp_replace("x", f"^{SPACE}+|{SPACE}+$", "")
    assert column(df, strip(F.col("x"))) == column(df, old)


def test_plain_texts_skip_patterns(spark):
    # Java's pattern would take a time that grows with the square of such texts
    df = spark.range(2_000).select(F.concat(F.lit("a"), F.repeat(F.lit(" "), 20_000), F.lit("b")).alias("x")).repartition(2)
    started = time.monotonic()
    assert df.select(F.sum(F.length(strip(F.col("x"))))).first()[0] == 2_000 * 20_002
    assert time.monotonic() - started < 20
