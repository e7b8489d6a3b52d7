"""Edge cases of the column functions, with hand-computed results."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tesela import functions as fn


def apply(spark, column, values, type_="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {type_}")
    return [r[0] for r in df.select("i", column.alias("y")).orderBy("i").select("y").collect()]


def test_parse_number(spark):
    cases = {
        "6,00": 6.0, "108.73": 108.73, "1.234,56": 1234.56, "1.174.274": 1174274.0,
        "386.466": 386466.0, "0.125": 125.0, "-386.466": -386.466, "1,234.56": 1.23456,
        "1,234,567": None, ".5": 0.5, "5.": 5.0, "1e3": 1000.0, "NaN": None, "1d": None,
        "abc": None, "": None, None: None, "1·5": 1.5, "1e400": None, "Infinity": None,
        "  7 ": 7.0, "..": None, "+3": 3.0, "1.2.3": 123.0,
    }
    assert apply(spark, fn.parse_number("x"), list(cases)) == list(cases.values())


def test_codes_and_years(spark):
    codes = ["5001", " 11001 ", "", "123456", None]
    assert apply(spark, fn.normalize_code("x"), codes) == ["05001", "11001", None, "12345", None]
    assert apply(spark, fn.period_year("x"), ["20231", "", "ab231", None]) == [2023, None, None, None]
    assert apply(spark, fn.year_or_null("x"), [" 2021", "", "x"]) == [2021, None, None]


def test_flags_and_numbers_in_text(spark):
    assert apply(spark, fn.yes_no_flag("x"), ["Si", "SI ", "no", "", None]) == [1, 1, 0, None, None]
    assert apply(spark, fn.like_flag("x", "%Superior%"), ["a Superior", "superior", None]) == [1, 0, 0]
    texts = ["Estrato 3", "Sin Estrato", "9 o más", None]
    assert apply(spark, fn.first_number("x"), texts) == [3.0, None, 9.0, None]


def test_classes(spark):
    speeds = [9.99, 10.0, 100.0, 100.01, None]
    want = ["baja", "media", "media", "alta", None]
    assert apply(spark, fn.speed_class("x"), speeds, "double") == want
    assert apply(spark, fn.clamp("x", 0, 500), [-1.0, 7.0, 501.0, None], "double") == [0, 7, 500, None]
    segments = ["Residencial - Estrato 1", "ESTRATO 2", "Corporativo", "Empresas", "Uso propio", None]
    assert apply(spark, fn.segment_class("x"), segments) == [
        "Residencial", "Residencial", "Corporativo", "Corporativo", "Otro", "Sin clasificar",
    ]
    assert apply(spark, fn.ordinal("x"), ["alta", "baja", "?", None]) == [3, 1, 4, 4]


@pytest.mark.parametrize("a,b,want", [(10.0, 0.0, None), (10.0, -1.0, None), (10.0, None, None), (None, 5.0, None), (6.0, 4.0, 1.5)])
def test_safe_ratio(spark, a, b, want):
    df = spark.createDataFrame([(a, b)], "a double, b double")
    assert df.select(fn.safe_ratio("a", "b")).first()[0] == want


def test_label_map_keeps_unknown_codes(spark):
    assert apply(spark, fn.label_map("x", {"a": "A"}), ["a", "b", None]) == ["A", "b", None]


def test_functions_do_not_raise_under_ansi(spark):
    junk = ["", " ", "1,2,3", "x", "9" * 400, "--1", None, "1e", "٣"]
    for column in (fn.parse_number("x"), fn.period_year("x"), fn.first_number("x"), F.col("x")):
        assert len(apply(spark, column, junk)) == len(junk)
