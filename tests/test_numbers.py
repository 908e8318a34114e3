import math

import pytest
from pyspark.sql import functions as F

from remitlens.functions import numbers, text


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


NUMBERS = [
    ("1,234.50", 1234.5),
    (" 45% ", 0.45),
    ("5 %", 0.05),
    ("%", None),
    ("", None),
    ("abc", None),
    (None, None),
    ("1d", None),
    ("1f", None),
    ("1e3", 1000.0),
    ("-2.5E-1", -0.25),
    (".5", 0.5),
    ("5.", 5.0),
    ("1_000", 1000.0),
    ("1__0", None),
    ("+7", 7.0),
    ("nan", None),
    ("-inf", -math.inf),
    ("\t12\n", 12.0),
    ("0x10", None),
    ("1,2,3%", 1.23),
]


@pytest.mark.parametrize("given, expected", NUMBERS)
def test_parse_number(spark, given, expected):
    ((got,),) = values(spark, [(given,)], "c string", numbers.parse_number(F.col("c")))
    assert got == (pytest.approx(expected) if expected is not None and math.isfinite(expected) else expected)


def test_parse_number_of_numeric_columns(spark):
    got = values(spark, [(7, 2.5e9, math.nan)], "i int, d double, n double", *[numbers.parse_number(F.col(c)) for c in "idn"])
    assert got == [(7.0, 2.5e9, None)]


def test_to_number_rejects_comma_and_percent(spark):
    got = values(spark, [("1,234",), ("5%",), (" 12 ",)], "c string", numbers.to_number(F.col("c")))
    assert got == [(None,), (None,), (12.0,)]


def test_year_and_week(spark):
    rows = [("2024.0", "Week 07"), (" 2023 ", "53"), ("Grand Total", "none"), (None, None)]
    got = values(spark, rows, "y string, w string", numbers.parse_year(F.col("y")), numbers.parse_week(F.col("w")))
    assert got == [(2024, 7), (2023, 53), (None, 0), (None, 0)]
    assert values(spark, [(2024.0,)], "y double", numbers.parse_year(F.col("y"))) == [(2024,)]


def test_guarded_divisions(spark):
    rows = [(1.0, 2.0), (1.0, 0.0), (1.0, None), (None, 2.0), (0.0, 0.0)]
    a, b = F.col("a"), F.col("b")
    got = values(spark, rows, "a double, b double", numbers.div_or_null(a, b), numbers.div_or_zero(a, b))
    assert got == [(0.5, 0.5), (None, 0.0), (None, None), (None, None), (None, 0.0)]


def test_parts(spark):
    got = values(spark, [(2.0,), (-3.0,), (0.0,), (None,)], "x double", numbers.positive_part(F.col("x")), numbers.negative_part(F.col("x")))
    assert got == [(2.0, 0.0), (0.0, -3.0), (0.0, 0.0), (0.0, 0.0)]


def test_sum_of_missing_values_is_zero_but_mean_is_missing(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 1.0), ("b", None)], "k string, x double")
    got = df.groupBy("k").agg(numbers.sum0(F.col("x")), F.avg("x")).orderBy("k").collect()
    assert [tuple(r) for r in got] == [("a", 0.0, None), ("b", 1.0, 1.0)]


def test_halves_round_to_even(spark):
    got = values(spark, [(0.125,), (0.375,), (-0.125,)], "x double", numbers.round2_even(F.col("x")), text.fixed2(F.col("x")))
    assert got == [(0.12, "0.12"), (0.38, "0.38"), (-0.12, "-0.12")]


def test_is_close(spark):
    rows = [(None, None), (None, 0.0), (100.0, 101.0), (100.0, 102.0), (1e-7, 0.0), (None, 5.0)]
    got = values(spark, rows, "a double, b double", numbers.is_close(F.col("a"), F.col("b"), 1e-2))
    assert [r[0] for r in got] == [True, True, True, False, True, False]


def test_label_bounds_are_strict(spark):
    rows = [(105.0, 100.0), (105.01, 100.0), (95.0, 100.0), (94.9, 100.0), (1.0, 0.0), (None, 1.0), (1.0, None), (-90.0, -100.0)]
    got = values(spark, rows, "a double, e double", numbers.performance_label(F.col("a"), F.col("e")))
    expected = ["Average Performance", "Over Performing", "Average Performance", "Under Performing", "No Data", "No Data", "No Data"]
    assert [r[0] for r in got] == [*expected, "Under Performing"]


def test_percent_text(spark):
    got = values(spark, [(0.455,), (0.005,), (0.015,), (None,), (-0.2,)], "x double", text.percent_text(F.col("x")))
    assert [r[0] for r in got] == ["46%", "0%", "2%", "<NA>%", "-20%"]


def test_list_repr_and_keys(spark):
    rows = [(["b", "a"], None), ([], "x")]
    got = values(spark, rows, "l array<string>, p string", text.list_repr(F.col("l")), text.pipe_key(F.col("p"), F.lit("g")))
    assert got == [("['b', 'a']", "nan|g"), ("[]", "x|g")]


@pytest.mark.parametrize(
    "key, n",
    [
        ("p|g|h|['a', 'b']", 2),
        ("p|g|h|[]", 0),
        ("p|g|h|['a,b']", 1),
        ("p|g|h", 0),
        ("p|g|h|['a', ]", 1),
        ("p|g|h|['a' 'b']", 0),
        ("p|g|h|[1, 2, 3]", 3),
        (None, None),
    ],
)
def test_cpt_count(spark, key, n):
    assert values(spark, [(key,)], "k string", text.cpt_count(F.col("k"))) == [(n if key else 0,)]


def test_ml_sentence(spark):
    rows = [(-1234.5, 2, -3.125), (10.0, None, 0.0), (None, 1, 1.0)]
    got = values(spark, rows, "d double, f bigint, g double", text.ml_sentence(*[F.col(c) for c in "dfg"]))
    assert [r[0] for r in got] == [
        "ML signals under-payment ≈ $1,234 (2 material flags; avg rate gap -3.12/visit).",
        "ML signals over-payment ≈ $10 (0 material flags; avg rate gap +0.00/visit).",
        "",
    ]
