from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lakeloom.functions import casts


def evaluate(spark, expression, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    found = df.select("i", expression("v").alias("r")).collect()
    return [r["r"] for r in sorted(found, key=lambda r: r["i"])]


def test_lenient_int_cuts_fractions(spark):
    values = ["12.5", " 7 ", ".5", ".", "-.5", "5.", "-3.9", "+4", "-2147483648.9", "\t8.9\n"]
    assert evaluate(spark, casts.lenient_int, values) == [12, 7, 0, 0, 0, 5, -3, 4, -2147483648, 8]


def test_lenient_int_rejects_other_text(spark):
    values = ["x", "1e3", "12.x", "1.2.3", "", "-", "99999999999", "2147483648.1", None, "1 2"]
    assert evaluate(spark, casts.lenient_int, values) == [None] * len(values)


numeric_text = st.text(alphabet="0123456789.+-eE x\t", max_size=13)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(numeric_text, min_size=50, max_size=200))
def test_lenient_int_equals_the_cast_without_ansi(spark, values):
    legacy = spark.newSession()
    legacy.conf.set("spark.sql.ansi.enabled", "false")
    legacy_rows = legacy.createDataFrame(list(enumerate(values)), "i int, v string").selectExpr(
        "i", "cast(v as int) r"
    )
    expected = [r["r"] for r in sorted(legacy_rows.collect(), key=lambda r: r["i"])]
    assert evaluate(spark, casts.lenient_int, values) == expected


@pytest.mark.parametrize(
    "dtype, values, expected",
    [
        (
            "decimal(10,0)",
            ["12.5", "1e3", "99999999999", "x", None],
            [Decimal(13), Decimal(1000), None, None, None],
        ),
        ("boolean", ["True", "Y", "1", "x", "f"], [True, True, True, None, False]),
        ("date", ["2020-1-2", "12.5", ""], [dt.date(2020, 1, 2), None, None]),
        ("float", ["1.5", "x"], [1.5, None]),
        ("double", ["1e3", "x"], [1000.0, None]),
    ],
)
def test_typed(spark, dtype, values, expected):
    assert evaluate(spark, lambda c: casts.typed(c, dtype), values) == expected


def test_clock_time(spark):
    def seconds(c):
        return casts.seconds_of_day(casts.clock_time(c))

    values = ["09:05:07", "x", "23:59:59", "24:00:00", None]
    assert evaluate(spark, seconds, values) == [32707, None, 86399, None, None]


def test_arrival_without_date_belongs_to_the_travel_date(spark):
    df = spark.createDataFrame(
        [
            ("9:05", "2020-01-02"),
            ("T23:10:09", "2020-01-02"),
            ("2020-01-03 09:05:00", "2020-01-02"),
            ("9:05", None),
            ("9:05", "x"),
            ("99:05", "2020-01-02"),
            ("x", "2020-01-02"),
        ],
        "v string, d string",
    )
    found = [r[0] for r in df.select(casts.arrival_timestamp("v", "d")).collect()]
    assert found == [
        dt.datetime(2020, 1, 2, 9, 5),
        dt.datetime(2020, 1, 2, 23, 10, 9),
        dt.datetime(2020, 1, 3, 9, 5),
        None,
        None,
        None,
        None,
    ]
