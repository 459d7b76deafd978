"""Edge rows of the column expressions."""

import datetime
import math
import random

import pytest
from pyspark.sql import functions as F

from visitlake.functions import (
    label_id,
    port_city,
    port_state,
    replace_invalid_country,
    sas_date,
    strip_label,
    unreadable_sas_date,
)

D = datetime.date


def apply(spark, values, kind, *expressions):
    """Values of the expressions over a column ``x``, in the order of the input."""
    df = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")
    rows = df.select("i", *expressions).orderBy("i").collect()
    return [tuple(row)[1:] if len(expressions) > 1 else row[1] for row in rows]


@pytest.mark.parametrize(
    "days, expected",
    [
        (20545.0, D(2016, 4, 1)),
        (20545.9, D(2016, 4, 1)),
        (-0.5, D(1959, 12, 31)),
        (-10.0, D(1959, 12, 22)),
        (0.0, None),
        (-0.0, None),
        (None, None),
        (0.5, D(1960, 1, 1)),
        (math.nan, None),
        (math.inf, None),
        (-math.inf, None),
        (1e300, None),
        (float((D.max - D(1960, 1, 1)).days), D.max),
        (float((D.max - D(1960, 1, 1)).days + 1), None),
        (float((D.min - D(1960, 1, 1)).days), D.min),
        ((D.min - D(1960, 1, 1)).days - 0.5, None),
    ],
)
def test_sas_date(spark, days, expected):
    assert apply(spark, [days], "double", sas_date("x")) == [expected]


@pytest.mark.parametrize("kind", ["int", "bigint", "decimal(10,2)", "float"])
def test_sas_date_takes_any_number(spark, kind):
    df = spark.sql(f"SELECT CAST(20545 AS {kind}) AS x")
    assert df.select(sas_date("x")).first()[0] == D(2016, 4, 1)


def test_sas_date_equals_calendar(spark):
    draw = random.Random(7)
    days = [draw.uniform(-40000, 60000) for _ in range(1500)]
    days += [float(draw.randint(-40000, 60000)) for _ in range(1000)]
    wanted = [
        D.fromordinal(D(1960, 1, 1).toordinal() + math.floor(x)) if x != 0 else None for x in days
    ]
    assert apply(spark, days, "double", sas_date("x")) == wanted


def test_unreadable_sas_date(spark):
    values = [20545.0, 0.0, None, math.nan, 1e9, -0.0]
    wanted = [False, False, False, True, True, False]
    assert apply(spark, values, "double", unreadable_sas_date("x")) == wanted


def test_label_id(spark):
    values = ["582", " 7 ", "abc", "", None, "99999999999"]
    assert apply(spark, values, "string", label_id("x")) == [582, 7, None, None, None, None]


def test_replace_invalid_country(spark):
    values = [
        "No Country Code (1)",
        "INVALID: X",
        "Collapsed T",
        "FOO INVALID: X",
        "FOO Collapsed (should be Y)",
        "My No Country",
        "invalid",
        "MEXICO",
        None,
    ]
    wanted = ["NA", "NA", "NA", "FOO NA", "FOO NA", "My No Country", "invalid", "MEXICO", None]
    assert apply(spark, values, "string", replace_invalid_country("x")) == wanted


def test_port_parts(spark):
    values = ["A, B ", "MARIPOSA AZ   ", "X, y, Z", ", B", "C,", None]
    assert apply(spark, values, "string", port_city("x"), port_state("x")) == [
        ("A", "B"),
        ("MARIPOSA AZ", None),
        ("X", "y"),
        ("", "B"),
        ("C", ""),
        (None, None),
    ]
    assert apply(spark, values, "string", port_city("x", trim=False))[1] == "MARIPOSA AZ   "


def test_strip_label(spark):
    values = [
        "  'MEXICO (x, y)'",
        "   'ARGENTINA '\t",
        "'INT''L FALLS, MN  '",
        " 'CP '\t",
        "  'x'\u3000\x1c",
        "''",
        "Business",
        "' ' ",
    ]
    wanted = [
        "MEXICO (x, y)",
        "ARGENTINA ",
        "INT''L FALLS, MN  ",
        "CP ",
        "x",
        "",
        "Business",
        " ",
    ]
    assert apply(spark, values, "string", strip_label(F.col("x"))) == wanted
    assert wanted == [value.strip().strip("'") for value in values]
