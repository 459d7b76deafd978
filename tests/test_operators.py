"""Rename, dedup, ranking, quality reports."""

import math
import random

import pytest
from pyspark.sql import functions as F

from visitlake.operators import first_per_key, rename_positional, top_k_per_group
from visitlake.operators.quality import (
    fill_report,
    key_report,
    orphan_keys,
    orphan_report,
    repeated_keys,
    unreadable_report,
)
from visitlake.plans.pipeline import key_problems
from visitlake.plans.star import city_demography, immigration_facts
from visitlake.fixed import DEMOGRAPHY_SCHEMA, DIMENSION_KEYS, PORTS, VISIT_FIELDS


def test_rename_swaps_names(spark):
    df = rename_positional(spark.createDataFrame([(1, 2)], "a int, b int"), ["b", "a"])
    assert df.columns == ["b", "a"]
    assert tuple(df.first()) == (1, 2)


def test_repeated_keys_are_named(spark):
    draw = random.Random(5)
    rows = [(draw.choice(["a", "b", "", None]), draw.choice([1, 2, 3, None])) for _ in range(60)] + [("z", 9)]
    df = spark.createDataFrame(rows, "place string, code int")
    shown = [
        f"place={'NULL' if p is None else p}, code={'NULL' if c is None else c}" for p, c in rows
    ]
    expected = sorted(((shown.count(key), key) for key in set(shown)), key=lambda x: (-x[0], x[1]))
    expected = [("t", key, n) for n, key in expected if n > 1]
    for k in (0, 3, 100):
        assert [tuple(row) for row in repeated_keys("t", df, ["place", "code"], k).collect()] == expected[:k]
    assert repeated_keys("t", df.limit(0), ["place"], 5).collect() == []


def test_repeated_keys_are_cut_in_the_tasks(spark):
    df = spark.range(100).selectExpr("id % 7 as k")
    plan = repeated_keys("t", df, ["k"], 3)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject(limit=3" in plan
    assert plan.count("HashAggregate") >= 2


def test_failed_key_check_names_the_keys(spark):
    rows = [("NYC", "a"), ("NYC", "b"), ("LAX", "c"), (None, "d"), (None, "e"), (None, "f")]
    key = DIMENSION_KEYS[PORTS]
    ports = spark.createDataFrame(rows, f"{key[0]} string, name string")
    report = key_report(PORTS, ports, key).collect()
    assert key_problems(report, {PORTS: ports}) == [
        f"{PORTS}: 6 rows, 2 keys more than once ({key[0]}=NULL: 3 times, {key[0]}=NYC: 2 times)"
    ]


@pytest.mark.parametrize("names", [["x"], ["x", "y", "z"]])
def test_rename_needs_a_name_per_column(spark, names):
    with pytest.raises(ValueError):
        rename_positional(spark.createDataFrame([(1, 2)], "a int, b int"), names)


def test_first_per_key_is_the_smallest_row(spark):
    draw = random.Random(3)
    rows = [
        (draw.choice(["p", "q", None]), draw.choice([1, 2, None]), draw.choice([None, 1, 2, 3]))
        for _ in range(400)
    ]

    def nulls_first(value):
        return (value is not None, value or 0)

    wanted = {}
    for key, a, b in rows:
        order = (nulls_first(b), nulls_first(a))
        if key not in wanted or order < wanted[key][0]:
            wanted[key] = (order, (key, a, b))
    for parts in (1, 7):
        df = spark.createDataFrame(rows, "k string, a int, b int").repartition(parts)
        picked = first_per_key(df, ["k"], ["b"]).collect()
        assert sorted(map(tuple, picked), key=repr) == sorted(
            (row for _, row in wanted.values()), key=repr
        )


def test_city_keeps_the_smaller_race(spark):
    rows = [
        ("Bend", "Oregon", 1.0, 1, 2, 3, 4, 5, 2.5, "OR", "White"),
        ("Bend", "Oregon", 1.0, 1, 2, 3, 4, 5, 2.5, "OR", "Asian"),
        ("Bend", "Texas", 1.0, 1, 2, 3, 4, 5, 2.5, "TX", "White"),
    ]
    cities = city_demography(spark.createDataFrame(rows, DEMOGRAPHY_SCHEMA))
    assert "state" not in cities.columns
    found = {(row.city, row.state_id, row.race) for row in cities.collect()}
    assert found == {("BEND", "OR", "Asian"), ("BEND", "TX", "White")}


def test_top_k_per_group(spark):
    rows = [("a", n % 5, n) for n in range(50)] + [("b", 1, 1)]
    df = spark.createDataFrame(rows, "g string, m int, n int")
    top = top_k_per_group(df, ["g"], [F.desc("m"), "n"], 3).collect()
    assert sorted(map(tuple, top)) == [("a", 4, 4), ("a", 4, 9), ("a", 4, 14), ("b", 1, 1)]


@pytest.mark.parametrize(
    "keys, expected",
    [
        (["a", None], (2, 2, 0, True, True)),
        (["a", None, None], (3, 2, 1, False, True)),
        (["a", "a", "b", "b", "b"], (5, 2, 2, False, True)),
        ([], (0, 0, 0, True, False)),
    ],
)
def test_key_report(spark, keys, expected):
    df = spark.createDataFrame([(key,) for key in keys], "k string")
    assert tuple(key_report("t", df, ["k"]).first()) == ("t", *expected)
    filled = fill_report("t", df).first()
    assert (filled.row_count, filled.is_filled) == (expected[0], expected[4])


def test_composite_key_with_null(spark):
    df = spark.createDataFrame([("x", None), ("x", "a"), (None, "a")], "c string, s string")
    assert key_report("t", df, ["c", "s"]).first().is_unique


def test_orphans(spark):
    visits = spark.createDataFrame(
        [(582.0, "A"), (582.0, "B"), (7.0, "B"), (None, "C"), (-0.0, None)],
        "country double, port string",
    )
    countries = spark.createDataFrame([(582,), (0,)], "id int")
    ports = spark.createDataFrame([("A",), ("A",), ("C",)], "code string")
    orphans = orphan_keys(visits, {"country": (countries, "id"), "port": (ports, "code")})
    assert sorted(map(tuple, orphans.collect()), key=repr) == [
        ("country", "7.0", 1),
        ("country", None, 1),
        ("port", "B", 2),
        ("port", None, 1),
    ]
    assert sorted(map(tuple, orphan_report(orphans).collect())) == [
        ("country", 1, 1, 1),
        ("port", 1, 2, 1),
    ]


def test_unreadable_dates_are_counted(spark):
    df = spark.createDataFrame(
        [(1.0, math.nan), (0.0, 1e12), (math.inf, None)], "arrdate double, depdate double"
    )
    assert tuple(unreadable_report(df, ["arrdate", "depdate"]).first()) == (1, 2)


def test_facts_are_distinct_and_stay_so(spark):
    kinds = [
        "string" if kind == "string" else "double" for _, _, kind in VISIT_FIELDS
    ]
    schema = ", ".join(f"{name} {kind}" for (name, _, _), kind in zip(VISIT_FIELDS, kinds))
    record = [1.0 if kind == "double" else "s" for kind in kinds]
    other = list(record)
    other[5] = 1.5  # same date, another record
    raw = spark.createDataFrame([record] * 5 + [other] + [[None] * 18] * 2, schema)
    facts = immigration_facts(raw)
    assert facts.columns == [name for _, name, _ in VISIT_FIELDS]
    assert dict(facts.dtypes) == {name: kind for _, name, kind in VISIT_FIELDS}
    assert facts.count() == 3
    assert raw.select(*raw.columns).distinct().distinct().count() == 3
