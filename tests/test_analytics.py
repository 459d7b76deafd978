"""The questions against plain loops over small tables."""

import itertools
import random
from collections import Counter

import pytest

from visitlake.plans import analytics
from visitlake.sources import register_views


def visits_of(spark, rows):
    return spark.createDataFrame(
        rows, "year int, month int, airport_code string, citizen_country_id double"
    )


@pytest.fixture(scope="module")
def tables(spark):
    draw = random.Random(11)
    rows = [
        (
            draw.choice([2015, 2016]),
            draw.randint(1, 12),
            draw.choice(["NYC", "NYC", "MIA", "LOS", "XXX", None]),
            draw.choice([1.0, 2.0, 3.0, 4.0, None]),
        )
        for _ in range(600)
    ]
    ports = [("NYC", "NEW YORK", "NY"), ("MIA", "MIAMI", "FL"), ("LOS", "LOS ANGELES", "CA")]
    countries = [(1, "ONE"), (2, "TWO"), (3, "THREE")]
    return {
        "rows": rows,
        "visits": visits_of(spark, rows),
        "ports": spark.createDataFrame(
            ports, "airport_code string, city string, us_state_id string"
        ),
        "countries": spark.createDataFrame(countries, "country_id int, country_name string"),
    }


def ranked(counts, k):
    return sorted(counts.items(), key=lambda item: (-item[1], item[0] is None, item[0]))[:k]


def test_top_ports_drops_a_port_without_city(spark, tables):
    counts = Counter(port for year, month, port, _ in tables["rows"] if month == 4)
    counts_in_order = sorted(counts.items(), key=lambda item: (-item[1], item[0] or ""))
    cities = {"NYC": "NEW YORK", "MIA": "MIAMI", "LOS": "LOS ANGELES"}
    found = analytics.top_ports_of_month(tables["visits"], tables["ports"], 4).collect()
    assert [tuple(row) for row in found] == [
        (cities[port], port, n) for port, n in counts_in_order if port in cities
    ]


def test_last_month_and_last_year(spark, tables):
    last = max((year, month) for year, month, _, _ in tables["rows"])
    in_month = analytics.in_last_month(tables["visits"])
    assert {tuple(row) for row in in_month.select("year", "month").collect()} == {last}
    assert in_month.count() == sum(1 for row in tables["rows"] if row[:2] == last)
    assert analytics.in_last_year(tables["visits"]).count() == sum(
        1 for row in tables["rows"] if row[0] == last[0]
    )


def test_top_countries(spark, tables):
    names = {1.0: "ONE", 2.0: "TWO", 3.0: "THREE"}
    counts = Counter(country for _, _, port, country in tables["rows"] if port == "NYC")
    for k in (1, 3, 10):
        found = analytics.top_countries(tables["visits"], tables["countries"], "NYC", k)
        assert [tuple(row) for row in found.collect()] == [
            (names[country], n) for country, n in ranked(counts, k) if country in names
        ]


def test_top_countries_per_year(spark, tables):
    names = {1.0: "ONE", 2.0: "TWO", 3.0: "THREE"}
    wanted = []
    for year in (2015, 2016):
        counts = Counter(
            country for y, _, port, country in tables["rows"] if port == "NYC" and y == year
        )
        wanted += [(year, names[c], n) for c, n in ranked(counts, 2) if c in names]
    found = analytics.top_countries_per_year(tables["visits"], tables["countries"], "NYC", 2)
    assert [tuple(row) for row in found.collect()] == wanted


def test_sum_of_counts_is_all_visits(spark, tables):
    counts = analytics.count_visits(tables["visits"], "airport_code").collect()
    assert sum(row.immigrant_visits for row in counts) == len(tables["rows"])


@pytest.mark.parametrize("match_state", [True, False])
@pytest.mark.parametrize("seed", range(4))
def test_visit_share_equals_all_pairs(spark, match_state, seed):
    """Few city names for many ports and states, so each name has far more than k pairs."""
    draw = random.Random(seed)
    states = {code: f"STATE {code}" for code in "ABCDEFG"}
    ports = [(f"P{n}", draw.choice(["X", "Y", None]), draw.choice("ABCH")) for n in range(25)]
    keys = itertools.product(["X", "Y", "Z"], "ABCDEFGH")
    people = [(*key, draw.choice([None, 0, -4, 5, 5, 10, 20, 40])) for key in keys]
    visits = [(2016, 4, draw.choice(ports)[0], 1.0) for _ in range(150)]
    counts = Counter(port for _, _, port, _ in visits)

    pairs = []
    for port, city, port_state in ports:
        for name, state, population in people:
            together = city == name and (not match_state or port_state == state)
            if port in counts and together and state in states:
                share = counts[port] / population if population and population > 0 else None
                pairs.append((name, states[state], counts[port], population, share, port))

    def order(pair):
        name, state, n, population, share, port = pair
        filled = population is not None
        return (share is None, -(share or 0), -n, name, port, state, filled, population or 0)

    wanted = [pair[:5] for pair in sorted(pairs, key=order)]
    for k in (1, 5, len(wanted) + 1):
        found = analytics.visit_share(
            visits_of(spark, visits),
            spark.createDataFrame(ports, "airport_code string, city string, us_state_id string"),
            spark.createDataFrame(people, "city string, state_id string, total_population int"),
            spark.createDataFrame(
                list(states.items()), "us_state_id string, us_state_name string"
            ),
            k,
            match_state,
        )
        assert [tuple(row) for row in found.collect()] == wanted[:k]


def test_tables_are_known_to_sql(spark, tables):
    register_views({"immigration_facts": tables["visits"], "dim_airport_codes": tables["ports"]})
    found = spark.sql(
        "SELECT COUNT(*) FROM immigration_facts JOIN dim_airport_codes USING (airport_code)"
    )
    assert found.first()[0] == sum(1 for row in tables["rows"] if row[2] in ("NYC", "MIA", "LOS"))
