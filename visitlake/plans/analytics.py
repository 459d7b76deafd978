"""Questions over the star schema.

Every question counts visits first and joins the few counted rows afterwards, so no join sees the
visits themselves. No join is hinted: Spark broadcasts a dimension when its measured size allows
it and shuffles both sides when not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlake.operators import top_k, top_k_per_group

VISIT_COUNT = "immigrant_visits"


def count_visits(visits: DataFrame, *keys: str) -> DataFrame:
    """Visits per key; of rows that are counted already (``read_counts``), their sums."""
    counted = VISIT_COUNT in visits.columns
    number = F.sum(VISIT_COUNT) if counted else F.count(F.lit(1))
    return visits.groupBy(*keys).agg(number.alias(VISIT_COUNT))


def in_last_month(visits: DataFrame, months: DataFrame | None = None) -> DataFrame:
    """Visits of the latest month there is.

    Give the lake's table of months, which has a row per month; without it the month is looked for in the visits.
    """
    month_number = F.col("year") * 12 + F.col("month")
    known = visits if months is None else months
    return visits.where(month_number == known.agg(F.max(month_number)).scalar())


def in_last_year(visits: DataFrame, months: DataFrame | None = None) -> DataFrame:
    known = visits if months is None else months
    return visits.where(F.col("year") == known.agg(F.max("year")).scalar())


def top_ports(visits: DataFrame, ports: DataFrame, k: int = 10) -> DataFrame:
    """Busiest ports with their city. Restrict ``visits`` to a period first."""
    busiest = top_k(
        count_visits(visits, "airport_code"), [F.desc(VISIT_COUNT), "airport_code"], k
    )
    return (
        busiest.join(ports, "airport_code")
        .select("city", "airport_code", VISIT_COUNT)
        .orderBy(F.desc(VISIT_COUNT), "airport_code")
    )


def top_ports_of_month(
    visits: DataFrame, ports: DataFrame, month: int, year: int | None = None, k: int = 10
) -> DataFrame:
    """Busiest ports of a calendar month, in one year or in all years together."""
    period = F.col("month") == month
    if year is not None:
        period &= F.col("year") == year
    return top_ports(visits.where(period), ports, k)


def top_ports_of_last_month(
    visits: DataFrame, ports: DataFrame, k: int = 10, months: DataFrame | None = None
) -> DataFrame:
    return top_ports(in_last_month(visits, months), ports, k)


def visit_share(
    visits: DataFrame,
    ports: DataFrame,
    demography: DataFrame,
    states: DataFrame,
    k: int = 5,
    match_state: bool = True,
) -> DataFrame:
    """Cities with the most visits of one port relative to their population.

    A port belongs to the city of its name and state, or with ``match_state`` off to every city
    of its name, whatever the state. A population that is not positive has no share, and such
    rows come last.

    Only the k busiest ports and the k smallest populations of a city can take part in the first
    k shares. Both sides are cut to those before they meet, so a city name that very many ports
    or states use does not give all its pairs. The orders agree with the final one, ties
    included, so the result is the same as without the cut.
    """
    place = ["city", "us_state_id"] if match_state else ["city"]
    visited = count_visits(visits, "airport_code").join(ports, "airport_code")
    peopled = demography.select(
        "city", F.col("state_id").alias("us_state_id"), "total_population"
    ).join(states, "us_state_id")

    busiest = top_k_per_group(visited, place, [F.desc(VISIT_COUNT), "airport_code"], k)
    smallest = top_k_per_group(
        peopled, place, [F.asc_nulls_last(_positive("total_population")), *_LAST_ORDER], k
    )
    if not match_state:
        busiest = busiest.drop("us_state_id")

    share = F.col(VISIT_COUNT) / _positive("total_population")
    return top_k(
        busiest.join(smallest, place).withColumn("immigrant_share", share),
        [
            F.desc_nulls_last("immigrant_share"),
            F.desc(VISIT_COUNT),
            "city",
            "airport_code",
            *_LAST_ORDER,
        ],
        k,
    ).select("city", "us_state_name", VISIT_COUNT, "total_population", "immigrant_share")


_LAST_ORDER = ["us_state_name", "total_population"]


def top_countries(
    visits: DataFrame, countries: DataFrame, port: str, k: int = 3
) -> DataFrame:
    """Most frequent nationalities at a port.

    The k largest groups are taken first. One whose country is not known has no name to show and
    is left out, so there may be fewer than k rows.
    """
    at_port = visits.where(F.col("airport_code") == port)
    largest = top_k(
        count_visits(at_port, "citizen_country_id"),
        [F.desc(VISIT_COUNT), F.asc_nulls_last("citizen_country_id")],
        k,
    )
    return (
        _with_country(largest, countries)
        .orderBy(F.desc(VISIT_COUNT), "citizen_country_id")
        .select(F.col("country_name").alias("country_of_origin"), VISIT_COUNT)
    )


def top_countries_per_year(
    visits: DataFrame, countries: DataFrame, port: str, k: int = 3
) -> DataFrame:
    """Most frequent nationalities at a port, year by year."""
    at_port = visits.where(F.col("airport_code") == port)
    largest = top_k_per_group(
        count_visits(at_port, "year", "citizen_country_id"),
        ["year"],
        [F.desc(VISIT_COUNT), F.asc_nulls_last("citizen_country_id")],
        k,
    )
    return (
        _with_country(largest, countries)
        .orderBy("year", F.desc(VISIT_COUNT), "citizen_country_id")
        .select("year", F.col("country_name").alias("country_of_origin"), VISIT_COUNT)
    )


def _with_country(counted: DataFrame, countries: DataFrame) -> DataFrame:
    return counted.join(countries, counted["citizen_country_id"] == countries["country_id"])


def _positive(name: str) -> Column:
    return F.when(F.col(name) > 0, F.col(name))
