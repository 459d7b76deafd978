"""Builders of the visits table and its six dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlake.fixed import (
    COUNTRIES,
    COUNTRY_SECTION,
    DEMOGRAPHY,
    MODE_SECTION,
    MODES,
    OTHER_STATE_CODE,
    PORT_SECTION,
    PORT_FIELD,
    PORTS,
    STATE_SECTION,
    STATES,
    VISA_SECTION,
    VISAS,
    VISIT_FIELDS,
    VISITS,
)
from visitlake.functions import (
    label_id,
    port_city,
    port_state,
    replace_invalid_country,
    sas_date,
    whole_number,
)
from visitlake.operators import first_per_key, rename_positional


def immigration_facts(raw: DataFrame) -> DataFrame:
    """Visits table: distinct records, with day numbers as dates, under the table's names.

    Records are compared as they came, before any conversion. The distinct drops copies within
    each task first, so a record with very many copies sends one row per task.
    """
    return name_visits(raw.select(*[source for source, _, _ in VISIT_FIELDS]).distinct())


def name_visits(raw: DataFrame) -> DataFrame:
    """Types and names of the visits table.

    Day numbers become dates, year and month whole numbers, and an empty port code becomes NULL,
    because a folder cannot tell the two apart. All other columns stay as they are stored.
    """
    typed = raw.select(*[typed_field(source, kind).alias(source) for source, _, kind in VISIT_FIELDS])
    return rename_positional(typed, [name for _, name, _ in VISIT_FIELDS])


def typed_field(source: str, kind: str) -> Column:
    """A field of a raw record as the visits table has it."""
    if kind == "date":
        return sas_date(source)
    if kind == "int":
        return whole_number(source)
    if source == PORT_FIELD:
        text = F.col(source).cast("string")
        return F.when(text != "", text)
    return F.col(source)


def city_demography(raw: DataFrame) -> DataFrame:
    """One row per city and state, the one with the smallest race; city in upper case."""
    picked = first_per_key(raw, keys=["city", "state"], order=["race"])
    return picked.drop("state").withColumn("city", F.upper("city"))


def travel_modes(pairs: DataFrame) -> DataFrame:
    return _section(pairs, MODE_SECTION).select(
        label_id("code").alias("travel_mode_id"), F.col("name").alias("travel_mode_name")
    )


def countries(pairs: DataFrame) -> DataFrame:
    return _section(pairs, COUNTRY_SECTION).select(
        label_id("code").alias("country_id"),
        replace_invalid_country("name").alias("country_name"),
    )


def visa_categories(pairs: DataFrame) -> DataFrame:
    return _section(pairs, VISA_SECTION).select(
        label_id("code").alias("visa_category_id"), F.col("name").alias("visa_category_name")
    )


def us_states(pairs: DataFrame) -> DataFrame:
    return (
        _section(pairs, STATE_SECTION)
        .select(F.col("code").alias("us_state_id"), F.col("name").alias("us_state_name"))
        .where(F.col("us_state_id") != OTHER_STATE_CODE)
    )


def airport_codes(pairs: DataFrame, trim_city: bool = True) -> DataFrame:
    """Port code, city and state. With ``trim_city`` off, a city keeps its blanks."""
    return (
        _section(pairs, PORT_SECTION)
        .select(F.col("code").alias("airport_code"), "name")
        .withColumns({"city": port_city("name", trim_city), "us_state_id": port_state("name")})
        .drop("name")
    )


def build_star(
    raw_visits: DataFrame, raw_demography: DataFrame, pairs: DataFrame
) -> dict[str, DataFrame]:
    """All seven tables by name, none of them computed yet."""
    return {
        VISITS: immigration_facts(raw_visits),
        DEMOGRAPHY: city_demography(raw_demography),
        MODES: travel_modes(pairs),
        COUNTRIES: countries(pairs),
        VISAS: visa_categories(pairs),
        STATES: us_states(pairs),
        PORTS: airport_codes(pairs),
    }


def _section(pairs: DataFrame, section: str) -> DataFrame:
    return pairs.where(F.col("section") == section)
