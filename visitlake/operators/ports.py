"""States of ports: their codes, whatever the port's name has instead, and the ports that match no city."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NO_STATE, UNKNOWN_STATE, NO_CITY = "no state", "unknown state", "no such city"


def resolve_ports(ports: DataFrame, states: DataFrame) -> DataFrame:
    """Ports (airport_code, city, us_state_id) with the code of their state, and ``matched_by``.

    What stands after the comma is a code of the section of states ("code") or the name of one ("name"),
    without regard to case and repeated blanks. A port without a comma gives its last word to the state if that is
    a code ("last word"). Otherwise the port stays as it is ("unknown state", "no state"). The joins go
    through the states by their spelling, of which each has one row: the least code, a code before a name.
    """
    spelled = (
        states.select(F.col("us_state_id").alias("code"), F.inline(_spellings("us_state_id", "us_state_name")))
        .where(F.col("spelling") != "")
        .groupBy("spelling")
        .agg(F.min(F.struct("is_name", "code")).alias("least"))
        .select("spelling", "least.*")
    )
    last_word = F.element_at(F.split(F.trim("city"), " +"), -1)
    wanted = F.when(F.col("us_state_id").isNotNull(), _folded(F.col("us_state_id"))).otherwise(_folded(last_word))
    joined = ports.withColumn("spelling", wanted).join(spelled, "spelling", "left")
    given, found = F.col("us_state_id").isNotNull(), F.col("code").isNotNull()
    by_last_word = ~given & found & ~F.col("is_name")
    matched_by = (
        F.when(by_last_word, "last word")
        .when(~given, NO_STATE)
        .when(~found, UNKNOWN_STATE)
        .when(F.col("is_name"), "name")
        .otherwise("code")
    )
    city = F.when(by_last_word, F.trim(F.regexp_replace(F.trim("city"), "[^ ]+$", ""))).otherwise(F.col("city"))
    return joined.select(
        "airport_code",
        city.alias("city"),
        F.when(by_last_word | (given & found), F.col("code")).otherwise(F.col("us_state_id")).alias("us_state_id"),
        matched_by.alias("matched_by"),
    )


def unmatched_ports(resolved: DataFrame, demography: DataFrame, visits: DataFrame) -> DataFrame:
    """Rows (reason, ports, immigrant_visits) of the ports of ``resolve_ports`` that no city of ``demography`` has.

    ``visits`` are counted by port; ports without any count with none.
    """
    places = demography.select(F.col("city"), F.col("state_id").alias("us_state_id")).distinct()
    apart = resolved.join(places.withColumn("is_known", F.lit(True)), ["city", "us_state_id"], "left")
    unresolved = F.col("matched_by").isin(NO_STATE, UNKNOWN_STATE)
    reason = F.when(unresolved, F.col("matched_by")).when(F.col("is_known").isNull(), NO_CITY)
    return (
        apart.select("airport_code", reason.alias("reason"))
        .where(F.col("reason").isNotNull())
        .join(visits, "airport_code", "left")
        .groupBy("reason")
        .agg(
            F.count(F.lit(1)).alias("ports"),
            F.coalesce(F.sum("immigrant_visits"), F.lit(0)).alias("immigrant_visits"),
        )
    )


def _folded(text: Column) -> Column:
    return F.upper(F.trim(F.regexp_replace(text, "[ \\t]+", " ")))


def _spellings(code: str, name: str) -> Column:
    return F.array(
        F.struct(_folded(F.col(code)).alias("spelling"), F.lit(False).alias("is_name")),
        F.struct(_folded(F.col(name)).alias("spelling"), F.lit(True).alias("is_name")),
    )
