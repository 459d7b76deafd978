"""Code-to-name pairs out of label text.

Label text is given as one row per line: ``source`` (which text), ``position`` (any sortable
value that orders the lines of a text) and ``line``. A text is never gathered into one row or
one task: the few lines that hold a section name or a semicolon give the bounds of the sections, and
the lines are then matched with the bounds of their own text.

A section starts at the first place in the text where its name stands, and ends at the next
semicolon. Inside it, a line with exactly one ``=`` is a pair.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitlake.fixed import NUMBERED_SECTIONS
from visitlake.functions import label_id, strip_label

END = ";"
EQUALS = "="
NOT_FOUND, NOT_CLOSED = "section not found", "section not closed"


def label_pairs(lines: DataFrame, sections: Sequence[str]) -> DataFrame:
    """Rows (source, section, position, code, name) of the named sections.

    A section that is missing or not closed gives no rows here; ``section_faults`` lists it.
    """
    bounds = _bounds(lines, sections).where(F.col("last").isNotNull())
    inside = lines.where(F.contains("line", F.lit(EQUALS))).join(bounds, "source").where(
        F.col("position").between(F.col("first"), F.col("last"))
    )
    from_name = F.when(
        F.col("position") == F.col("first"), F.substr("line", F.col("offset"))
    ).otherwise(F.col("line"))
    to_end = F.when(
        F.col("position") == F.col("last"), F.substring_index(from_name, END, 1)
    ).otherwise(from_name)
    return (
        inside.withColumn("parts", F.split(to_end, EQUALS))
        .where(F.size("parts") == 2)
        .select(
            "source",
            "section",
            "position",
            strip_label(F.get("parts", F.lit(0))).alias("code"),
            strip_label(F.get("parts", F.lit(1))).alias("name"),
        )
    )


def section_faults(lines: DataFrame, sections: Sequence[str]) -> DataFrame:
    """Rows (source, section, fault) for every text that lacks a section or does not close it."""
    wanted = (
        lines.select("source")
        .distinct()
        .withColumn("section", F.explode(F.array(*[F.lit(name) for name in sections])))
    )
    fault = F.when(F.col("first").isNull(), NOT_FOUND).when(F.col("last").isNull(), NOT_CLOSED)
    return (
        wanted.join(_bounds(lines, sections), ["source", "section"], "left")
        .select("source", "section", fault.alias("fault"))
        .where(F.col("fault").isNotNull())
    )


def load_faults(lines: DataFrame, sections: Sequence[str]) -> DataFrame:
    """Rows (source, section, fault) for texts that make up one load: a section may stand in any of
    them, but each must be found once and be closed where it is found. A NULL source is all texts."""
    bounds = _bounds(lines, sections)
    wanted = lines.sparkSession.createDataFrame([(name,) for name in sections], "section string")
    missing = wanted.join(bounds, "section", "left_anti").select(
        F.lit(None).cast("string").alias("source"), "section", F.lit(NOT_FOUND).alias("fault")
    )
    still_open = bounds.where(F.col("last").isNull()).select(
        F.col("source").cast("string").alias("source"), "section", F.lit(NOT_CLOSED).alias("fault")
    )
    return missing.unionByName(still_open)


def label_rejects(pairs: DataFrame) -> DataFrame:
    """Rows (table_name, section, source, position, code, name): pairs whose code should be a number and is none.

    Their key in the table is NULL.
    """
    table = F.coalesce(*[F.when(F.col("section") == name, table) for name, table in NUMBERED_SECTIONS.items()])
    return pairs.where(F.col("section").isin(*NUMBERED_SECTIONS) & label_id("code").isNull()).select(
        table.alias("table_name"), "section", "source", "position", "code", "name"
    )


def label_code_report(pairs: DataFrame) -> DataFrame:
    """Rows (table_name, codes): number of codes that are no number, for the tables that have any."""
    return label_rejects(pairs).groupBy("table_name").agg(F.count(F.lit(1)).alias("codes"))


def _bounds(lines: DataFrame, sections: Sequence[str]) -> DataFrame:
    """Per text and section: first line, offset of the name in it, last line (NULL if open).

    One scan keeps the lines with a name or an end. In the order of their text, each learns where the
    next end after it stands; the first line of a section then gives both bounds.
    """
    has_name = [F.contains("line", F.lit(name)) for name in sections]
    has_end = F.contains("line", F.lit(END))
    following = (
        Window.partitionBy("source").orderBy("position").rowsBetween(1, Window.unboundedFollowing)
    )
    offset = F.position("section", "line")
    return (
        lines.where(reduce(or_, [*has_name, has_end]))
        .withColumn(
            "next_end",
            F.first(F.when(has_end, F.col("position")), ignorenulls=True).over(following),
        )
        .withColumn(
            "section",
            F.explode(F.array(*[F.when(found, F.lit(name)) for found, name in zip(has_name, sections)])),
        )
        .where(F.col("section").isNotNull())
        .groupBy("source", "section")
        .agg(
            F.min(
                F.struct(
                    "position",
                    offset.alias("offset"),
                    (F.position(F.lit(END), "line", offset) > 0).alias("closed_on_first"),
                    "next_end",
                )
            ).alias("start")
        )
        .select(
            "source",
            "section",
            F.col("start.position").alias("first"),
            "start.offset",
            F.when(F.col("start.closed_on_first"), F.col("start.position"))
            .otherwise(F.col("start.next_end"))
            .alias("last"),
        )
    )
