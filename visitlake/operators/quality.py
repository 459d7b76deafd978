"""Reports on keys, emptiness and references. A report is a small table; nothing is raised here."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlake.functions import unreadable_sas_date
from visitlake.operators.ranking import top_k


def key_report(table: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row (table_name, row_count, key_count, duplicate_keys, is_unique, is_filled).

    NULL counts as a key value like any other. Rows are counted per key first, within each task
    before the shuffle, and the totals come from those counts: one pass over the table.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    return per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("row_count"),
        F.count(F.lit(1)).alias("key_count"),
        F.count_if(F.col("copies") > 1).alias("duplicate_keys"),
    ).select(
        F.lit(table).alias("table_name"),
        "row_count",
        "key_count",
        "duplicate_keys",
        (F.col("duplicate_keys") == 0).alias("is_unique"),
        (F.col("row_count") > 0).alias("is_filled"),
    )


def fill_report(table: str, df: DataFrame) -> DataFrame:
    """The same row for a table without a key: only counted."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(table).alias("table_name"),
        "row_count",
        F.lit(None).cast("bigint").alias("key_count"),
        F.lit(None).cast("bigint").alias("duplicate_keys"),
        F.lit(None).cast("boolean").alias("is_unique"),
        (F.col("row_count") > 0).alias("is_filled"),
    )


def repeated_keys(table: str, df: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    """Rows (table_name, key, copies): the ``k`` keys that occur most often, of those that occur more than once.

    ``key`` names the columns and their values, NULL included; keys of the same number of copies go by that text. Rows are
    counted per key within each task before the shuffle, and each task hands on its own ``k`` at most.
    """
    parts = [F.concat(F.lit(f"{name}="), F.coalesce(F.col(name).cast("string"), F.lit("NULL"))) for name in keys]
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__copies")).where(F.col("__copies") > 1)
    named = counted.select(
        F.lit(table).alias("table_name"), F.concat_ws(", ", *parts).alias("key"), F.col("__copies").alias("copies")
    )
    return top_k(named, [F.desc("copies"), "key"], k)


def union_reports(reports: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def orphan_keys(
    df: DataFrame, references: Mapping[str, tuple[DataFrame, str]]
) -> DataFrame:
    """Rows (column_name, key, row_count): keys of ``df`` that their dimension does not hold.

    All foreign keys are counted in one scan and one shuffle, with partial counts per task, and
    only the distinct keys meet the dimensions and become text. (An anti join would be moved
    below the count when a dimension is small, and would then turn every row's keys into text.)
    A NULL key is listed with a NULL ``key``.
    """
    used = F.array(*[_typed_key(df, name, name) for name in references])
    counted = (
        df.select(F.inline(used))
        .groupBy("column_name", "number", "text")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select("column_name", _key(), "row_count")
    )
    known = reduce(
        DataFrame.union,
        [
            dimension.select(F.inline(F.array(_typed_key(dimension, key, name))))
            for name, (dimension, key) in references.items()
        ],
    )
    known = known.select("column_name", _key()).distinct().withColumn("is_known", F.lit(True))
    return (
        counted.join(known, ["column_name", "key"], "left")
        .where(F.col("is_known").isNull())
        .drop("is_known")
    )


def orphan_report(orphans: DataFrame) -> DataFrame:
    """Totals of ``orphan_keys`` per column: (column_name, orphan_keys, orphan_rows, null_rows)."""
    has_key = F.col("key").isNotNull()
    rows = F.coalesce(F.sum(F.when(has_key, F.col("row_count"))), F.lit(0))
    nulls = F.coalesce(F.sum(F.when(~has_key, F.col("row_count"))), F.lit(0))
    return orphans.groupBy("column_name").agg(
        F.count_if(has_key).alias("orphan_keys"),
        rows.alias("orphan_rows"),
        nulls.alias("null_rows"),
    )


def unreadable_report(raw: DataFrame, day_columns: Sequence[str]) -> DataFrame:
    """One row with the number of day numbers per column that name no date."""
    return raw.agg(*[F.count_if(unreadable_sas_date(name)).alias(name) for name in day_columns])


def _typed_key(df: DataFrame, column: str, name: str) -> Column:
    """A key as text or as a number: 582 and 582.0, or 0.0 and -0.0, are the same key."""
    is_text = df.schema[column].dataType.typeName() == "string"
    number = F.lit(None) if is_text else F.col(column).cast("double") + F.lit(0.0)
    text = F.col(column) if is_text else F.lit(None)
    return F.struct(
        F.lit(name).alias("column_name"),
        number.cast("double").alias("number"),
        text.cast("string").alias("text"),
    )


def _key() -> Column:
    return F.coalesce("text", F.col("number").cast("string")).alias("key")
