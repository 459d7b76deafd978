from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from visitlake.fixed import (
    DIMENSION_KEYS,
    VISIT_COUNTS,
    VISIT_FIELDS,
    VISIT_MONTHS,
    VISIT_PARTITION_KINDS,
    VISIT_PARTITIONS,
    VISITS,
)
from visitlake.scratch import join_path
from visitlake.versions import COUNTS_SCHEMA, Version, current_version, read_months_of, read_table


def read_visits(spark: SparkSession, root: str, version: Version | None = None) -> DataFrame:
    """Visits table of a lake, with the types its files have; of its last version unless given.

    The types of the folder columns are given, so port codes made of digits stay text. All
    columns come out in the order of the table, the folder columns not at the end. A folder without versions
    is read as ``write_visits`` leaves it.
    """
    version = version or current_version(spark, root)
    table = _plain_visits(spark, root) if version is None else read_months_of(spark, root, version, VISITS, version.schema)
    return table.select(*[name for _, name, _ in VISIT_FIELDS if name in table.columns])


def _plain_visits(spark: SparkSession, root: str) -> DataFrame:
    path = join_path(root, VISITS)
    kinds = dict(zip(VISIT_PARTITIONS, VISIT_PARTITION_KINDS))
    stored = spark.read.parquet(path).schema.fields
    data = [field for field in stored if field.name not in kinds]
    folders = [StructField(name, _parse_datatype_string(kind)) for name, kind in kinds.items()]
    return spark.read.schema(StructType([*data, *folders])).parquet(path)


def read_months(spark: SparkSession, root: str, version: Version | None = None) -> DataFrame:
    """Rows (year, month, visits), one per month of the visits table."""
    version = version or current_version(spark, root)
    if version is None:
        return spark.read.parquet(join_path(root, VISIT_MONTHS))
    rows = [(month.year, month.month, month.visits) for month in version.months]
    return spark.createDataFrame(rows, "year int, month int, visits bigint")


def read_counts(spark: SparkSession, root: str, version: Version | None = None) -> DataFrame:
    """Rows (year, month, airport_code, citizen_country_id, immigrant_visits): the visits, already counted.

    The questions take it in place of the visits. A key may have several rows, one per write of its month.
    """
    version = version or current_version(spark, root)
    if version is None:
        raise ValueError(f"{root} has no version, and so no counts")
    counts = read_months_of(spark, root, version, VISIT_COUNTS, _parse_datatype_string(COUNTS_SCHEMA))
    return counts.select("year", "month", "airport_code", "citizen_country_id", "immigrant_visits")


def read_dimension(spark: SparkSession, root: str, table: str, version: Version | None = None) -> DataFrame:
    version = version or current_version(spark, root)
    if version is None:
        return spark.read.parquet(join_path(root, table))
    return read_table(spark, root, version, table)


def read_star(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All tables of a lake by name, all of the same version."""
    version = current_version(spark, root)
    star = {table: read_dimension(spark, root, table, version) for table in DIMENSION_KEYS}
    return {VISITS: read_visits(spark, root, version), **star}


def register_views(star: dict[str, DataFrame]) -> None:
    """Make every table known to SQL under its own name."""
    for table, df in star.items():
        df.createOrReplaceTempView(table)
