from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from visitlake.fixed import VISIT_FIELDS


def read_raw_visits(spark: SparkSession, *paths: str) -> DataFrame:
    """Visit records: the columns the visits table needs, out of Parquet files that have more."""
    return spark.read.parquet(*paths).select(*[source for source, _, _ in VISIT_FIELDS])
