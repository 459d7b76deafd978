from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlake.scratch import via_path


def write_label_lines(spark: SparkSession, *paths: str) -> str:
    """Lines of label files as (source, position, line) in a scratch table; returns where.

    A file may be split over many tasks. The start of the split and the running row number in
    the task order its lines. These numbers depend on how the files were packed into tasks, and
    the section operators look at the lines more than once, so the lines are written once.
    """
    position = F.struct(
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    lines = spark.read.text(list(paths)).select(
        F.col("_metadata.file_path").alias("source"),
        position.alias("position"),
        F.col("value").alias("line"),
    )
    return via_path(lines, "label-lines")


def read_label_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """Lines of label files as (source, position, line)."""
    return spark.read.parquet(write_label_lines(spark, *paths))
