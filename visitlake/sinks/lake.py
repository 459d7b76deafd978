from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from visitlake.fixed import VISIT_MONTHS, VISIT_PARTITIONS, VISITS
from visitlake.scratch import drop_scratch, join_path, via_path


def write_visits(visits: DataFrame, root: str, partitions: int | None = None) -> int:
    """Replace the visits table, one folder per year, month and port; returns the row count.

    Rows are dealt by ranges of folder and row hash: a range boundary cuts one folder at most, so
    there are fewer files than folders and partitions together, for any number of either,
    and a folder with very many rows is cut into many files. ``partitions`` is the session's
    number of shuffle partitions unless given; small neighbours are merged. The table of months is written
    too.
    """
    rows = _write(visits, VISIT_PARTITIONS, partitions, join_path(root, VISITS))
    _write_months(count_months(visits.sparkSession, root), root)
    return rows


def write_dimension(dimension: DataFrame, root: str, table: str) -> None:
    dimension.write.mode("overwrite").parquet(join_path(root, table))


def refresh_month(
    visits: DataFrame, root: str, year: int, month: int, partitions: int | None = None
) -> int:
    """Replace one month of the visits table by the rows of that month in ``visits``.

    Returns the row count of the new month.

    The whole month folder is overwritten, so a port without new rows loses its old ones. Other
    months are not touched. ``visits`` must not read the table it replaces. If the job is cut
    off, run it again: neither the month nor the table of months depends on what the first run left.
    """
    spark = visits.sparkSession
    this_month = visits.where((F.col("year") == year) & (F.col("month") == month))
    folder = f"{join_path(root, VISITS)}/year={year}/month={month}"
    rows = _write(this_month.drop("year", "month"), ["airport_code"], partitions, folder)
    others = spark.read.parquet(join_path(root, VISIT_MONTHS)).where(
        ~(F.col("year").eqNullSafe(year) & F.col("month").eqNullSafe(month))
    )
    own = spark.createDataFrame([(year, month, rows)] if rows else [], others.schema)
    _write_months(others.unionByName(own), root)
    return rows


def count_months(spark: SparkSession, root: str) -> DataFrame:
    """Rows (year, month, visits) of the written visits: no data column is read."""
    names = VISIT_PARTITIONS[:2]
    table = spark.read.schema(", ".join(f"{name} int" for name in names)).parquet(
        join_path(root, VISITS)
    )
    return table.groupBy(*names).agg(F.count(F.lit(1)).alias("visits"))


def _write_months(months: DataFrame, root: str) -> None:
    """Replace the table of months, which may be read for it: the new one is complete before."""
    spark = months.sparkSession
    path = via_path(months, "months")
    spark.read.schema(months.schema).parquet(path).coalesce(1).write.mode("overwrite").parquet(
        join_path(root, VISIT_MONTHS)
    )
    drop_scratch(spark, path)


def _write(df: DataFrame, columns: list[str], partitions: int | None, folder: str) -> int:
    """Write and count in one pass.

    The rows are counted above the last shuffle, in the tasks that write them. Such a task
    counts once even if it has to run again.
    """
    written = Observation()
    place = [*[F.col(name) for name in columns], F.xxhash64(*df.columns)]
    ranged = df.repartitionByRange(*([] if partitions is None else [partitions]), *place)
    counted = ranged.observe(written, F.count(F.lit(1)).alias("rows"))
    # Static, whatever the session says: dynamic overwrite would leave folders without new rows.
    counted.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
        *columns
    ).parquet(folder)
    return written.get["rows"]
