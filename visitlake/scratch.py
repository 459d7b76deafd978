"""Shared folders for checkpoints and tables that a job needs for a while.

They lie in ``spark.checkpoint.dir``, or in the warehouse folder of a session that does not name
one: both are folders that the driver and all executors see.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
WAREHOUSE_DIR = "spark.sql.warehouse.dir"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the session, which becomes its checkpoint folder if it has none."""
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if folder is None:
        folder = join_path(spark.conf.get(WAREHOUSE_DIR), "_scratch")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def new_scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no earlier call has handed out; it goes with the session."""
    path = join_path(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")
    hadoop = hadoop_path(spark, path)
    file_system(spark, hadoop).deleteOnExit(hadoop)
    return path


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Remove what was written below a path that ``new_scratch_path`` has handed out."""
    hadoop = hadoop_path(spark, path)
    file_system(spark, hadoop).delete(hadoop, True)


def via_path(df: DataFrame, name: str) -> str:
    """Write ``df`` to a scratch table; returns where."""
    path = new_scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return path


def via_table(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, written to a scratch table once and read from there.

    It cuts the lineage with files that outlive a lost executor, and gives the planner the
    measured size of the table, by which it decides whether a join may broadcast it.
    """
    path = via_path(df, name)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.scratch_path = path
    return table


def release(*tables: DataFrame) -> None:
    """Remove tables of ``via_table`` from which everything has been computed and written."""
    for table in tables:
        drop_scratch(table.sparkSession, table.scratch_path)


def join_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def hadoop_path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path):
    """The file system that a path of ``hadoop_path`` lies in."""
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
