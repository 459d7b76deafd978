from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, order: Sequence[str | Column], k: int) -> DataFrame:
    """First k rows by ``order``; each task keeps its own k, and only those are merged."""
    return df.orderBy(*order).limit(k)


def top_k_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], k: int
) -> DataFrame:
    """First k rows of every group.

    Spark cuts each group to k rows per task before the shuffle (WindowGroupLimit), so a group
    that holds a large part of the rows does not arrive whole in one task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("rank_in_group", rank).where(F.col("rank_in_group") <= k).drop(
        "rank_in_group"
    )
