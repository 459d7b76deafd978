from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Give the columns new names by position, in one projection.

    Swapped names are safe, because the old names are not looked up one after the other.
    """
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    return df.toDF(*names)
