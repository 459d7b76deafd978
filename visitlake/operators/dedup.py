from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the smallest by ``order``, then by all remaining columns in turn.

    The order is total over the kept columns, so the pick does not depend on how the data is
    partitioned. Every task reduces its rows to one per key before the shuffle, so a key that
    holds a large part of the rows sends one row per task. NULLs sort first.
    """
    rest = [name for name in df.columns if name not in keys and name not in order]
    ordered = [*order, *rest]
    picked = df.groupBy(*keys).agg(F.min(F.struct(*ordered)).alias("picked"))
    return picked.select(
        *[F.col(name) if name in keys else F.col(f"picked.{name}") for name in df.columns]
    )
