from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlake.fixed import DEMOGRAPHY_SCHEMA

SEPARATOR = ";"
BAD_LINE = "_bad_line"


def read_demography(spark: SparkSession, path: str) -> DataFrame:
    """Rows of ``;``-separated city files, one per city and race.

    Columns go by position. A further field in a row is dropped, and a cell that is empty or
    does not fit its type becomes NULL while the rest of the row stays.
    """
    return spark.read.csv(path, sep=SEPARATOR, header=True, schema=DEMOGRAPHY_SCHEMA, mode="PERMISSIVE")


def bad_city_cells(spark: SparkSession, path: str) -> DataFrame:
    """Rows (column_name, bad_cells): cells that hold something and do not fit the type of their column.

    The reader keeps the text of every line that it could not read whole. Such a line is split again, as text, and
    a cell is bad if it has text and no value.
    """
    typed = spark.read.csv(
        path,
        sep=SEPARATOR,
        header=True,
        schema=f"{DEMOGRAPHY_SCHEMA}, {BAD_LINE} string",
        mode="PERMISSIVE",
        columnNameOfCorruptRecord=BAD_LINE,
    )
    names = [name for name in typed.columns if name != BAD_LINE]
    as_text = ", ".join(f"{name} string" for name in names)
    cells = F.from_csv(F.col(BAD_LINE), as_text, {"sep": SEPARATOR, "mode": "PERMISSIVE"}).alias("cells")
    split = typed.where(F.col(BAD_LINE).isNotNull()).select(*names, cells)
    bad = [
        F.struct(F.lit(name).alias("column_name"), (F.col(name).isNull() & (F.col(f"cells.{name}") != "")).alias("bad"))
        for name in names
    ]
    listed = split.select(F.inline(F.array(*bad))).where("bad")
    return listed.groupBy("column_name").agg(F.count(F.lit(1)).alias("bad_cells"))
