"""A lake whose tables change together: written aside first, then published in one step.

A write goes to folders of its own (``write=<id>``), which no reader knows. Publishing adds one small
file, ``_versions/<number>.json``, that lists the folders of every table and the months of the visits with
their numbers of rows. Readers take the last complete version, so they see the lake before a write or after it,
never half of it, and a job that dies leaves at most folders that no version lists (``vacuum`` removes them).
Of two writers that started from one version, the later one fails and changes nothing.

The file is small: a row per table, and per month a row with one folder for every write that the month consists of.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from visitlake.fixed import VISIT_COUNTS, VISIT_PARTITIONS, VISITS
from visitlake.scratch import file_system, hadoop_path, join_path

VERSIONS = "_versions"
WRITE = "write"
#: How Spark names the folder of a NULL.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


class PublishConflict(RuntimeError):
    """Another writer has published since this one looked at the lake; nothing was changed."""


@dataclass(frozen=True)
class Month:
    year: int | None
    month: int | None
    visits: int
    writes: tuple[str, ...]

    def folders(self) -> list[str]:
        """Of this month in each write, below the table; visits and their counts have the same."""
        names = [f"{name}={NULL_FOLDER if value is None else value}" for name, value in self._values()]
        return [join_path(write, "/".join(names)) for write in self.writes]

    def _values(self) -> list[tuple[str, int | None]]:
        return list(zip(VISIT_PARTITIONS, (self.year, self.month)))


@dataclass(frozen=True)
class Version:
    """What a reader sees: the folder of each dimension, the months of the visits, and the stored types."""

    number: int = 0
    tables: dict[str, str] = field(default_factory=dict)
    months: tuple[Month, ...] = ()
    schema: StructType | None = None

    def with_table(self, table: str, write: str) -> Version:
        return replace(self, tables={**self.tables, table: write})

    def with_months(self, new: Iterable[Month], schema: StructType, keep: bool) -> Version:
        """With months added to what there is (``keep``) or in place of what they replace."""
        known = {(month.year, month.month): month for month in self.months}
        for month in new:
            before = known.pop((month.year, month.month), None)
            if keep and before is not None:
                month = replace(month, visits=before.visits + month.visits, writes=before.writes + month.writes)
            if month.visits:
                known[month.year, month.month] = month
        return replace(self, months=tuple(known.values()), schema=schema)

    def writes(self) -> set[str]:
        """Folders below the lake that this version needs."""
        used = {join_path(table, write) for table, write in self.tables.items()}
        for month in self.months:
            used |= {join_path(table, write) for table in (VISITS, VISIT_COUNTS) for write in month.writes}
        return used

    def to_json(self) -> str:
        months = [[month.year, month.month, month.visits, list(month.writes)] for month in self.months]
        schema = None if self.schema is None else self.schema.jsonValue()
        return json.dumps({"tables": self.tables, "months": months, "schema": schema})

    @staticmethod
    def from_json(number: int, text: str) -> Version:
        stored = json.loads(text)
        months = tuple(Month(year, month, visits, tuple(writes)) for year, month, visits, writes in stored["months"])
        schema = stored["schema"] and StructType.fromJson(stored["schema"])
        return Version(number, stored["tables"], months, schema)


# --- versions ---------------------------------------------------------------------------------


def current_version(spark: SparkSession, root: str) -> Version | None:
    """The last complete version of a lake; None for a folder without any."""
    for number in sorted(_numbers(spark, root), reverse=True):
        version = _read(spark, root, number)
        if version is not None:
            return version
    return None


def publish(spark: SparkSession, root: str, version: Version, base: Version | None) -> Version:
    """Make ``version`` what readers see, if ``base`` still is.

    The file is created, never replaced, under a number that no other file has. One that was cut off
    while it was written is no version to anybody and keeps its number.
    """
    latest = current_version(spark, root)
    if (latest and latest.number) != (base and base.number):
        raise PublishConflict(f"{root} has been changed by another writer")
    number = max(_numbers(spark, root), default=0) + 1
    path = _version_path(spark, root, number)
    try:
        out = file_system(spark, path).create(path, False)
    except Exception as error:
        raise PublishConflict(f"{root} has been changed by another writer") from error
    try:
        out.write(bytearray(version.to_json().encode()))
    finally:
        out.close()
    return replace(version, number=number)


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove the folders that none of the last ``keep`` versions needs, and older versions.

    Only while nobody writes to the lake or reads an older version. Returns the removed folders.
    """
    numbers = [n for n in sorted(_numbers(spark, root), reverse=True) if _read(spark, root, n) is not None]
    kept = [_read(spark, root, number) for number in numbers[: max(keep, 1)]]
    if not kept:
        return []
    used = set().union(*[version.writes() for version in kept])
    root_path = hadoop_path(spark, root)
    system = file_system(spark, root_path)
    removed = []
    for table in system.listStatus(root_path):
        if not table.isDirectory() or table.getPath().getName() == VERSIONS:
            continue
        for write in system.listStatus(table.getPath()):
            name = join_path(table.getPath().getName(), write.getPath().getName())
            if write.getPath().getName().startswith(f"{WRITE}=") and name not in used:
                system.delete(write.getPath(), True)
                removed.append(name)
    for number in _numbers(spark, root):
        if number < kept[-1].number:
            system.delete(_version_path(spark, root, number), False)
    return sorted(removed)


def _numbers(spark: SparkSession, root: str) -> list[int]:
    folder = hadoop_path(spark, join_path(root, VERSIONS))
    system = file_system(spark, folder)
    if not system.exists(folder):
        return []
    names = [status.getPath().getName() for status in system.listStatus(folder)]
    return [int(found[1]) for name in names if (found := re.fullmatch(r"(\d+)\.json", name))]


def _version_path(spark: SparkSession, root: str, number: int):
    return hadoop_path(spark, f"{join_path(root, VERSIONS)}/{number:012d}.json")


def _read(spark: SparkSession, root: str, number: int) -> Version | None:
    path = _version_path(spark, root, number)
    stream = file_system(spark, path).open(path)
    try:
        text = bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
    try:
        return Version.from_json(number, text)
    except ValueError:
        return None


# --- staged writes ------------------------------------------------------------------------------


class Staged:
    """Folders that a job has written and no version lists yet.

    Leave the ``with`` block without ``publish`` and they are removed again.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.base = current_version(spark, root)
        self.version = self.base or Version()
        self.write = f"{WRITE}={uuid.uuid4().hex}"
        self.written: list[str] = []

    def __enter__(self) -> Staged:
        return self

    def __exit__(self, *error) -> None:
        self.drop()

    def table(self, df: DataFrame, table: str) -> DataFrame:
        """Write a table aside; returns it as it will be read."""
        path = self._new(table)
        df.write.parquet(path)
        self.version = self.version.with_table(table, self.write)
        return self.spark.read.schema(df.schema).parquet(path)

    def visits(self, write: Callable[[str], StructType], keep: bool, replaced: Iterable[tuple] = ()) -> int:
        """Write visits aside with their counts; returns how many there are. ``stored`` then has them.

        ``write`` gets a folder, writes visits partitioned by year, month and port to it, and returns their
        schema. They are added to what the version has (``keep``), or replace their own
        months and those (year, month) in ``replaced``.
        """
        path = self._new(VISITS)
        schema = write(path)
        data = [one for one in schema.fields if one.name not in VISIT_PARTITIONS]
        folders = [one for name in VISIT_PARTITIONS for one in schema.fields if one.name == name]
        self.stored = stored = self.spark.read.schema(StructType([*data, *folders])).parquet(path)
        counted_path = self._new(VISIT_COUNTS)
        _count(stored).write.partitionBy(*VISIT_PARTITIONS[:2]).parquet(counted_path)
        counts = self.spark.read.schema(COUNTS_SCHEMA).parquet(counted_path)
        months = counts.groupBy(*VISIT_PARTITIONS[:2]).agg(F.sum("immigrant_visits").alias("visits"))
        new = [Month(row.year, row.month, row.visits, (self.write,)) for row in months.collect()]
        emptied = [Month(year, month, 0, ()) for year, month in replaced]
        if not keep and not emptied:
            self.version = replace(self.version, months=())
        self.version = self.version.with_months([*emptied, *new], stored.schema, keep)
        return sum(month.visits for month in new)

    def publish(self) -> Version:
        version = publish(self.spark, self.root, self.version, self.base)
        self.written = []
        return version

    def drop(self) -> None:
        """Remove what is not published, and the lake's folder if there is nothing else in it."""
        for path in map(lambda written: hadoop_path(self.spark, written), self.written):
            system = file_system(self.spark, path)
            system.delete(path, True)
            for folder in (path.getParent(), path.getParent().getParent()):
                if system.exists(folder) and not system.listStatus(folder):
                    system.delete(folder, False)
        self.written = []

    def _new(self, table: str) -> str:
        path = join_path(join_path(self.root, table), self.write)
        self.written.append(path)
        return path


def read_table(spark: SparkSession, root: str, version: Version, table: str) -> DataFrame:
    return spark.read.parquet(join_path(join_path(root, table), version.tables[table]))


def read_months_of(
    spark: SparkSession, root: str, version: Version, table: str, schema: StructType, only: set | None = None
) -> DataFrame:
    """The visits or their counts of a version, of all months or only some (year, month)."""
    months = [month for month in version.months if only is None or (month.year, month.month) in only]
    folders = [join_path(join_path(root, table), folder) for month in months for folder in month.folders()]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", join_path(root, table)).parquet(*folders)


COUNTS_SCHEMA = "airport_code string, citizen_country_id double, immigrant_visits bigint, year int, month int"


def _count(visits: DataFrame) -> DataFrame:
    """Visits by month, port and nationality: one data column is read, and counted within each task first."""
    keys = [*VISIT_PARTITIONS, "citizen_country_id"]
    if "citizen_country_id" not in visits.columns:
        visits = visits.withColumn("citizen_country_id", F.lit(None))
    visits = visits.withColumn("citizen_country_id", F.col("citizen_country_id").cast("double"))
    counted = visits.groupBy(*keys).agg(F.count(F.lit(1)).alias("immigrant_visits"))
    # A month's counts in few files, and all months not in one task.
    return counted.repartition(*VISIT_PARTITIONS[:2])
