"""The batch job: read, build, write aside, check, publish."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

from visitlake.fixed import (
    DEMOGRAPHY,
    DIMENSION_KEYS,
    LABEL_SECTIONS,
    MONTH_FIELD,
    PORT_FIELD,
    VISIT_FIELDS,
    VISIT_REFERENCES,
    VISITS,
    YEAR_FIELD,
)
from visitlake.functions import not_whole, unreadable_sas_date, whole_number
from visitlake.operators import label_pairs
from visitlake.operators.labels import label_code_report, load_faults
from visitlake.operators.quality import (
    fill_report,
    key_report,
    orphan_keys,
    orphan_report,
    repeated_keys,
    union_reports,
)
from visitlake.plans.star import build_star, city_demography, immigration_facts
from visitlake.scratch import drop_scratch, via_path
from visitlake.sinks import refresh_month, write_dimension
from visitlake.sinks.records import (
    DROPPED,
    LEFT_OUT,
    PLACE,
    PLACE_KINDS,
    PRINTS,
    RECORDS,
    distinct_records,
    record_prints,
    write_distinct,
)
from visitlake.sources import read_demography, read_raw_visits
from visitlake.sources.demography import bad_city_cells
from visitlake.sources.labels import write_label_lines
from visitlake.versions import Staged, current_version, read_months_of

REPORT = "table_name string, measure string, row_count bigint"
ROWS = "rows"
#: Late records are few where the lake has this many times as many visits in their months.
FEW = 4
#: Faults that an error message lists; it always gives their number.
LISTED = 20


class DataQualityError(ValueError):
    """A table failed its checks; nothing was published."""


#: Gets the report of what a job has written and not yet published; returns what speaks against it.
Audit = Callable[[list[tuple[str, str, int]]], list[str]]


def run(
    spark: SparkSession,
    visits_path: str,
    demography_path: str,
    labels_path: str,
    root: str,
    partitions: int | None = None,
    audit: Audit | None = None,
    rejects: bool = False,
) -> DataFrame:
    """Build the star schema from the three inputs and publish it as the next version of ``root``.

    All tables are written aside, checked as written, and then published in one step: readers see the lake as it
    was before or as a whole. All failures are raised at once, with those that ``audit`` finds in the report, and
    leave nothing behind. The raw visits are read once. The report (table_name, measure, row_count)
    has the rows of each table; for the visits the records, those
    whose dates, year or month could not be read or whose port is empty, and the rows
    whose keys no dimension has. With ``rejects`` also, where there are any, the cells of the cities that do not fit
    their column and the label codes that are no number.
    """
    scratch = [write_label_lines(spark, labels_path)]
    try:
        lines = spark.read.parquet(scratch[0])
        scratch.append(via_path(label_pairs(lines, LABEL_SECTIONS), "label-pairs"))
        pairs = spark.read.parquet(scratch[1])
        raw_visits, raw_cities = read_raw_visits(spark, visits_path), read_demography(spark, demography_path)
        star = build_star(raw_visits, raw_cities, pairs)
        with Staged(spark, root) as staged:
            written = {table: staged.table(star[table], table) for table in DIMENSION_KEYS}
            dimensions = dimension_report(written).collect()
            problems = section_problems(load_faults(lines, LABEL_SECTIONS)), key_problems(dimensions, written)
            if any(problems):  # the visits are not written in vain
                problems = [*problems[0], *visit_problems(0 if raw_visits.isEmpty() else 1), *problems[1]]
                require_passed(problems)
            rows, measures = _stage_records(staged, distinct_records(raw_visits, partitions=partitions), keep=False)
            require_passed(visit_problems(rows))
            measures.pop(LEFT_OUT)
            counts = _visit_rows(rows, measures)
            counts[1:1] = [(row.table_name, ROWS, row.row_count) for row in dimensions]
            for row in orphan_report(star_orphans({**written, VISITS: staged.stored})).collect():
                counts.append((VISITS, f"orphan {row.column_name}", row.orphan_rows))
                counts.append((VISITS, f"empty {row.column_name}", row.null_rows))
            if rejects:
                counts += _rejects(bad_city_cells(spark, demography_path), label_code_report(pairs))
            require_passed(audit(counts) if audit else [])
            staged.publish()
    finally:
        for path in scratch:
            drop_scratch(spark, path)
    return spark.createDataFrame(counts, REPORT)


def load_visits(spark: SparkSession, raw: DataFrame, root: str, partitions: int | None = None) -> DataFrame:
    """Publish the visits of raw records alone; the dimensions stay as they are. Returns their report."""
    with Staged(spark, root) as staged:
        rows, measures = _stage_records(staged, distinct_records(raw, partitions=partitions), keep=False)
        require_passed(visit_problems(rows))
        staged.publish()
    measures.pop(LEFT_OUT)
    return spark.createDataFrame(_visit_rows(rows, measures), REPORT)


def refresh_visits(
    spark: SparkSession,
    visits_path: str,
    root: str,
    year: int,
    month: int,
    partitions: int | None = None,
) -> DataFrame:
    """Replace one month of the visits table by its records in ``visits_path``, as the next version.

    Returns the same report as ``run`` for the visits, with the records of other months, which
    are left out. A month without any record is refused, not emptied. The records are read once.
    """
    raw = read_raw_visits(spark, visits_path)
    if current_version(spark, root) is None:
        return _refresh_in_place(spark, raw, root, year, month, partitions)
    with Staged(spark, root) as staged:
        records = distinct_records(raw, in_month(year, month), partitions)
        rows, measures = _stage_records(staged, records, keep=False, replaced=[(year, month)])
        require_passed(visit_problems(rows))
        staged.publish()
    return spark.createDataFrame(_visit_rows(rows, measures), REPORT)


def append_visits(
    spark: SparkSession, visits_path: str, root: str, partitions: int | None = None
) -> DataFrame:
    """Add late records of any months, less those that the lake has already, as the next version.

    The lake then equals one that was loaded from all records together. Of the visits, only the places (folder and prints)
    in the months of the late records are read. They are dealt together with the late records, in the one shuffle that
    also brings copies together and deals the rows for the write. Where the late records are few, the stored places are cut to
    their prints before, by a semi join; Spark broadcasts those prints or filters by a Bloom filter of them.
    The report counts the rows added, the records read and those already there.
    """
    late = read_raw_visits(spark, visits_path)
    with Staged(spark, root) as staged:
        if staged.base is None:
            raise ValueError(f"{root} has no version to add to")
        months = late.groupBy(whole_number(YEAR_FIELD).alias("year"), whole_number(MONTH_FIELD).alias("month"))
        counted = {(row.year, row.month): row.records for row in months.agg(F.count(F.lit(1)).alias("records")).collect()}
        kinds = ", ".join(f"{name} {kind}" for name, kind in zip(PLACE, PLACE_KINDS))
        stored = read_months_of(spark, root, staged.base, VISITS, _parse_datatype_string(kinds), only=set(counted))
        known = sum(month.visits for month in staged.base.months if (month.year, month.month) in counted)
        if sum(counted.values()) * FEW <= known:
            stored = stored.join(record_prints(late), PRINTS, "left_semi")
        rows, measures = _stage_records(staged, distinct_records(late, partitions=partitions, stored=stored), keep=True)
        if rows:
            staged.publish()
    measures.pop(LEFT_OUT)
    repeated = measures.pop(DROPPED)
    report = [*_visit_rows(rows, measures), (VISITS, "known visits", repeated)]
    return spark.createDataFrame(report, REPORT)


def _stage_records(
    staged: Staged, records: DataFrame, keep: bool, replaced: Sequence[tuple] = ()
) -> tuple[int, dict[str, int]]:
    """Write ``distinct_records`` aside; returns the number of visits and the measures of the records."""
    measures = {}

    def write(path: str):
        schema, found = write_distinct(records, path)
        measures.update(found)
        return schema

    return staged.visits(write, keep, replaced), measures


def _visit_rows(rows: int, measures: dict[str, int]) -> list[tuple[str, str, int]]:
    return [(VISITS, ROWS, rows)] + [(VISITS, name, n) for name, n in measures.items() if name not in (RECORDS, DROPPED)]


def _rejects(city_cells: DataFrame, label_codes: DataFrame) -> list[tuple[str, str, int]]:
    cells = [(DEMOGRAPHY, f"bad cells in {row.column_name}", row.bad_cells) for row in city_cells.collect()]
    return cells + [(row.table_name, "codes that are no number", row.codes) for row in label_codes.collect()]


def _refresh_in_place(
    spark: SparkSession, raw: DataFrame, root: str, year: int, month: int, partitions: int | None
) -> DataFrame:
    """The same for a folder without versions: the month's folder is overwritten."""
    of_month = in_month(year, month)
    records, *measures = raw_report(raw, left_out=~of_month).collect()
    left_out = measures.pop()
    require_passed(visit_problems(records.row_count - left_out.row_count))
    rows = refresh_month(immigration_facts(raw.where(of_month)), root, year, month, partitions)
    report = [(VISITS, ROWS, rows), *map(tuple, measures), tuple(left_out)]
    return spark.createDataFrame(report, REPORT)


def in_month(year: int, month: int) -> Column:
    """Records of a month, by the numbers that the visits table gets."""
    same = (whole_number(YEAR_FIELD) == year) & (whole_number(MONTH_FIELD) == month)
    return F.coalesce(same, F.lit(False))


def raw_report(raw_visits: DataFrame, left_out: Column | None = None) -> DataFrame:
    """Rows (table_name, measure, row_count): records, and those with values that are not kept.

    One pass over five columns. ``left_out`` adds the records for which it holds, in the last row.
    """
    kinds = {source: kind for source, _, kind in VISIT_FIELDS}
    names = {source: name for source, name, _ in VISIT_FIELDS}
    measures = {"records": F.lit(True)}
    for source, kind in kinds.items():
        if kind == "date":
            measures[f"unreadable {names[source]}"] = unreadable_sas_date(source)
        elif kind == "int":
            measures[f"unreadable {names[source]}"] = not_whole(source)
    measures["blank airport_code"] = F.col(PORT_FIELD).cast("string") == ""
    if left_out is not None:
        measures["records of other months"] = left_out
    counted = raw_visits.agg(
        *[F.count_if(holds).alias(measure) for measure, holds in measures.items()]
    )
    rows = [
        F.struct(
            F.lit(VISITS).alias("table_name"),
            F.lit(measure).alias("measure"),
            F.col(measure).alias("row_count"),
        )
        for measure in measures
    ]
    return counted.select(F.inline(F.array(*rows)))


def refresh_demography(spark: SparkSession, demography_path: str, root: str) -> int:
    """Replace the city table; returns the number of cities."""
    cities = city_demography(read_demography(spark, demography_path))
    if current_version(spark, root) is None:
        report = key_report(DEMOGRAPHY, cities, DIMENSION_KEYS[DEMOGRAPHY]).collect()
        require_passed(key_problems(report, {DEMOGRAPHY: cities}))
        write_dimension(cities, root, DEMOGRAPHY)
        return report[0].row_count
    with Staged(spark, root) as staged:
        written = staged.table(cities, DEMOGRAPHY)
        report = key_report(DEMOGRAPHY, written, DIMENSION_KEYS[DEMOGRAPHY]).collect()
        require_passed(key_problems(report, {DEMOGRAPHY: written}))
        staged.publish()
    return report[0].row_count


def dimension_report(star: dict[str, DataFrame]) -> DataFrame:
    """One key report row per dimension."""
    return union_reports(
        [key_report(table, star[table], keys) for table, keys in DIMENSION_KEYS.items()]
    )


def star_report(star: dict[str, DataFrame]) -> DataFrame:
    """``dimension_report`` plus the count of the visits table."""
    return union_reports([fill_report(VISITS, star[VISITS]), dimension_report(star)])


def star_orphans(star: dict[str, DataFrame]) -> DataFrame:
    """Foreign keys of the visits table that no dimension row has."""
    return orphan_keys(
        star[VISITS],
        {column: (star[table], key) for column, (table, key) in VISIT_REFERENCES.items()},
    )


def row_counts(star: dict[str, DataFrame]) -> DataFrame:
    reports = [fill_report(table, df) for table, df in star.items()]
    return union_reports(reports).select("table_name", "row_count")


def require_passed(problems: list[str]) -> None:
    if problems:
        raise DataQualityError("data quality check not passed: " + "; ".join(problems))


def key_problems(report: list, tables: dict[str, DataFrame]) -> list[str]:
    """Tables that are empty or repeat a key, from a fetched report with one row per table; with the keys that are
    repeated most, which are looked up only in a table that fails."""
    problems = []
    for row in report:
        if not row.is_filled or row.is_unique is False:
            problem = f"{row.table_name}: {row.row_count} rows, {row.duplicate_keys} keys more than once"
            keys = DIMENSION_KEYS[row.table_name]
            if row.duplicate_keys:
                found = repeated_keys(row.table_name, tables[row.table_name], keys, LISTED).collect()
                problem += " (" + ", ".join(f"{one.key}: {one.copies} times" for one in found) + ")"
            problems.append(problem)
    return problems


def visit_problems(records: int) -> list[str]:
    """Records stay or go as a whole, so their number tells whether there are visits."""
    return [] if records else [f"{VISITS}: 0 rows"]


def section_problems(faults: DataFrame) -> list[str]:
    """Label sections that are missing or open: how many, and the first of them."""
    number = faults.count()
    shown = faults.orderBy("source", "section").limit(LISTED).collect() if number else []
    listed = [f"{row.source or 'all label files'}: {row.section}: {row.fault}" for row in shown]
    more = [f"{number - LISTED} more label faults"] if number > LISTED else []
    return listed + more
