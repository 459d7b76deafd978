"""Raw visit records to the visits table, with their measures, in one scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

from visitlake.fixed import PORT_FIELD, VISIT_FIELDS, VISIT_PARTITION_KINDS, VISIT_PARTITIONS
from visitlake.functions import not_whole, unreadable_sas_date
from visitlake.plans.star import typed_field

COPIES, KEPT, FAULTS, STORED = "__copies", "__kept", "__faults", "__stored"
#: Two hashes of a record as it came; they tell whether a late record is there already.
PRINTS = ["record_print_a", "record_print_b"]
#: Where a visit lies in the table: its folder, and its place within it.
PLACE = [*VISIT_PARTITIONS, *PRINTS]
PLACE_KINDS = [*VISIT_PARTITION_KINDS, "bigint", "bigint"]
SOURCES = [source for source, _, _ in VISIT_FIELDS]
RECORDS, LEFT_OUT, DROPPED = "records", "records of other months", "distinct records not kept"


def fault_columns() -> dict[str, Column]:
    """What is counted of the records: by measure, whether a raw record counts."""
    faults = {}
    for source, name, kind in VISIT_FIELDS:
        if kind == "date":
            faults[f"unreadable {name}"] = unreadable_sas_date(source)
        elif kind == "int":
            faults[f"unreadable {name}"] = not_whole(source)
    faults["blank airport_code"] = F.coalesce(F.col(PORT_FIELD).cast("string") == "", F.lit(False))
    return faults


def distinct_records(
    raw: DataFrame, wanted: Column | None = None, partitions: int | None = None, stored: DataFrame | None = None
) -> DataFrame:
    """Visits of the distinct records, with their prints, and for the measures how many records each stands for,
    whether it is kept and which faults it has (as bits).

    They come dealt as the table has them: by ranges of folder and print, so a folder with very many rows is cut into many
    parts and no range boundary cuts more than one folder. Copies share their place, so the shuffle that deals the records also
    brings the copies together, and no other one moves them.

    Records that are not ``wanted`` are counted within each task first, as one row for each of their faults,
    and so are copies then; what is left of them is dealt afterwards. Not kept are these, and the records that
    ``stored`` has at their place (``PLACE`` columns).
    """
    raw = raw.select(*[_without_negative_zero(raw, name) for name in SOURCES])
    if wanted is not None:
        marked = raw.select(*[F.when(wanted, F.col(name)).alias(name) for name in SOURCES], wanted.alias(KEPT), _faults())
        distinct = marked.groupBy(*SOURCES, KEPT, FAULTS).agg(F.count(F.lit(1)).alias(COPIES))
        return _deal(distinct, partitions, _place()).select(*_table(), *PRINTS, KEPT, FAULTS, COPIES)
    place = _place()
    if stored is not None:
        # A stored visit is a row of its place alone.
        mark = F.col(f"{STORED}.{PLACE[-1]}").isNotNull()
        place = {name: F.when(mark, F.col(f"{STORED}.{name}")).otherwise(value) for name, value in place.items()}
        places = stored.select(F.struct(*[F.col(name).cast(kind).alias(name) for name, kind in zip(PLACE, PLACE_KINDS)]).alias(STORED))
        raw = raw.unionByName(places, allowMissingColumns=True)
    dealt = _deal(raw, partitions, place)
    if stored is None:
        distinct = dealt.groupBy(*PLACE, *SOURCES).agg(F.count(F.lit(1)).alias(COPIES)).withColumn(KEPT, F.lit(True))
    else:
        distinct = dealt.groupBy(*PLACE, *SOURCES, mark.alias(STORED)).agg(F.count(F.lit(1)).alias(COPIES))
        distinct = distinct.withColumn(KEPT, ~F.max(STORED).over(Window.partitionBy(*PLACE))).where(~F.col(STORED))
    return distinct.select(*_table(PLACE), *PRINTS, KEPT, _faults(), COPIES)


def record_prints(raw: DataFrame) -> DataFrame:
    """The two prints of every raw record."""
    rows = raw.select(*[_without_negative_zero(raw, name) for name in SOURCES])
    place = _place()
    return rows.select(*[place[name].alias(name) for name in PRINTS])


def _place() -> dict[str, Column]:
    """The place of a raw record."""
    folders = {name: typed_field(source, kind) for source, name, kind in VISIT_FIELDS if name in VISIT_PARTITIONS}
    # A hash passes over nulls, so which fields are null is hashed too.
    nulls = F.concat(*[F.when(F.col(name).isNull(), "1").otherwise("0") for name in SOURCES])
    prints = {name: F.xxhash64(F.lit(seed), nulls, *SOURCES) for seed, name in enumerate(PRINTS)}
    return {name: folders[name] for name in VISIT_PARTITIONS} | prints


def _deal(rows: DataFrame, partitions: int | None, place: dict[str, Column]) -> DataFrame:
    """Dealt by ranges of their place, which gets columns after the shuffle only."""
    dealt = rows.repartitionByRange(*([] if partitions is None else [partitions]), *place.values())
    return dealt.withColumns(place)


def _table(known: list[str] | tuple = ()) -> list[Column]:
    """The columns of the table out of raw records; those in ``known`` are there already."""
    return [F.col(name) if name in known else typed_field(source, kind).alias(name) for source, name, kind in VISIT_FIELDS]


def _faults() -> Column:
    bits = [F.when(fault, 1 << place).otherwise(0) for place, fault in enumerate(fault_columns().values())]
    return sum(bits[1:], bits[0]).alias(FAULTS)


def _without_negative_zero(df: DataFrame, name: str) -> Column:
    """Records that differ in the sign of a zero are the same, and their hashes must be too."""
    kind = df.schema[name].dataType
    return (F.col(name) + F.lit(0.0).cast(kind)).alias(name) if isinstance(kind, (DoubleType, FloatType)) else F.col(name)


def measure_columns() -> list[Column]:
    """Totals over ``distinct_records``: of all records, of each fault, and of those that are left out, which are
    counted without their copies too."""
    count = {RECORDS: F.lit(True)}
    for place, measure in enumerate(fault_columns()):
        count[measure] = F.col(FAULTS).bitwiseAND(1 << place) != 0
    count[LEFT_OUT] = ~F.col(KEPT)
    totals = [F.coalesce(F.sum(F.when(holds, F.col(COPIES))), F.lit(0)).alias(name) for name, holds in count.items()]
    return [*totals, F.count_if(~F.col(KEPT)).alias(DROPPED)]


def write_distinct(visits: DataFrame, path: str) -> tuple[StructType, dict[str, int]]:
    """Write ``distinct_records`` to a new folder, a folder per year, month and port; returns the schema and the measures.

    They are dealt already, so there are fewer files than folders and partitions together. The measures are taken in the
    tasks that write, each of which counts once however often it has to run.
    """
    measured = Observation()
    rows = visits.observe(measured, *measure_columns()).where(KEPT).drop(KEPT, FAULTS, COPIES)
    rows.write.partitionBy(*VISIT_PARTITIONS).parquet(path)
    return rows.schema, measured.get
