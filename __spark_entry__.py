"""

Every query reads the given tables whole. ``visitlake.fixtures`` derives visit records, dimensions
and label text from them; the SQL below derives the same data on its own.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlake import fixtures as fx
from visitlake.fixed import (
    COUNTRIES,
    COUNTRY_SECTION,
    DEMOGRAPHY,
    MODE_SECTION,
    MODES,
    PORT_SECTION,
    PORTS,
    STATE_SECTION,
    STATES,
    VISA_SECTION,
    VISAS,
    VISIT_FIELDS,
    VISITS,
)
from visitlake.functions import port_city, port_state, sas_date
from visitlake.operators import first_per_key, label_pairs, ports, rename_positional, section_faults
from visitlake.operators.labels import label_rejects
from visitlake.operators.quality import (
    fill_report,
    key_report,
    orphan_keys,
    orphan_report,
    repeated_keys,
    union_reports,
    unreadable_report,
)
from visitlake.plans import analytics, star
from visitlake.plans.pipeline import (
    append_visits,
    load_visits,
    refresh_demography,
    refresh_visits,
    row_counts,
    run,
    star_report,
)
from visitlake.scratch import new_scratch_path
from visitlake.sinks import write_dimension
from visitlake.sources import (
    read_counts,
    read_demography,
    read_dimension,
    read_label_lines,
    read_months,
    read_raw_visits,
    read_visits,
    register_views,
)
from visitlake.sources.demography import bad_city_cells

Query = Callable[[SparkSession, str], DataFrame]

#: The training-data operators are a part of their own, which may be absent or lack what it needs.
try:
    import corpus_pipeline
    from visitlake.llm import queries as llm_queries
except ImportError:
    corpus_pipeline = llm_queries = None

SMOKE_DIR = "/root/testdata/sf0.001"
PORT = "P7"
MONTH = 4
REFRESHED = (1997, 4)
LAKE_PORT = "8"


def entry(spark: SparkSession) -> DataFrame:
    """Visits table from raw records, and the most frequent nationalities at one port."""
    visits = star.immigration_facts(fx.raw_visits(spark, SMOKE_DIR))
    return analytics.top_countries(visits, fx.countries(spark, SMOKE_DIR), PORT, k=10)


# --- scans, projections, the visits table ---------------------------------------------------


def scan_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey"), F.col("l_suppkey").alias("port"), "l_shipdate"
    )


def raw_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_scratch_path(spark, "raw-visits")
    wider = fx.raw_visits(spark, sf_dir).withColumn("matflag", F.lit("M"))
    wider.write.parquet(path)
    return read_raw_visits(spark, path)


def rename_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fx.raw_visits(spark, sf_dir).select(*[source for source, _, _ in VISIT_FIELDS])
    return rename_positional(raw, [name for _, name, _ in VISIT_FIELDS])


def raw_with_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw visits, those of the higher travel modes three times."""
    copies = F.when(F.col("i94mode") > 3, 3).otherwise(1)
    return (
        fx.raw_visits(spark, sf_dir)
        .withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
        .drop("copy")
    )


def fact_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_with_copies(spark, sf_dir).distinct()


def fact_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.immigration_facts(raw_with_copies(spark, sf_dir))


def sas_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = (F.col("l_quantity") - 25) * 1.3
    return fx.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_quantity",
        sas_date(F.datediff(F.col("l_shipdate").cast("date"), F.lit("1960-01-01"))).alias("shipped"),
        sas_date(scaled).alias("scaled"),
    )


def city_upper(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.table(spark, sf_dir, "part").select("p_partkey", F.upper("p_name").alias("city"))


def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.table(spark, sf_dir, "orders").orderBy("o_orderkey").limit(5).select(
        "o_orderkey", "o_custkey", "o_orderpriority"
    )


# --- labels ----------------------------------------------------------------------------------


def part_label_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One label text per brand; every thirteenth size has a line with two equal signs."""
    parts = fx.table(spark, sf_dir, "part")
    name = F.when(F.col("p_size") % 13 == 0, F.concat("p_name", F.lit(" = "), "p_type")).otherwise(
        fx.part_names(parts)
    )
    line = fx.quoted_pair(F.col("p_partkey"), name)
    return fx.label_lines(
        parts, F.col("p_brand"), F.col("p_partkey"), line, f"  value {PORT_SECTION}"
    )


def labels_of_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = part_label_lines(spark, sf_dir)
    return label_pairs(lines, [PORT_SECTION]).select("source", "section", "code", "name")


def label_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The section job over text files: a file per size and ten million keys."""
    parts = fx.table(spark, sf_dir, "part")
    file_no = F.col("p_size").cast("bigint") * 1000000 + F.floor(F.col("p_partkey") / 10000000)
    lines = fx.label_lines(
        parts.withColumn("file_no", file_no),
        F.col("file_no"),
        F.col("p_partkey"),
        fx.quoted_pair(F.col("p_partkey"), fx.part_names(parts)),
        f"  value {PORT_SECTION}",
    )
    path = new_scratch_path(spark, "labels")
    (
        lines.repartition("source")
        .sortWithinPartitions("source", "position")
        .select("source", "line")
        .write.partitionBy("source")
        .text(path)
    )
    return label_pairs(read_label_lines(spark, path), [PORT_SECTION]).select(
        "section", "code", "name"
    )


def label_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return section_faults(part_label_lines(spark, sf_dir), [PORT_SECTION, MODE_SECTION])


def visa_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Section in a comment without a semicolon of its own, one text per nation."""
    suppliers = fx.table(spark, sf_dir, "supplier")
    line = F.concat(F.lit("   "), F.col("s_suppkey").cast("string"), F.lit(" = "), "s_name")
    lines = fx.label_lines(
        suppliers,
        F.col("s_nationkey").cast("string"),
        F.col("s_suppkey"),
        line,
        f"/* {VISA_SECTION} - codes collapsed into:",
    )
    return star.visa_categories(label_pairs(lines, [VISA_SECTION]))


def mode_label_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = fx.table(spark, sf_dir, "part")
    key = F.col("p_partkey").cast("string")
    code = F.when(F.col("p_size") % 5 == 0, F.concat(F.lit("X"), key)).otherwise(key)
    return fx.label_lines(
        parts,
        F.col("p_brand"),
        F.col("p_partkey"),
        fx.quoted_pair(code, F.col("p_name")),
        f"value {MODE_SECTION}",
    )


def mode_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.travel_modes(label_pairs(mode_label_lines(spark, sf_dir), [MODE_SECTION]))


def country_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = fx.table(spark, sf_dir, "part")
    size = F.col("p_size")
    name = (
        F.when(size < 10, F.concat(F.lit("No Country Code "), "p_name"))
        .when(size < 20, F.concat(F.lit("INVALID: "), "p_name"))
        .when(size < 30, F.concat("p_type", F.lit(" Collapsed "), "p_name"))
        .when(size < 40, F.concat(F.lit("My No Country "), "p_name"))
        .otherwise(F.col("p_name"))
    )
    lines = fx.label_lines(
        parts,
        F.col("p_brand"),
        F.col("p_partkey"),
        fx.quoted_pair(F.col("p_partkey"), name),
        f"value {COUNTRY_SECTION}",
    )
    return star.countries(label_pairs(lines, [COUNTRY_SECTION]))


def state_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = fx.table(spark, sf_dir, "customer")
    code = F.lpad((F.col("c_custkey") % 100).cast("string"), 2, "0")
    lines = fx.label_lines(
        customers,
        F.col("c_nationkey").cast("string"),
        F.col("c_custkey"),
        fx.quoted_pair(code, F.col("c_name")),
        f"value {STATE_SECTION}",
    )
    return star.us_states(label_pairs(lines, [STATE_SECTION]))


def port_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = fx.table(spark, sf_dir, "part")
    lines = fx.label_lines(
        parts,
        F.col("p_brand"),
        F.col("p_partkey"),
        fx.quoted_pair(F.col("p_partkey"), fx.part_names(parts)),
        f"value {PORT_SECTION}",
    )
    return star.airport_codes(label_pairs(lines, [PORT_SECTION]))


def port_split_untrimmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = fx.table(spark, sf_dir, "part")
    return parts.select("p_partkey", fx.part_names(parts).alias("name")).select(
        "p_partkey",
        port_city("name", trim=False).alias("city"),
        port_state("name").alias("us_state_id"),
    )


def rejected_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs whose code is no number: every fifth size of the parts."""
    return label_rejects(label_pairs(mode_label_lines(spark, sf_dir), [MODE_SECTION])).drop("position")


def resolved_ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ports with state codes, state names, another order of blanks, states after the last blank, or none."""
    return ports.resolve_ports(fx.spelled_ports(spark, sf_dir), fx.named_states(spark, sf_dir))


def unmatched_ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why ports fall out of the city share, with their visits."""
    visits = analytics.count_visits(fx.visits(spark, sf_dir), "airport_code")
    return ports.unmatched_ports(resolved_ports(spark, sf_dir), fx.demography(spark, sf_dir), visits)


# --- demography ------------------------------------------------------------------------------


def city_files(spark: SparkSession, sf_dir: str) -> str:
    """City files with empty, malformed and surplus cells; returns where they are."""
    key = F.col("c_custkey")
    cells = (
        fx.table(spark, sf_dir, "customer")
        .join(fx.table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.concat(
                F.lower("c_mktsegment"), F.lit(" "), F.floor(key / 500).cast("string")
            ).alias("City"),
            F.col("n_name").alias("State"),
            F.col("c_acctbal").alias("Median Age"),
            F.when(key % 11 != 0, key % 1000).alias("Male Population"),
            F.when(key % 13 == 0, "x")
            .otherwise((key % 1000).cast("string"))
            .alias("Female Population"),
            (key % 5000).alias("Total Population"),
            (key % 17).alias("Number of Veterans"),
            (key % 19).alias("Foreign-born"),
            (key % 50 / 10).alias("Average Household Size"),
            F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("State Code"),
            F.concat(F.lit("R"), (key % 7).cast("string")).alias("Race"),
            F.lit(99).alias("Count"),
        )
    )
    path = new_scratch_path(spark, "cities")
    cells.write.csv(path, sep=";", header=True)
    return path


def demography_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.city_demography(read_demography(spark, city_files(spark, sf_dir)))


def rejected_city_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bad_city_cells(spark, city_files(spark, sf_dir))


def dedup_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_per_key(
        fx.table(spark, sf_dir, "customer"), ["c_nationkey", "c_mktsegment"], ["c_acctbal"]
    )


# --- questions -------------------------------------------------------------------------------


def visits_by_port(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.count_visits(fx.visits(spark, sf_dir), "airport_code")


def top_ports_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_views({VISITS: fx.visits(spark, sf_dir), PORTS: fx.ports(spark, sf_dir)})
    return spark.sql(
        f"""
        SELECT p.city, v.airport_code, v.immigrant_visits
        FROM (SELECT airport_code, COUNT(*) AS immigrant_visits
              FROM {VISITS} WHERE month = {MONTH} GROUP BY airport_code
              ORDER BY immigrant_visits DESC, airport_code LIMIT 10) v
        JOIN {PORTS} p ON p.airport_code = v.airport_code
        ORDER BY v.immigrant_visits DESC, v.airport_code
        """
    )


def top_ports_of_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.top_ports_of_month(
        fx.visits(spark, sf_dir), fx.ports(spark, sf_dir), month=MONTH
    )


def _visit_share(spark: SparkSession, sf_dir: str, match_state: bool) -> DataFrame:
    return analytics.visit_share(
        fx.visits(spark, sf_dir),
        fx.ports(spark, sf_dir),
        fx.demography(spark, sf_dir),
        fx.states(spark, sf_dir),
        match_state=match_state,
    )


def visit_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _visit_share(spark, sf_dir, match_state=True)


def visit_share_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _visit_share(spark, sf_dir, match_state=False)


def top_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.top_countries(
        fx.visits(spark, sf_dir), fx.countries(spark, sf_dir), PORT, k=10
    )


def top_countries_last_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    visits = analytics.in_last_year(fx.visits(spark, sf_dir))
    return analytics.top_countries(visits, fx.countries(spark, sf_dir), PORT)


def visit_share_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_views(
        {
            VISITS: fx.visits(spark, sf_dir),
            PORTS: fx.ports(spark, sf_dir),
            DEMOGRAPHY: fx.demography(spark, sf_dir),
            STATES: fx.states(spark, sf_dir),
        }
    )
    return spark.sql(
        f"""
        SELECT d.city, s.us_state_name, v.immigrant_visits, d.total_population,
               try_divide(v.immigrant_visits, d.total_population) AS immigrant_share
        FROM (SELECT airport_code, COUNT(*) AS immigrant_visits
              FROM {VISITS} GROUP BY airport_code) v
        JOIN {PORTS} p ON p.airport_code = v.airport_code
        JOIN {DEMOGRAPHY} d ON p.city = d.city AND p.us_state_id = d.state_id
        JOIN {STATES} s ON d.state_id = s.us_state_id
        ORDER BY immigrant_share DESC NULLS LAST, v.immigrant_visits DESC, d.city, v.airport_code,
                 s.us_state_name, d.total_population
        LIMIT 5
        """
    )


def top_countries_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_views(
        {VISITS: fx.visits(spark, sf_dir), COUNTRIES: fx.countries(spark, sf_dir)}
    )
    return spark.sql(
        f"""
        SELECT c.country_name AS country_of_origin, v.immigrant_visits
        FROM (SELECT citizen_country_id, COUNT(*) AS immigrant_visits
              FROM {VISITS} WHERE airport_code = '{PORT}' GROUP BY citizen_country_id
              ORDER BY immigrant_visits DESC, citizen_country_id LIMIT 10) v
        JOIN {COUNTRIES} c ON v.citizen_country_id = c.country_id
        ORDER BY v.immigrant_visits DESC, v.citizen_country_id
        """
    )


def top3_countries_per_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.top_countries_per_year(
        fx.visits(spark, sf_dir), fx.countries(spark, sf_dir), PORT
    )


# --- quality ---------------------------------------------------------------------------------


def dq_unique_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = fx.table(spark, sf_dir, "customer")
    return union_reports(
        [
            key_report(PORTS, fx.ports(spark, sf_dir), ["airport_code"]),
            key_report("customer", customers, ["c_nationkey"]),
        ]
    )


def dq_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten keys of each table that occur most often: of one column, and of two."""
    customers, lines = fx.table(spark, sf_dir, "customer"), fx.table(spark, sf_dir, "lineitem")
    return union_reports(
        [
            repeated_keys("customer", customers, ["c_nationkey"], 10),
            repeated_keys("lineitem", lines, ["l_partkey", "l_suppkey"], 10),
        ]
    )


def dq_unique_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = fx.table(spark, sf_dir, "lineitem")
    return union_reports(
        [
            key_report(DEMOGRAPHY, fx.demography(spark, sf_dir), ["city", "state_id"]),
            key_report("lineitem", lines, ["l_orderkey", "l_linenumber"]),
        ]
    )


def dq_not_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    visits = fx.visits(spark, sf_dir)
    return union_reports(
        [fill_report(VISITS, visits), fill_report("no_visits", visits.where("year < 0"))]
    ).select("table_name", "row_count", "is_filled")


def star_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        VISITS: fx.visits(spark, sf_dir),
        DEMOGRAPHY: fx.demography(spark, sf_dir),
        MODES: mode_labels(spark, sf_dir),
        COUNTRIES: fx.countries(spark, sf_dir),
        VISAS: visa_labels(spark, sf_dir),
        STATES: fx.states(spark, sf_dir),
        PORTS: fx.ports(spark, sf_dir),
    }


def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star_report(star_tables(spark, sf_dir))


def dq_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_counts(star_tables(spark, sf_dir))


def dq_orphan_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    known_ports = fx.ports(spark, sf_dir).where(~F.col("airport_code").endswith("0"))
    countries = fx.countries(spark, sf_dir)
    return orphan_keys(
        fx.visits(spark, sf_dir),
        {
            "airport_code": (known_ports, "airport_code"),
            "citizen_country_id": (countries, "country_id"),
            "residence_country_id": (countries, "country_id"),
        },
    )


def dq_orphan_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphan_report(dq_orphan_keys(spark, sf_dir))


def dq_unreadable_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day numbers that name no date: every quantity above 40 is made one."""
    days = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1960-01-01")).cast("double")
    bad = F.when(F.col("l_quantity") > 40, F.lit(float("nan"))).otherwise(days)
    raw = fx.table(spark, sf_dir, "lineitem").select(
        days.alias("arrdate"), bad.alias("depdate")
    )
    return unreadable_report(raw, ["arrdate", "depdate"])


# --- lake ------------------------------------------------------------------------------------


def new_lake(spark: SparkSession, sf_dir: str, raw: DataFrame | None = None) -> str:
    """A lake of its own with all visits, or those of some records; a folder per month and nation."""
    root = new_scratch_path(spark, "lake")
    load_visits(spark, fx.raw_regional_visits(spark, sf_dir) if raw is None else raw, root)
    return root


def shared_lake(spark: SparkSession, sf_dir: str) -> str:
    """The lake that questions read; written once for them in a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in LAKES:
        LAKES[key] = new_lake(spark, sf_dir)
    return LAKES[key]


LAKES: dict[tuple[str, str], str] = {}


def fact_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_visits(spark, new_lake(spark, sf_dir))


def top_ports_last_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.top_ports_of_last_month(fx.visits(spark, sf_dir), fx.ports(spark, sf_dir))


def lake_top_ports_last_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest month there is, known from the lake's version."""
    root = shared_lake(spark, sf_dir)
    return analytics.top_ports_of_last_month(
        read_visits(spark, root), fx.regional_ports(spark, sf_dir), months=read_months(spark, root)
    )


def lake_top_ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One month of one year, from its folders alone."""
    year, month = REFRESHED
    return analytics.top_ports_of_month(
        read_visits(spark, shared_lake(spark, sf_dir)), fx.regional_ports(spark, sf_dir), month, year
    )


def lake_top_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One port, from its folders alone."""
    visits = read_visits(spark, shared_lake(spark, sf_dir))
    return analytics.top_countries(visits, fx.countries(spark, sf_dir), LAKE_PORT, k=10)


def lake_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_months(spark, shared_lake(spark, sf_dir))


def counted_top_ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first question from the maintained counts: no visit is read."""
    counts = read_counts(spark, shared_lake(spark, sf_dir))
    return analytics.top_ports_of_month(counts, fx.regional_ports(spark, sf_dir), MONTH)


def counted_visit_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.visit_share(
        read_counts(spark, shared_lake(spark, sf_dir)),
        fx.regional_ports(spark, sf_dir),
        fx.demography(spark, sf_dir),
        fx.states(spark, sf_dir),
    )


def counted_top_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = read_counts(spark, shared_lake(spark, sf_dir))
    return analytics.top_countries(counts, fx.countries(spark, sf_dir), LAKE_PORT, k=10)


def appended_lake(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """A lake without the records of one nation and of the first travel mode, to which all records come late, some of
    them twice; and the report of that."""
    late = new_scratch_path(spark, "late")
    copies = F.when(F.col("i94mode") > 3, 2).otherwise(1)
    raw = fx.raw_regional_visits(spark, sf_dir)
    raw.withColumn("copy", F.explode(F.sequence(F.lit(1), copies))).write.parquet(late)
    first = (F.col("copy") == 1) & (F.col("i94port") != LAKE_PORT) & (F.col("i94mode") > 1)
    root = new_lake(spark, sf_dir, spark.read.parquet(late).where(first))
    return root, append_visits(spark, late, root)


def late_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_visits(spark, appended_lake(spark, sf_dir)[0])


def late_visits_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the append reports, and the visits in the counts and in the table of months after it."""
    root, report = appended_lake(spark, sf_dir)
    sums = {"immigration_counts": read_counts(spark, root).agg(F.sum("immigrant_visits").alias("row_count")),
            "immigration_months": read_months(spark, root).agg(F.sum("visits").alias("row_count"))}
    for table, total in sums.items():
        report = report.unionByName(
            total.select(F.lit(table).alias("table_name"), F.lit("visits").alias("measure"), "row_count")
        )
    return report


def dim_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_scratch_path(spark, "lake")
    write_dimension(fx.ports(spark, sf_dir), root, PORTS)
    return read_dimension(spark, root, PORTS)


def refreshed_lake(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """A lake of which one month is replaced from records of all months, with another flight number
    and one port less; and the report of that."""
    root, newer = new_lake(spark, sf_dir), new_scratch_path(spark, "newer")
    raw = fx.raw_regional_visits(spark, sf_dir).where(F.col("i94port") != LAKE_PORT)
    raw.withColumn("fltno", F.lit("NEW")).write.parquet(newer)
    return root, refresh_visits(spark, newer, root, *REFRESHED)


def month_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_visits(spark, refreshed_lake(spark, sf_dir)[0])


def month_refresh_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the refresh reports, and the number of visits in the table of months after it."""
    root, report = refreshed_lake(spark, sf_dir)
    total = read_months(spark, root).agg(F.sum("visits").alias("row_count"))
    return report.unionByName(
        total.select(F.lit("immigration_months").alias("table_name"), F.lit("visits").alias("measure"), "row_count")
    )


def demography_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The city table of a lake, replaced from city files."""
    root = new_scratch_path(spark, "lake")
    write_dimension(fx.demography(spark, sf_dir), root, DEMOGRAPHY)
    refresh_demography(spark, city_files(spark, sf_dir), root)
    return read_dimension(spark, root, DEMOGRAPHY)


def run_job(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """The batch job over inputs made from all tables: where it has written, and its report."""
    inputs, root = new_scratch_path(spark, "inputs"), new_scratch_path(spark, "lake")
    return root, run(spark, *fx.write_job_inputs(spark, sf_dir, inputs), root)


def job_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_job(spark, sf_dir)[1]


def job_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_visits(spark, run_job(spark, sf_dir)[0])


def fact_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits whose admission numbers are text, with fractional months, NaN years and empty ports."""
    mode = F.col("i94mode")
    raw = fx.raw_visits(spark, sf_dir).withColumns(
        {
            "admnum": F.concat(F.lit("A"), F.col("admnum").cast("long").cast("string")),
            "i94mon": F.when(mode == 7, F.col("i94mon") + 0.5).otherwise(F.col("i94mon")),
            "i94yr": F.when(mode == 6, F.lit(float("nan"))).otherwise(F.col("i94yr")),
            "i94port": F.when(mode == 5, "").otherwise(F.col("i94port")),
        }
    )
    return star.immigration_facts(raw)


def llm_part(what: str) -> dict:
    """QUERIES or ORACLE_SQL of the training-data operators and their pipeline."""
    if llm_queries is None:
        return {}
    pipeline = corpus_pipeline.run if what == "QUERIES" else corpus_pipeline.ORACLE_SQL
    return getattr(llm_queries, what) | ({"pipeline": pipeline} if pipeline else {})


def queries() -> dict[str, Query]:
    return llm_part("QUERIES") | {
        "scan_project": scan_project,
        "raw_scan": raw_scan,
        "rename_positional": rename_by_position,
        "fact_distinct": fact_distinct,
        "fact_visits": fact_visits,
        "sas_date": sas_dates,
        "city_upper": city_upper,
        "preview": preview,
        "label_pairs": labels_of_parts,
        "label_files": label_files,
        "label_faults": label_faults,
        "label_comment_section": visa_labels,
        "typed_ids": mode_labels,
        "normalize_invalid": country_labels,
        "exclude_code": state_labels,
        "port_split": port_labels,
        "port_split_untrimmed": port_split_untrimmed,
        "demography_csv": demography_csv,
        "dedup_by_key": dedup_by_key,
        "visits_by_port": visits_by_port,
        "top_ports_sql": top_ports_sql,
        "top_ports_of_month": top_ports_of_month,
        "top_ports_last_month": top_ports_last_month,
        "visit_share": visit_share,
        "visit_share_by_name": visit_share_by_name,
        "visit_share_sql": visit_share_sql,
        "top_countries": top_countries,
        "top_countries_sql": top_countries_sql,
        "top_countries_last_year": top_countries_last_year,
        "top3_countries_per_year": top3_countries_per_year,
        "dq_unique_key": dq_unique_key,
        "dq_unique_composite": dq_unique_composite,
        "dq_repeated_keys": dq_repeated_keys,
        "dq_not_empty": dq_not_empty,
        "dq_report": dq_report,
        "dq_row_counts": dq_row_counts,
        "dq_orphan_keys": dq_orphan_keys,
        "dq_orphan_report": dq_orphan_report,
        "dq_unreadable_dates": dq_unreadable_dates,
        "fact_roundtrip": fact_roundtrip,
        "dim_roundtrip": dim_roundtrip,
        "month_refresh": month_refresh,
        "month_refresh_report": month_refresh_report,
        "demography_refresh": demography_refresh,
        "lake_top_ports": lake_top_ports,
        "lake_top_countries": lake_top_countries,
        "lake_months": lake_months,
        "job_report": job_report,
        "job_visits": job_visits,
        "fact_types": fact_types,
        "lake_top_ports_last_month": lake_top_ports_last_month,
        "counted_top_ports": counted_top_ports,
        "counted_visit_share": counted_visit_share,
        "counted_top_countries": counted_top_countries,
        "late_visits": late_visits,
        "late_visits_report": late_visits_report,
        "rejected_city_cells": rejected_city_cells,
        "rejected_labels": rejected_labels,
        "resolved_ports": resolved_ports,
        "unmatched_ports": unmatched_ports,
    }


def prepare(spark: SparkSession, sf_dir: str) -> None:
    """Write what several queries share, so that none of them pays for it alone."""
    shared_lake(spark, sf_dir)


# --- SQL to compare with ---------------------------------------------------------------------

RAW = """
    SELECT CAST(l.l_orderkey AS DOUBLE) AS cicid,
           CAST(year(l.l_shipdate) AS DOUBLE) AS i94yr,
           CAST(month(l.l_shipdate) AS DOUBLE) AS i94mon,
           'P' || CAST(l.l_suppkey AS VARCHAR) AS i94port,
           sn.n_name AS i94addr,
           CAST(date_diff('day', DATE '1960-01-01', CAST(l.l_shipdate AS DATE)) AS DOUBLE) AS arrdate,
           CASE WHEN l.l_returnflag <> 'N' THEN
                CAST(date_diff('day', DATE '1960-01-01', CAST(l.l_shipdate AS DATE)) AS DOUBLE)
                + l.l_quantity END AS depdate,
           CAST(l.l_linenumber AS DOUBLE) AS i94mode,
           CAST(CASE l.l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS DOUBLE) AS i94visa,
           o.o_orderpriority AS visatype,
           CAST(c.c_nationkey AS DOUBLE) AS i94cit,
           CAST(s.s_nationkey AS DOUBLE) AS i94res,
           CAST(1930 + l.l_partkey % 80 AS DOUBLE) AS biryear,
           CASE WHEN l.l_linestatus = 'F' THEN 'F' ELSE 'M' END AS gender,
           CAST(l.l_partkey AS VARCHAR) AS insnum,
           c.c_mktsegment AS airline,
           CAST(l.l_orderkey * 10 + l.l_linenumber AS DOUBLE) AS admnum,
           'F' || CAST(l.l_suppkey % 1000 AS VARCHAR) AS fltno
    FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN supplier s ON s.s_suppkey = l.l_suppkey
    JOIN nation sn ON sn.n_nationkey = s.s_nationkey
"""

NAMED = """
    SELECT cicid AS citizen_id, CAST(i94yr AS INTEGER) AS year, CAST(i94mon AS INTEGER) AS month,
           i94port AS airport_code, i94addr AS state_id,
           CASE WHEN arrdate <> 0 THEN DATE '1960-01-01' + CAST(floor(arrdate) AS INTEGER) END
               AS arrival_date,
           CASE WHEN depdate <> 0 THEN DATE '1960-01-01' + CAST(floor(depdate) AS INTEGER) END
               AS departure_date,
           i94mode AS travel_mode_id, i94visa AS visa_category_id, visatype AS visa_type,
           i94cit AS citizen_country_id, i94res AS residence_country_id, biryear AS birth_year,
           gender, insnum AS ins_num, airline, admnum AS admin_num, fltno AS flight_number
    FROM raw
"""

STAR = f"""
    raw AS ({RAW}),
    visits AS ({NAMED}),
    ports AS (
        SELECT 'P' || CAST(s_suppkey AS VARCHAR) AS airport_code, n_name AS city,
               CASE s_suppkey % 6 WHEN 0 THEN 'AUTOMOBILE' WHEN 1 THEN 'BUILDING'
                    WHEN 2 THEN 'FURNITURE' WHEN 3 THEN 'HOUSEHOLD' WHEN 4 THEN 'MACHINERY' END
                   AS us_state_id
        FROM supplier JOIN nation ON s_nationkey = n_nationkey),
    demography AS (
        SELECT n_name AS city, c_mktsegment AS state_id,
               CAST(COUNT(*) FILTER (WHERE c_acctbal > 9000) AS INTEGER) AS total_population
        FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL),
    states AS (
        SELECT DISTINCT c_mktsegment AS us_state_id, lower(c_mktsegment) AS us_state_name
        FROM customer WHERE c_mktsegment <> 'MACHINERY'),
    countries AS (
        SELECT n_nationkey AS country_id, n_name AS country_name
        FROM nation WHERE n_nationkey % 7 <> 0)
"""

PART_NAME = (
    "p_name || CASE WHEN p_size % 10 = 0 THEN ' ' ELSE ', ' END || p_type || '  '"
)

MODE_LABELS = """
    SELECT CASE WHEN p_size % 5 <> 0 THEN CAST(p_partkey AS INTEGER) END AS travel_mode_id,
           p_name AS travel_mode_name
    FROM part
"""

VISA_LABELS = """
    SELECT CAST(s_suppkey AS INTEGER) AS visa_category_id, s_name AS visa_category_name
    FROM supplier
"""


def _key_report(table: str, source: str, keys: str) -> str:
    return f"""
        SELECT '{table}' AS table_name, CAST(coalesce(SUM(n), 0) AS BIGINT) AS row_count,
               COUNT(*) AS key_count, COUNT(*) FILTER (WHERE n > 1) AS duplicate_keys,
               COUNT(*) FILTER (WHERE n > 1) = 0 AS is_unique, coalesce(SUM(n), 0) > 0 AS is_filled
        FROM (SELECT COUNT(*) AS n FROM {source} GROUP BY {keys})
    """


def _top_ports(where: str) -> str:
    return f"""
        WITH {STAR}
        SELECT p.city, v.airport_code, v.immigrant_visits
        FROM (SELECT airport_code, COUNT(*) AS immigrant_visits FROM visits
              WHERE {where} GROUP BY airport_code
              ORDER BY immigrant_visits DESC, airport_code LIMIT 10) v
        JOIN ports p ON p.airport_code = v.airport_code
        ORDER BY v.immigrant_visits DESC, v.airport_code
    """


def _visit_share_sql(match: str) -> str:
    return f"""
        WITH {STAR}
        SELECT d.city, st.us_state_name, v.immigrant_visits, d.total_population,
               CASE WHEN d.total_population > 0
                    THEN v.immigrant_visits / d.total_population END AS immigrant_share
        FROM (SELECT airport_code, COUNT(*) AS immigrant_visits FROM visits GROUP BY airport_code) v
        JOIN ports p ON p.airport_code = v.airport_code
        JOIN demography d ON {match}
        JOIN states st ON d.state_id = st.us_state_id
        ORDER BY immigrant_share DESC NULLS LAST, v.immigrant_visits DESC, d.city, v.airport_code,
                 st.us_state_name, d.total_population NULLS FIRST
        LIMIT 5
    """


def _top_countries(where: str, k: int) -> str:
    return f"""
        WITH {STAR}
        SELECT c.country_name AS country_of_origin, v.immigrant_visits
        FROM (SELECT citizen_country_id, COUNT(*) AS immigrant_visits FROM visits
              WHERE airport_code = '{PORT}' AND {where} GROUP BY citizen_country_id
              ORDER BY immigrant_visits DESC, citizen_country_id NULLS LAST LIMIT {k}) v
        JOIN countries c ON v.citizen_country_id = c.country_id
        ORDER BY v.immigrant_visits DESC, v.citizen_country_id
    """


DQ_REPORT = " UNION ALL ".join(
    [
        f"""
        SELECT '{VISITS}' AS table_name, COUNT(*) AS row_count,
               CAST(NULL AS BIGINT) AS key_count, CAST(NULL AS BIGINT) AS duplicate_keys,
               CAST(NULL AS BOOLEAN) AS is_unique, COUNT(*) > 0 AS is_filled
        FROM visits
        """,
        _key_report(DEMOGRAPHY, "demography", "city, state_id"),
        _key_report(MODES, f"({MODE_LABELS})", "travel_mode_id"),
        _key_report(COUNTRIES, "countries", "country_id"),
        _key_report(VISAS, f"({VISA_LABELS})", "visa_category_id"),
        _key_report(STATES, "states", "us_state_id"),
        _key_report(PORTS, "ports", "airport_code"),
    ]
)

ORPHANS = f"""
    WITH {STAR},
    known_ports AS (SELECT * FROM ports WHERE NOT suffix(airport_code, '0')),
    orphans AS (
        SELECT 'airport_code' AS column_name, airport_code AS key, COUNT(*) AS row_count
        FROM visits WHERE NOT EXISTS
            (SELECT 1 FROM known_ports p WHERE p.airport_code = visits.airport_code)
        GROUP BY ALL
        UNION ALL
        SELECT 'citizen_country_id', CAST(citizen_country_id AS VARCHAR), COUNT(*)
        FROM visits WHERE NOT EXISTS
            (SELECT 1 FROM countries c WHERE c.country_id = visits.citizen_country_id)
        GROUP BY ALL
        UNION ALL
        SELECT 'residence_country_id', CAST(residence_country_id AS VARCHAR), COUNT(*)
        FROM visits WHERE NOT EXISTS
            (SELECT 1 FROM countries c WHERE c.country_id = visits.residence_country_id)
        GROUP BY ALL)
"""


LAKE = f"""
    {STAR},
    lake AS (
        SELECT * REPLACE (CAST(CAST(residence_country_id AS INTEGER) AS VARCHAR) AS airport_code)
        FROM visits),
    lake_ports AS (
        SELECT CAST(n_nationkey AS VARCHAR) AS airport_code, n_name AS city,
               CASE n_nationkey % 6 WHEN 0 THEN 'AUTOMOBILE' WHEN 1 THEN 'BUILDING'
                    WHEN 2 THEN 'FURNITURE' WHEN 3 THEN 'HOUSEHOLD' WHEN 4 THEN 'MACHINERY' END
                   AS us_state_id
        FROM nation)
"""


def _lake_top_ports(where: str) -> str:
    return f"""
        WITH {LAKE}
        SELECT p.city, v.airport_code, v.immigrant_visits
        FROM (SELECT airport_code, COUNT(*) AS immigrant_visits FROM lake
              WHERE {where} GROUP BY airport_code
              ORDER BY immigrant_visits DESC, airport_code LIMIT 10) v
        JOIN lake_ports p ON p.airport_code = v.airport_code
        ORDER BY v.immigrant_visits DESC, v.airport_code
    """


def _measures(table: str, **counts: str) -> str:
    """Rows (table_name, measure, row_count), one per count."""
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{measure.replace('__', ' ')}' AS measure, "
        f"CAST(({count}) AS BIGINT) AS row_count"
        for measure, count in counts.items()
    )


UNREADABLE = {
    f"unreadable__{name}": "SELECT 0" for name in ("year", "month", "arrival_date", "departure_date")
} | {"blank__airport_code": "SELECT 0"}


def _port_oracles() -> dict[str, str]:
    """SQL of the ports whose states are spelled in six ways, and of those that match no city."""
    resolved = f"""
        WITH {STAR},
        spelled AS (
            SELECT 'P' || CAST(s_suppkey AS VARCHAR) AS airport_code, n_name AS city, s_suppkey % 6 AS way,
                   (['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'])[s_suppkey % 5 + 1] AS state
            FROM supplier JOIN nation ON s_nationkey = n_nationkey),
        resolved AS (
            SELECT airport_code, city || CASE WHEN way = 5 OR way = 3 AND state = 'MACHINERY' THEN CASE way WHEN 5 THEN '' ELSE ' MACHINERY' END ELSE '' END AS city,
                   CASE WHEN way = 5 THEN NULL WHEN way = 4 THEN 'FAR AWAY'
                        WHEN state = 'MACHINERY' THEN CASE way WHEN 0 THEN state WHEN 1 THEN 'state of machinery' WHEN 2 THEN 'State  Of Machinery' END
                        ELSE state END AS us_state_id,
                   CASE WHEN way = 5 OR way = 3 AND state = 'MACHINERY' THEN 'no state'
                        WHEN way = 4 OR state = 'MACHINERY' THEN 'unknown state'
                        WHEN way = 0 THEN 'code' WHEN way = 3 THEN 'last word' ELSE 'name' END AS matched_by
            FROM spelled)
    """
    return {
        "resolved_ports": f"{resolved} SELECT * FROM resolved",
        "unmatched_ports": f"""{resolved}
            SELECT reason, COUNT(*) AS ports, CAST(coalesce(SUM(n), 0) AS BIGINT) AS immigrant_visits
            FROM (SELECT r.airport_code,
                         CASE WHEN matched_by IN ('no state', 'unknown state') THEN matched_by
                              ELSE 'no such city' END AS reason
                  FROM resolved r
                  WHERE matched_by IN ('no state', 'unknown state') OR NOT EXISTS
                      (SELECT 1 FROM demography d WHERE d.city = r.city AND d.state_id = r.us_state_id)) u
            LEFT JOIN (SELECT airport_code, COUNT(*) AS n FROM visits GROUP BY airport_code) v
                ON v.airport_code = u.airport_code
            GROUP BY reason
        """,
    }


def oracle_sql() -> dict[str, str]:
    year, month = REFRESHED
    return llm_part("ORACLE_SQL") | {
        "scan_project": "SELECT l_orderkey, l_suppkey AS port, l_shipdate FROM lineitem",
        "raw_scan": RAW,
        "rename_positional": f"""
            WITH raw AS ({RAW})
            SELECT {", ".join(f"{source} AS {name}" for source, name, _ in VISIT_FIELDS)} FROM raw
        """,
        "fact_distinct": f"SELECT DISTINCT * FROM ({RAW})",
        "fact_visits": f"WITH raw AS (SELECT DISTINCT * FROM ({RAW})) {NAMED}",
        "sas_date": """
            SELECT l_orderkey, l_quantity,
                   CAST(l_shipdate AS DATE) AS shipped,
                   CASE WHEN (l_quantity - 25) * CAST(1.3 AS DOUBLE) <> 0 THEN DATE '1960-01-01'
                        + CAST(floor((l_quantity - 25) * CAST(1.3 AS DOUBLE)) AS INTEGER) END AS scaled
            FROM lineitem
        """,
        "city_upper": "SELECT p_partkey, upper(p_name) AS city FROM part",
        "preview": """
            SELECT o_orderkey, o_custkey, o_orderpriority FROM orders ORDER BY o_orderkey LIMIT 5
        """,
        "label_pairs": f"""
            SELECT p_brand AS source, '{PORT_SECTION}' AS section,
                   CAST(p_partkey AS VARCHAR) AS code, {PART_NAME} AS name
            FROM part WHERE p_size % 13 <> 0
        """,
        "label_files": f"""
            SELECT '{PORT_SECTION}' AS section, CAST(p_partkey AS VARCHAR) AS code,
                   {PART_NAME} AS name
            FROM part
        """,
        "label_faults": f"""
            SELECT DISTINCT p_brand AS source, '{MODE_SECTION}' AS section,
                   'section not found' AS fault
            FROM part
        """,
        "label_comment_section": VISA_LABELS,
        "typed_ids": MODE_LABELS,
        "normalize_invalid": """
            SELECT CAST(p_partkey AS INTEGER) AS country_id,
                   regexp_replace(
                       CASE WHEN p_size < 10 THEN 'No Country Code ' || p_name
                            WHEN p_size < 20 THEN 'INVALID: ' || p_name
                            WHEN p_size < 30 THEN p_type || ' Collapsed ' || p_name
                            WHEN p_size < 40 THEN 'My No Country ' || p_name
                            ELSE p_name END,
                       '^No Country.*|INVALID.*|Collapsed.*', 'NA', 'g') AS country_name
            FROM part
        """,
        "exclude_code": """
            SELECT lpad(CAST(c_custkey % 100 AS VARCHAR), 2, '0') AS us_state_id,
                   c_name AS us_state_name
            FROM customer WHERE c_custkey % 100 <> 99
        """,
        "port_split": """
            SELECT CAST(p_partkey AS VARCHAR) AS airport_code,
                   CASE WHEN p_size % 10 = 0 THEN p_name || ' ' || p_type ELSE p_name END AS city,
                   CASE WHEN p_size % 10 <> 0 THEN p_type END AS us_state_id
            FROM part
        """,
        "port_split_untrimmed": """
            SELECT p_partkey,
                   CASE WHEN p_size % 10 = 0 THEN p_name || ' ' || p_type || '  '
                        ELSE p_name END AS city,
                   CASE WHEN p_size % 10 <> 0 THEN p_type END AS us_state_id
            FROM part
        """,
        **dict.fromkeys(("demography_csv", "demography_refresh"), """
            WITH cells AS (
                SELECT lower(c_mktsegment) || ' ' || CAST(c_custkey // 500 AS VARCHAR) AS city,
                       n_name AS state, c_acctbal AS median_age,
                       CAST(CASE WHEN c_custkey % 11 <> 0 THEN c_custkey % 1000 END AS INTEGER)
                           AS male_population,
                       CAST(CASE WHEN c_custkey % 13 <> 0 THEN c_custkey % 1000 END AS INTEGER)
                           AS female_population,
                       CAST(c_custkey % 5000 AS INTEGER) AS total_population,
                       CAST(c_custkey % 17 AS INTEGER) AS number_of_veterans,
                       CAST(c_custkey % 19 AS INTEGER) AS foreign_born,
                       CAST(c_custkey % 50 AS DOUBLE) / 10 AS average_household_size,
                       'N' || CAST(c_nationkey AS VARCHAR) AS state_id,
                       'R' || CAST(c_custkey % 7 AS VARCHAR) AS race
                FROM customer JOIN nation ON c_nationkey = n_nationkey),
            ranked AS (
                SELECT *, row_number() OVER (
                    PARTITION BY city, state
                    ORDER BY race, median_age, male_population NULLS FIRST,
                             female_population NULLS FIRST, total_population, number_of_veterans,
                             foreign_born, average_household_size, state_id) AS rn
                FROM cells)
            SELECT upper(city) AS city, median_age, male_population, female_population,
                   total_population, number_of_veterans, foreign_born, average_household_size,
                   state_id, race
            FROM ranked WHERE rn = 1
        """),
        "dedup_by_key": """
            SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
            FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey, c_mktsegment
                                               ORDER BY c_acctbal, c_custkey, c_name) AS rn
                  FROM customer)
            WHERE rn = 1
        """,
        "visits_by_port": f"""
            WITH {STAR}
            SELECT airport_code, COUNT(*) AS immigrant_visits FROM visits GROUP BY airport_code
        """,
        "top_ports_sql": _top_ports(f"month = {MONTH}"),
        "top_ports_of_month": _top_ports(f"month = {MONTH}"),
        "top_ports_last_month": _top_ports(
            "year * 12 + month = (SELECT max(year * 12 + month) FROM visits)"
        ),
        "lake_top_ports_last_month": _lake_top_ports(
            "year * 12 + month = (SELECT max(year * 12 + month) FROM visits)"
        ),
        "counted_top_ports": _lake_top_ports(f"month = {MONTH}"),
        "counted_visit_share": f"""
            WITH {LAKE}
            SELECT d.city, st.us_state_name, v.immigrant_visits, d.total_population,
                   CASE WHEN d.total_population > 0
                        THEN v.immigrant_visits / d.total_population END AS immigrant_share
            FROM (SELECT airport_code, COUNT(*) AS immigrant_visits FROM lake GROUP BY airport_code) v
            JOIN lake_ports p ON p.airport_code = v.airport_code
            JOIN demography d ON p.city = d.city AND p.us_state_id = d.state_id
            JOIN states st ON d.state_id = st.us_state_id
            ORDER BY immigrant_share DESC NULLS LAST, v.immigrant_visits DESC, d.city, v.airport_code,
                     st.us_state_name, d.total_population NULLS FIRST
            LIMIT 5
        """,
        "late_visits": f"WITH {LAKE} SELECT DISTINCT * FROM lake",
        "late_visits_report": f"""
            WITH {LAKE}, known AS (
                SELECT DISTINCT * FROM lake WHERE airport_code <> '{LAKE_PORT}' AND travel_mode_id > 1)
            {_measures(VISITS, rows="(SELECT COUNT(*) FROM (SELECT DISTINCT * FROM lake)) - (SELECT COUNT(*) FROM known)",
                       known__visits="SELECT COUNT(*) FROM known", **UNREADABLE)}
            UNION ALL {_measures("immigration_counts", visits="SELECT COUNT(*) FROM (SELECT DISTINCT * FROM lake)")}
            UNION ALL {_measures("immigration_months", visits="SELECT COUNT(*) FROM (SELECT DISTINCT * FROM lake)")}
        """,
        "rejected_city_cells": """
            SELECT 'female_population' AS column_name, COUNT(*) AS bad_cells
            FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 13 = 0
        """,
        "rejected_labels": f"""
            SELECT '{MODES}' AS table_name, '{MODE_SECTION}' AS section, p_brand AS source,
                   'X' || CAST(p_partkey AS VARCHAR) AS code, p_name AS name
            FROM part WHERE p_size % 5 = 0
        """,
        **_port_oracles(),
        "lake_top_ports": _lake_top_ports(f"year = {year} AND month = {month}"),
        **dict.fromkeys(("lake_top_countries", "counted_top_countries"), f"""
            WITH {LAKE}
            SELECT c.country_name AS country_of_origin, v.immigrant_visits
            FROM (SELECT citizen_country_id, COUNT(*) AS immigrant_visits FROM lake
                  WHERE airport_code = '{LAKE_PORT}' GROUP BY citizen_country_id
                  ORDER BY immigrant_visits DESC, citizen_country_id NULLS LAST LIMIT 10) v
            JOIN countries c ON v.citizen_country_id = c.country_id
            ORDER BY v.immigrant_visits DESC, v.citizen_country_id
        """),
        "lake_months": f"""
            WITH {LAKE} SELECT year, month, COUNT(*) AS visits FROM lake GROUP BY year, month
        """,
        "job_visits": f"WITH {LAKE} SELECT DISTINCT * FROM lake",
        "job_report": f"""
            WITH {LAKE}
            {_measures(VISITS, rows="SELECT COUNT(*) FROM (SELECT DISTINCT * FROM lake)", **UNREADABLE)}
            UNION ALL {_measures(DEMOGRAPHY, rows="SELECT COUNT(*) FROM demography")}
            UNION ALL {_measures(MODES, rows="SELECT COUNT(DISTINCT l_linenumber) FROM lineitem")}
            UNION ALL {_measures(COUNTRIES, rows="SELECT COUNT(*) FROM countries")}
            UNION ALL {_measures(VISAS, rows="SELECT COUNT(DISTINCT l_returnflag) FROM lineitem")}
            UNION ALL {_measures(STATES, rows="SELECT COUNT(*) FROM nation")}
            UNION ALL {_measures(PORTS, rows="SELECT COUNT(*) FROM nation")}
            UNION ALL {_measures(VISITS,
                orphan__citizen_country_id="SELECT COUNT(*) FROM lake WHERE citizen_country_id % 7 = 0",
                empty__citizen_country_id="SELECT 0",
                orphan__residence_country_id="SELECT COUNT(*) FROM lake WHERE residence_country_id % 7 = 0",
                empty__residence_country_id="SELECT 0")}
        """,
        "fact_types": f"""
            WITH raw AS (SELECT DISTINCT * FROM ({RAW})), visits AS ({NAMED})
            SELECT * REPLACE (
                CASE WHEN travel_mode_id <> 6 THEN year END AS year,
                CASE WHEN travel_mode_id <> 7 THEN month END AS month,
                CASE WHEN travel_mode_id <> 5 THEN airport_code END AS airport_code,
                'A' || CAST(CAST(admin_num AS BIGINT) AS VARCHAR) AS admin_num)
            FROM visits
        """,
        "visit_share": _visit_share_sql("p.city = d.city AND p.us_state_id = d.state_id"),
        "visit_share_by_name": _visit_share_sql("p.city = d.city"),
        "visit_share_sql": _visit_share_sql("p.city = d.city AND p.us_state_id = d.state_id"),
        "top_countries": _top_countries("true", 10),
        "top_countries_sql": _top_countries("true", 10),
        "top_countries_last_year": _top_countries("year = (SELECT max(year) FROM visits)", 3),
        "top3_countries_per_year": f"""
            WITH {STAR},
            counted AS (
                SELECT year, citizen_country_id, COUNT(*) AS immigrant_visits FROM visits
                WHERE airport_code = '{PORT}' GROUP BY year, citizen_country_id),
            ranked AS (
                SELECT *, row_number() OVER (
                    PARTITION BY year
                    ORDER BY immigrant_visits DESC, citizen_country_id NULLS LAST) AS rn
                FROM counted)
            SELECT year, country_name AS country_of_origin, immigrant_visits
            FROM ranked JOIN countries ON citizen_country_id = country_id
            WHERE rn <= 3
        """,
        "dq_unique_key": f"""
            WITH {STAR}
            {_key_report(PORTS, "ports", "airport_code")}
            UNION ALL {_key_report("customer", "customer", "c_nationkey")}
        """,
        "dq_unique_composite": f"""
            WITH {STAR}
            {_key_report(DEMOGRAPHY, "demography", "city, state_id")}
            UNION ALL {_key_report("lineitem", "lineitem", "l_orderkey, l_linenumber")}
        """,
        "dq_repeated_keys": """
            (SELECT 'customer' AS table_name, 'c_nationkey=' || c_nationkey AS key, COUNT(*) AS copies
             FROM customer GROUP BY c_nationkey HAVING COUNT(*) > 1 ORDER BY copies DESC, key LIMIT 10)
            UNION ALL
            (SELECT 'lineitem', 'l_partkey=' || l_partkey || ', l_suppkey=' || l_suppkey AS key, COUNT(*) AS copies
             FROM lineitem GROUP BY l_partkey, l_suppkey HAVING COUNT(*) > 1 ORDER BY copies DESC, key LIMIT 10)
        """,
        "dq_not_empty": f"""
            WITH {STAR}
            SELECT '{VISITS}' AS table_name, COUNT(*) AS row_count, COUNT(*) > 0 AS is_filled
            FROM visits
            UNION ALL
            SELECT 'no_visits', COUNT(*), COUNT(*) > 0 FROM visits WHERE year < 0
        """,
        "dq_report": f"WITH {STAR} {DQ_REPORT}",
        "dq_row_counts": f"WITH {STAR} SELECT table_name, row_count FROM ({DQ_REPORT})",
        "dq_orphan_keys": f"{ORPHANS} SELECT column_name, key, row_count FROM orphans",
        "dq_orphan_report": f"""
            {ORPHANS}
            SELECT column_name, COUNT(*) AS orphan_keys, CAST(SUM(row_count) AS BIGINT) AS orphan_rows,
                   CAST(0 AS BIGINT) AS null_rows
            FROM orphans GROUP BY column_name
        """,
        "dq_unreadable_dates": """
            SELECT CAST(0 AS BIGINT) AS arrdate, COUNT(*) FILTER (WHERE l_quantity > 40) AS depdate
            FROM lineitem
        """,
        "fact_roundtrip": f"WITH {LAKE} SELECT * FROM lake",
        "dim_roundtrip": f"WITH {STAR} SELECT airport_code, city, us_state_id FROM ports",
        "month_refresh": f"""
            WITH {LAKE}
            SELECT * REPLACE (
                CASE WHEN year = {year} AND month = {month} THEN 'NEW' ELSE flight_number END
                    AS flight_number)
            FROM lake
            WHERE NOT (year = {year} AND month = {month} AND airport_code = '{LAKE_PORT}')
        """,
        "month_refresh_report": f"""
            WITH {LAKE}, newer AS (SELECT * FROM lake WHERE airport_code <> '{LAKE_PORT}'),
            inside AS (SELECT * FROM newer WHERE year = {year} AND month = {month})
            {_measures(VISITS, rows="SELECT COUNT(*) FROM inside", **UNREADABLE)}
            UNION ALL SELECT '{VISITS}', 'records of other months',
                   (SELECT COUNT(*) FROM newer) - (SELECT COUNT(*) FROM inside)
            UNION ALL SELECT 'immigration_months', 'visits', COUNT(*) FROM lake
            WHERE NOT (year = {year} AND month = {month} AND airport_code = '{LAKE_PORT}')
        """,
    }
