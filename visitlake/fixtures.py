"""Visit records, dimensions and label text derived from the order tables used for testing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlake.fixed import (
    COUNTRY_SECTION,
    MODE_SECTION,
    PORT_SECTION,
    STATE_SECTION,
    VISA_SECTION,
)
from visitlake.functions.dates import SAS_EPOCH
from visitlake.plans.star import name_visits

AFTER_ALL_PAIRS = 2**62


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 18 source columns, one visit per line item of an order.

    The orders meet their customers first, and the line items their orders before the much smaller suppliers, whose
    size as a table lets Spark broadcast them, so the line items are shuffled for this once.
    """
    shipped = F.col("l_shipdate").cast("date")
    day = F.datediff(shipped, F.lit(SAS_EPOCH)).cast("double")
    flag = F.col("l_returnflag")
    buyers = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            "o_orderkey",
            F.col("o_orderpriority").alias("visatype"),
            F.col("c_nationkey").cast("double").alias("i94cit"),
            F.col("c_mktsegment").alias("airline"),
        )
    )
    return (
        table(spark, sf_dir, "lineitem")
        .join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("l_orderkey").cast("double").alias("cicid"),
            F.year(shipped).cast("double").alias("i94yr"),
            F.month(shipped).cast("double").alias("i94mon"),
            port_code("l_suppkey").alias("i94port"),
            F.col("n_name").alias("i94addr"),
            day.alias("arrdate"),
            F.when(flag != "N", day + F.col("l_quantity")).alias("depdate"),
            F.col("l_linenumber").cast("double").alias("i94mode"),
            F.when(flag == "A", 1.0).when(flag == "N", 2.0).otherwise(3.0).alias("i94visa"),
            "visatype",
            "i94cit",
            F.col("s_nationkey").cast("double").alias("i94res"),
            (1930 + F.col("l_partkey") % 80).cast("double").alias("biryear"),
            F.when(F.col("l_linestatus") == "F", "F").otherwise("M").alias("gender"),
            F.col("l_partkey").cast("string").alias("insnum"),
            "airline",
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("double").alias("admnum"),
            F.concat(F.lit("F"), (F.col("l_suppkey") % 1000).cast("string")).alias("fltno"),
        )
    )


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return name_visits(raw_visits(spark, sf_dir))


def raw_regional_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw visits with the supplier's nation as port code, for tables with a folder per port."""
    return raw_visits(spark, sf_dir).withColumn(
        "i94port", F.col("i94res").cast("int").cast("string")
    )


def regional_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return name_visits(raw_regional_visits(spark, sf_dir))


def regional_ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A port per nation, in the state of a segment or none, as in the label text of the job."""
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("airport_code"),
        F.col("n_name").alias("city"),
        _segment("n_nationkey").alias("us_state_id"),
    )


def write_job_inputs(spark: SparkSession, sf_dir: str, path: str) -> list[str]:
    """The three inputs of the batch job made from the tables; returns their paths."""
    visits_path, cities_path, labels_path = (f"{path}/{x}" for x in ("visits", "cities", "labels"))
    raw_regional_visits(spark, sf_dir).write.parquet(visits_path)

    people = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    none = F.lit(None).cast("string")
    race = F.concat(F.lit("R"), (F.col("c_custkey") % 7).cast("string"))
    people.select(
        F.col("n_name").alias("City"),
        F.lower("c_mktsegment").alias("State"),
        *[none.alias(f"n{i}") for i in range(3)],
        F.col("c_custkey").alias("Total"),
        *[none.alias(f"n{i}") for i in range(3, 6)],
        F.col("c_mktsegment").alias("Code"),
        race.alias("Race"),
    ).write.csv(cities_path, sep=";", header=True)

    nations, lines = table(spark, sf_dir, "nation"), table(spark, sf_dir, "lineitem")
    modes, flags = lines.select("l_linenumber").distinct(), lines.select("l_returnflag").distinct()
    ports = regional_ports(spark, sf_dir)
    port_name = F.concat_ws(", ", "city", "us_state_id")
    sections = [
        (COUNTRY_SECTION, countries(spark, sf_dir), F.col("country_id"), F.col("country_name")),
        (PORT_SECTION, ports, F.col("airport_code"), port_name),
        (MODE_SECTION, modes, F.col("l_linenumber"),
         F.concat(F.lit("mode "), F.col("l_linenumber").cast("string"))),
        (STATE_SECTION, nations, F.col("n_name"), F.lower("n_name")),
        (VISA_SECTION, flags, F.position(F.col("l_returnflag"), F.lit("ANR")), F.col("l_returnflag")),
    ]
    for name, df, code, label in sections:
        position = F.pmod(F.xxhash64(code.cast("string")), F.lit(AFTER_ALL_PAIRS))
        text = label_lines(df, F.lit(name), position, quoted_pair(code, label), f"value {name}")
        # One file per section, with its lines in order.
        in_order = text.repartition(1).sortWithinPartitions("position").select("line")
        in_order.write.mode("append").text(labels_path)
    return [visits_path, cities_path, labels_path]


def ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One port per supplier; its city is a nation, its state a market segment or none."""
    return (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            port_code("s_suppkey").alias("airport_code"),
            F.col("n_name").alias("city"),
            _segment("s_suppkey").alias("us_state_id"),
        )
    )


def spelled_ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same ports with their states in six ways: as code, as name, as name with blanks, after the city without a
    comma, as a place that is no state, and not at all. Their names are those of ``named_states``."""
    way = F.col("s_suppkey") % 6
    state = F.get(F.array(*[F.lit(name) for name in SEGMENTS]), (F.col("s_suppkey") % 5).cast("int"))
    written = (
        F.when(way == 0, state)
        .when(way == 1, F.concat(F.lit("state of "), F.lower(state)))
        .when(way == 2, F.concat(F.lit("State  Of "), F.initcap(state)))
        .when(way == 4, "FAR AWAY")
    )
    return (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            port_code("s_suppkey").alias("airport_code"),
            F.when(way == 3, F.concat_ws(" ", "n_name", state)).otherwise(F.col("n_name")).alias("city"),
            written.alias("us_state_id"),
        )
    )


def demography(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Population of a nation and segment: its customers with a high balance, perhaps none."""
    return (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("n_name").alias("city"), F.col("c_mktsegment").alias("state_id"))
        .agg(F.count_if(F.col("c_acctbal") > 9000).cast("int").alias("total_population"))
    )


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments that customers have, less one that stays unknown."""
    return (
        table(spark, sf_dir, "customer")
        .where(F.col("c_mktsegment") != "MACHINERY")
        .select(
            F.col("c_mktsegment").alias("us_state_id"),
            F.lower("c_mktsegment").alias("us_state_name"),
        )
        .distinct()
    )


def named_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The states under names that are not their codes in other letters."""
    name = F.concat(F.lit("State of "), F.initcap("us_state_name"))
    return states(spark, sf_dir).withColumn("us_state_name", name)


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as countries, less every seventh, so that some keys have no country."""
    return (
        table(spark, sf_dir, "nation")
        .where(F.col("n_nationkey") % 7 != 0)
        .select(
            F.col("n_nationkey").alias("country_id"), F.col("n_name").alias("country_name")
        )
    )


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _segment(key: str) -> Column:
    return F.get(F.array(*[F.lit(name) for name in SEGMENTS]), (F.col(key) % 6).cast("int"))


def port_code(key: str) -> Column:
    return F.concat(F.lit("P"), F.col(key).cast("string"))


def label_lines(
    df: DataFrame, source: Column, position: Column, line: Column, start: str
) -> DataFrame:
    """Label text with one section per source: a heading, one line per row, and the end."""
    text = df.select(
        source.alias("source"), position.cast("bigint").alias("position"), line.alias("line")
    )
    frame = F.array(
        _line(-3, "/* codes, = and names */"),
        _line(-2, start),
        _line(-1, "   not a pair"),
        _line(AFTER_ALL_PAIRS, " ;"),
        _line(AFTER_ALL_PAIRS + 1, " 0 = 'outside' ;"),
        _line(AFTER_ALL_PAIRS + 2, "run ;"),
    )
    framing = text.select("source").distinct().select("source", F.inline(frame))
    return text.unionByName(framing)


def part_names(parts: DataFrame) -> Column:
    """Name and type of a part as a port name; without a comma for every tenth size."""
    separator = F.when(F.col("p_size") % 10 == 0, " ").otherwise(", ")
    return F.concat("p_name", separator, "p_type", F.lit("  "))


def quoted_pair(code: Column, name: Column) -> Column:
    quote = F.lit("'")
    return F.concat(
        F.lit("\t"), quote, code.cast("string"), quote, F.lit("\t=\t"), quote, name, quote
    )


def _line(position: int, line: str) -> Column:
    return F.struct(
        F.lit(position).cast("bigint").alias("position"), F.lit(line).alias("line")
    )
