"""What the physical plans must and must not hold."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from visitlake import fixtures as fx
from visitlake.plans import analytics
from visitlake.plans.star import immigration_facts
from visitlake.fixed import LABEL_SECTIONS, VISITS
from visitlake.operators import label_pairs
from visitlake.sinks import write_visits
from visitlake.sources import read_label_lines, read_months, read_visits

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lake_root(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    write_visits(
        spark.range(400).select(
            F.col("id").cast("double").alias("citizen_id"),
            (2015 + F.col("id") % 2).cast("int").alias("year"),
            (1 + F.col("id") % 4).cast("int").alias("month"),
            F.when(F.col("id") % 3 == 0, "NYC").otherwise("MIA").alias("airport_code"),
            (F.col("id") % 5).cast("double").alias("citizen_country_id"),
        ),
        root,
    )
    return root


@pytest.fixture(scope="module")
def lake(spark, lake_root):
    return read_visits(spark, lake_root)


def scan_part(text, part):
    return re.findall(part + r": \[([^\]]*)\]", text)


def test_month_is_a_partition_filter(lake):
    counts = analytics.count_visits(lake.where("month = 4"), "airport_code")
    assert "month" in scan_part(plan(counts), "PartitionFilters")[0]
    assert "ReadSchema: struct<>" in plan(counts)


def test_last_month_is_a_partition_filter(lake):
    text = plan(analytics.in_last_month(lake))
    assert "Subquery" in scan_part(text, "PartitionFilters")[0]


def test_last_month_from_the_month_table_reads_no_unfiltered_visits(spark, lake, lake_root):
    months = read_months(spark, lake_root)
    text = plan(analytics.in_last_month(lake, months))
    scans = [line for line in text.split("\n") if "FileScan" in line and VISITS in line]
    assert scans and all("PartitionFilters: [isnotnull" in line for line in scans)
    assert {row.month for row in analytics.in_last_month(lake, months).collect()} == {4}


def test_label_text_is_scanned_twice(spark, tmp_path):
    """Once for the bounds of the sections, once for the pairs."""
    (tmp_path / "labels.txt").write_text("value i94model\n 1 = 'Air' ;\n")
    lines = read_label_lines(spark, str(tmp_path))
    text = plan(label_pairs(lines, LABEL_SECTIONS))
    assert text.count("FileScan") == 2


def test_port_is_a_partition_filter(spark, lake):
    countries = spark.createDataFrame([(1, "ONE")], "country_id int, country_name string")
    text = plan(analytics.top_countries(lake, countries, "NYC"))
    assert "NYC" in scan_part(text, "PartitionFilters")[0]
    assert "struct<citizen_country_id:double>" in text


def test_top_k_is_not_a_full_sort(spark, lake):
    ports = spark.createDataFrame(
        [("NYC", "NEW YORK", "NY")], "airport_code string, city string, us_state_id string"
    )
    assert "TakeOrderedAndProject" in plan(analytics.top_ports(lake, ports))


def test_copies_are_dropped_before_the_shuffle(spark):
    raw = fx.raw_visits(spark, SF_DIR)
    lines = [line for line in plan(immigration_facts(raw)).split("\n")]
    steps = [
        step
        for line in lines
        for step in ("HashAggregate", "Exchange hashpartitioning(cicid")
        if step in line
    ]
    assert steps[:3] == ["HashAggregate", "Exchange hashpartitioning(cicid", "HashAggregate"]


def test_groups_are_cut_before_the_shuffle(spark):
    text = plan(contract.queries()["visit_share_by_name"](spark, SF_DIR))
    assert text.count("row_number(), 5, Partial") == 2
