"""Publishing: a lake changes as a whole or not at all."""

from pathlib import Path

import pytest
from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from test_lake import CITIES, LABELS, RAW_SCHEMA, inputs, visit  # noqa: F401
from visitlake import versions
from visitlake.fixed import DEMOGRAPHY, PORTS, VISIT_COUNTS, VISITS
from visitlake.operators import label_pairs
from visitlake.operators.labels import label_rejects
from visitlake.operators.ports import resolve_ports, unmatched_ports
from visitlake.plans import analytics
from visitlake.plans.pipeline import (
    DataQualityError,
    append_visits,
    load_visits,
    refresh_demography,
    refresh_visits,
    run,
)
from visitlake.sinks.records import distinct_records
from visitlake.sources import (
    read_counts,
    read_dimension,
    read_label_lines,
    read_months,
    read_star,
    read_visits,
)
from visitlake.sources.demography import bad_city_cells

ODD = [
    visit(1), visit(1), visit(2, "060"), visit(3, None, month=3), visit(4, month=4.5), visit(5, i94yr=float("nan")),
    visit(6, ""), visit(7, arrdate=0.0), visit(7, arrdate=None), visit(7, arrdate=1e12), visit(8, i94mode=-0.0), visit(8, i94mode=0.0),
    visit(9, gender="M", airline=None), visit(9, gender=None, airline="M"),
]


def raw(spark, rows):
    return spark.createDataFrame(rows, RAW_SCHEMA)


def written(spark, rows, path):
    raw(spark, rows).write.parquet(str(path))
    return str(path)


def content(df):
    return sorted((tuple(map(repr, row)) for row in df.collect()))


def state(spark, root):
    """Everything a reader sees."""
    star = {table: content(df) for table, df in read_star(spark, root).items()}
    return star, content(read_months(spark, root)), content(read_counts(spark, root))


class Killed(BaseException):
    """Not an Exception, like the end of a process."""


def test_job_killed_at_any_write_leaves_the_old_lake(spark, inputs, tmp_path, monkeypatch):
    paths = inputs([visit(1), visit(2, month=3)])
    run(spark, *paths)
    before = state(spark, paths[-1])
    newer = written(spark, [visit(5), visit(6, "060")], tmp_path / "newer")
    (tmp_path / "cities.csv").write_text(CITIES + "Reno;Nevada;1;1;1;1;1;1;1;NV;White;1\n")
    real_write, real_publish = DataFrameWriter.parquet, versions.publish
    monkeypatch.setattr(versions.Staged, "drop", lambda self: None)  # a killed job cleans nothing up

    def job(steps):
        """Ends the job before its write number ``steps``, or in the midst of publishing."""
        done = []

        def write(self, *args, **more):
            done.append(args)
            if len(done) > steps:
                raise Killed
            return real_write(self, *args, **more)

        def publish(spark, root, version, base):
            if steps == 99:
                return real_publish(spark, root, version, base)
            number = version.number + 1
            path = Path(root) / versions.VERSIONS / f"{number:012d}.json"
            path.write_text(version.to_json()[: len(version.to_json()) // 2])
            raise Killed

        with monkeypatch.context() as patch:
            patch.setattr(DataFrameWriter, "parquet", write)
            patch.setattr(versions, "publish", publish)
            run(spark, newer, *paths[1:])
        return len(done)

    for steps in (0, 3, 8, 9, 50):
        with pytest.raises(Killed):
            job(steps)
        assert state(spark, paths[-1]) == before
    assert job(99) == 10  # label lines and pairs, six dimensions, visits and their counts
    after = state(spark, paths[-1])
    assert after != before and len(after[0][VISITS]) == 2 and len(after[0][DEMOGRAPHY]) == 3
    removed = versions.vacuum(spark, paths[-1], keep=1)
    assert removed and state(spark, paths[-1]) == after
    assert len([name for name in removed if name.startswith(VISITS)]) == 3
    assert versions.vacuum(spark, paths[-1], keep=1) == []


def test_failed_audit_publishes_nothing(spark, inputs):
    paths = inputs([visit(1)])
    run(spark, *paths)
    before, files = state(spark, paths[-1]), sorted(Path(paths[-1]).rglob("*.parquet"))
    seen = []

    def audit(report):
        seen.extend(report)
        return ["too few visits"]

    with pytest.raises(DataQualityError, match="too few visits"):
        run(spark, *paths, audit=audit)
    assert (VISITS, "rows", 1) in seen
    assert state(spark, paths[-1]) == before and sorted(Path(paths[-1]).rglob("*.parquet")) == files


def test_of_two_writers_the_later_fails(spark, tmp_path):
    root = str(tmp_path / "lake")
    load_visits(spark, raw(spark, [visit(1)]), root)
    slow = versions.Staged(spark, root)
    load_visits(spark, raw(spark, [visit(2)]), root)
    slow.table(spark.range(1), PORTS)
    with pytest.raises(versions.PublishConflict):
        slow.publish()
    slow.drop()
    assert [row.citizen_id for row in read_visits(spark, root).collect()] == [2.0]
    assert not (tmp_path / "lake" / PORTS).exists()


def test_readers_of_a_version_keep_it(spark, tmp_path):
    root = str(tmp_path / "lake")
    load_visits(spark, raw(spark, [visit(1), visit(2, month=3)]), root)
    open_before = read_visits(spark, root)
    refresh_visits(spark, written(spark, [visit(9)], tmp_path / "newer"), root, 2016, 4)
    assert sorted(row.citizen_id for row in open_before.collect()) == [1.0, 2.0]
    assert sorted(row.citizen_id for row in read_visits(spark, root).collect()) == [2.0, 9.0]
    assert content(read_months(spark, root)) == [("2016", "3", "1"), ("2016", "4", "1")]


def test_append_equals_a_load_of_all(spark, tmp_path):
    """Copies, unreadable fields that are null in the table, negative zero, and shifted nulls."""
    whole, parts = str(tmp_path / "whole"), str(tmp_path / "parts")
    load_visits(spark, raw(spark, ODD), whole)
    load_visits(spark, raw(spark, ODD[:5] + ODD[8:9]), parts)
    for number, late in enumerate((ODD[3:10], ODD, ODD)):
        report = append_visits(spark, written(spark, late, tmp_path / f"late{number}"), parts).collect()
    measures = {row.measure: row.row_count for row in report}
    assert content(read_visits(spark, parts)) == content(read_visits(spark, whole))
    assert content(read_months(spark, parts)) == content(read_months(spark, whole))
    distinct = read_visits(spark, whole).count()
    assert distinct == 12 and measures["rows"] == 0 and measures["known visits"] == distinct
    assert versions.current_version(spark, parts).number == 3  # the last one had nothing to add
    keys = ["year", "month", "airport_code", "citizen_country_id"]
    counted = analytics.count_visits(read_counts(spark, parts), *keys)
    assert content(counted) == content(analytics.count_visits(read_visits(spark, whole), *keys))
    refresh_visits(spark, str(tmp_path / "late2"), parts, 2016, 4)
    assert content(read_visits(spark, parts)) == content(read_visits(spark, whole))


def test_append_reads_only_prints_of_the_months(spark, tmp_path):
    root = str(tmp_path / "lake")
    load_visits(spark, raw(spark, [visit(1), visit(2, month=3), visit(3, month=5)]), root)
    version = versions.current_version(spark, root)
    prints = distinct_records(raw(spark, [visit(1)])).select("record_print_a", "record_print_b")
    stored = versions.read_months_of(spark, root, version, VISITS, prints.schema, only={(2016, 4)})
    assert stored.select(*prints.columns).count() == 1
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    late = spark.read.parquet(written(spark, [visit(1)], tmp_path / "late"))
    late = distinct_records(late).where("citizen_id > 0").select(*prints.columns)
    late.write.parquet(str(tmp_path / "prints"))
    late = spark.read.parquet(str(tmp_path / "prints")).where("record_print_a <> 5")
    plan = stored.select(*prints.columns).join(late, prints.columns, "left_semi")._jdf.queryExecution().optimizedPlan().toString()
    for name in settings:
        spark.conf.unset(name)
    assert "might_contain" in plan


def test_raw_visits_are_read_once(spark, inputs, monkeypatch):
    """Of all that the job computes from the raw records, one write scans them."""
    paths = inputs([visit(1), visit(2)])
    scans = []
    for method in ("collect", "count", "first", "isEmpty"):
        real = getattr(DataFrame, method)

        def spied(self, *args, real=real):
            scans.append(self._jdf.queryExecution().optimizedPlan().toString().count("i94port"))
            return real(self, *args)

        monkeypatch.setattr(DataFrame, method, spied)
    writes = []
    real_write = DataFrameWriter.parquet

    def write(self, *args, **more):
        writes.append(self._df._jdf.queryExecution().executedPlan().toString().count("i94port#"))
        return real_write(self, *args, **more)

    monkeypatch.setattr(DataFrameWriter, "parquet", write)
    run(spark, *paths)
    assert not any(scans) and sum(map(bool, writes)) == 1


def test_questions_from_the_counts_read_no_visit(spark, inputs):
    paths = inputs([visit(1), visit(1), visit(2, "060"), visit(3), visit(4, month=3, country=236.0)])
    run(spark, *paths)
    star, counts = read_star(spark, paths[-1]), read_counts(spark, paths[-1])
    asked = {
        "ports": lambda visits: analytics.top_ports_of_month(visits, star[PORTS], 4),
        "last": lambda visits: analytics.top_ports_of_last_month(visits, star[PORTS], months=read_months(spark, paths[-1])),
        "share": lambda visits: analytics.visit_share(visits, star[PORTS], star[DEMOGRAPHY], star["dim_us_states"]),
        "countries": lambda visits: analytics.top_countries(visits, star["dim_country"], "NYC"),
    }
    for question in asked.values():
        from_counts = question(counts)
        assert from_counts.collect() == question(star[VISITS]).collect()
        assert not any(f"/{VISITS}/" in path for path in from_counts.inputFiles())
    assert any(f"/{VISIT_COUNTS}/" in path for path in asked["ports"](counts).inputFiles())


def test_month_that_is_emptied(spark, tmp_path):
    """All visits of the only month turn out to be of another one: the refresh is refused."""
    root = str(tmp_path / "lake")
    load_visits(spark, raw(spark, [visit(1)]), root)
    with pytest.raises(DataQualityError):
        refresh_visits(spark, written(spark, [visit(1, month=5)], tmp_path / "newer"), root, 2016, 4)
    assert read_visits(spark, root).count() == 1
    with pytest.raises(DataQualityError):
        load_visits(spark, raw(spark, []), root)
    assert sorted(path.name for path in (tmp_path / "lake" / VISITS).iterdir()) == [
        name for month in versions.current_version(spark, root).months for name in month.writes
    ]


def test_refreshes_keep_the_other_tables(spark, inputs, tmp_path):
    paths = inputs([visit(1)])
    run(spark, *paths)
    before = state(spark, paths[-1])[0]
    (tmp_path / "cities2.csv").write_text(CITIES + "Reno;Nevada;1;1;1;1;1;1;1;NV;White;1\n")
    refresh_demography(spark, str(tmp_path / "cities2.csv"), paths[-1])
    after = state(spark, paths[-1])[0]
    assert {table for table in after if after[table] != before[table]} == {DEMOGRAPHY}
    assert read_dimension(spark, paths[-1], DEMOGRAPHY).count() == 3


def test_rejects(spark, inputs, tmp_path):
    labels = LABELS.replace("236", "x36").replace("1 = Business", "one = Business")
    paths = inputs([visit(1)], labels=labels)
    report = {(row.table_name, row.measure): row.row_count for row in run(spark, *paths, rejects=True).collect()}
    assert report[DEMOGRAPHY, "bad cells in male_population"] == 1
    assert report["dim_country", "codes that are no number"] == 1
    assert report["dim_visa_category", "codes that are no number"] == 1
    assert {row.column_name: row.bad_cells for row in bad_city_cells(spark, paths[1]).collect()} == {"male_population": 1}
    pairs = label_pairs(read_label_lines(spark, paths[2]), ["i94cntyl", "$i94prtl"])
    assert [(row.code, row.name) for row in label_rejects(pairs).collect()] == [("x36", "AFGHANISTAN ")]


def test_states_of_ports(spark):
    states = spark.createDataFrame([("AZ", "ARIZONA"), ("WA", "WASHINGTON"), ("NY", "NEW YORK"), ("X1", "AZ")], "us_state_id string, us_state_name string")
    rows = [
        ("A", "TUCSON", "AZ"), ("B", "SEATTLE", "washington"), ("C", "ALBANY", "New   York"), ("D", "MARIPOSA AZ", None),
        ("E", "SINGAPORE", "SINGAPORE"), ("F", "AZ", None), ("G", "LOST", None), ("H", None, None), ("I", "NOGALES", " az "),
    ]
    resolved = resolve_ports(spark.createDataFrame(rows, "airport_code string, city string, us_state_id string"), states)
    assert sorted(map(tuple, resolved.collect())) == [
        ("A", "TUCSON", "AZ", "code"), ("B", "SEATTLE", "WA", "name"), ("C", "ALBANY", "NY", "name"),
        ("D", "MARIPOSA", "AZ", "last word"), ("E", "SINGAPORE", "SINGAPORE", "unknown state"), ("F", "", "AZ", "last word"),
        ("G", "LOST", None, "no state"), ("H", None, None, "no state"), ("I", "NOGALES", "AZ", "code"),
    ]
    cities = spark.createDataFrame([("TUCSON", "AZ"), ("SEATTLE", "WA"), ("SEATTLE", "WA")], "city string, state_id string")
    visits = spark.createDataFrame([("C", 5), ("E", 2), ("A", 9)], "airport_code string, immigrant_visits long")
    report = {tuple(row) for row in unmatched_ports(resolved, cities, visits).collect()}
    assert report == {("no such city", 4, 5), ("unknown state", 1, 2), ("no state", 2, 0)}


def test_records_are_shuffled_once(spark, tmp_path, monkeypatch):
    """A load and an append of many late records move them in the one shuffle that deals them for the write."""
    moved = []
    real_write = DataFrameWriter.parquet

    def write(self, *args, **more):
        plan = self._df._jdf.queryExecution().executedPlan().toString()
        if f"/{VISITS}/" in str(args) or "late-records" in str(args):
            moved.append(plan.count("Exchange rangepartitioning") + plan.count("Exchange hashpartitioning"))
        return real_write(self, *args, **more)

    root, late = str(tmp_path / "lake"), written(spark, ODD, tmp_path / "late")
    monkeypatch.setattr(DataFrameWriter, "parquet", write)
    load_visits(spark, raw(spark, ODD[:3]), root)
    append_visits(spark, late, root)
    assert moved == [1, 1]


def test_few_late_records(spark, tmp_path):
    root = str(tmp_path / "lake")
    load_visits(spark, raw(spark, [visit(number) for number in range(9)]), root)
    late = written(spark, [visit(1), visit(20)], tmp_path / "late")
    measures = {row.measure: row.row_count for row in append_visits(spark, late, root).collect()}
    assert (measures["rows"], measures["known visits"]) == (1, 1)
    assert read_visits(spark, root).count() == 10
