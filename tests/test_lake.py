"""Sinks, typed read-back, month refresh and the whole job."""

import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from visitlake.__main__ import main as command
from visitlake.fixed import (
    COUNTRIES,
    DEMOGRAPHY,
    MODES,
    PORTS,
    STATES,
    VISAS,
    VISIT_FIELDS,
    VISITS,
)
from visitlake.plans.pipeline import (
    DataQualityError,
    refresh_demography,
    refresh_visits,
    run,
    star_orphans,
    star_report,
)
from visitlake.scratch import ensure_checkpoint_dir, join_path, new_scratch_path
from visitlake.sinks import refresh_month, write_visits
from visitlake.sources import read_demography, read_months, read_star, read_visits

RAW_SCHEMA = ", ".join(
    f"{name} {'string' if kind == 'string' else 'double'}" for name, _, kind in VISIT_FIELDS
)

LABELS = """/* countries */
  value i94cntyl
   582 =  'MEXICO'
   236 =  'AFGHANISTAN '
   914 =  'No Country Code (914)' ;
  value $i94prtl
   'NYC'\t=\t'NEW YORK, NY  '
   '060'\t=\t'MARIPOSA AZ   '
;
value i94model
\t1 = 'Air'
\t9 = 'Not reported' ;
value i94addrl
\t'NY'='NEW YORK'
\t'99'='All Other Codes' ;
/* I94VISA - Visa codes:
   1 = Business
*/
run ;
"""

CITIES = """City;State;Median Age;Male;Female;Total;Veterans;Foreign-born;Size;Code;Race;Count
New York;New York;36.0;1;2;3;4;5;2.5;NY;White;10
New York;New York;36.0;1;2;3;4;5;2.5;NY;Asian;20
Bend;Oregon;;x;2;3;4;5;;OR;White;30
"""


def visit(number, port="NYC", month=4, country=582.0, **other):
    values = {
        "cicid": float(number),
        "i94yr": 2016.0,
        "i94mon": float(month),
        "i94port": port,
        "i94addr": "NY",
        "arrdate": 20545.0,
        "depdate": None,
        "i94mode": 1.0,
        "i94visa": 1.0,
        "i94cit": country,
        "i94res": 582.0,
        **other,
    }
    return tuple(values.get(name) for name, _, _ in VISIT_FIELDS)


@pytest.fixture
def inputs(spark, tmp_path):
    """Writes the three inputs; returns their paths and the target."""

    def write(visits, labels=LABELS, cities=CITIES):
        raw = spark.createDataFrame(visits, RAW_SCHEMA).withColumn("matflag", F.lit("M"))
        raw.write.parquet(str(tmp_path / "visits"))
        (tmp_path / "cities.csv").write_text(cities)
        (tmp_path / "labels.txt").write_text(labels)
        return [str(tmp_path / name) for name in ("visits", "cities.csv", "labels.txt", "lake")]

    return write


def test_job(spark, inputs):
    paths = inputs([visit(1), visit(1), visit(2, "060", country=7.0), visit(3, None, month=3)])
    report = run(spark, *paths).collect()
    counts = {row.table_name: row.row_count for row in report if row.measure == "rows"}
    measures = {row.measure: row.row_count for row in report if row.measure != "rows"}
    assert {name for name, count in measures.items() if count} == {
        "empty airport_code", "orphan citizen_country_id"
    }
    assert counts == {
        VISITS: 3,
        DEMOGRAPHY: 2,
        MODES: 2,
        COUNTRIES: 3,
        VISAS: 1,
        STATES: 1,
        PORTS: 2,
    }

    star = read_star(spark, paths[-1])
    assert [tuple(r) for r in star[COUNTRIES].orderBy("country_id").collect()] == [
        (236, "AFGHANISTAN "),
        (582, "MEXICO"),
        (914, "NA"),
    ]
    assert {tuple(row) for row in star[PORTS].collect()} == {
        ("NYC", "NEW YORK", "NY"),
        ("060", "MARIPOSA AZ", None),
    }
    facts = star[VISITS].orderBy("citizen_id").collect()
    assert [(row.airport_code, row.month) for row in facts] == [("NYC", 4), ("060", 4), (None, 3)]
    assert facts[0].arrival_date == datetime.date(2016, 4, 1)
    assert facts[0].departure_date is None

    passed = {row.table_name: row.is_unique for row in star_report(star).collect()}
    assert passed == {table: None if table == VISITS else True for table in counts}
    orphans = {(row.column_name, row.key) for row in star_orphans(star).collect()}
    assert orphans == {("airport_code", None), ("citizen_country_id", "7.0")}


def test_command(spark, inputs, monkeypatch, capsys):
    paths = inputs([visit(1), visit(2)])
    monkeypatch.setattr("sys.argv", ["visitlake", *paths])
    command()
    assert "immigration_facts  |rows                     |2" in capsys.readouterr().out
    assert read_visits(spark, paths[-1]).count() == 2


def test_job_again_replaces_everything(spark, inputs, tmp_path):
    paths = inputs([visit(1), visit(2, "060")])
    run(spark, *paths)
    spark.createDataFrame([visit(5)], RAW_SCHEMA).write.parquet(str(tmp_path / "newer"))
    run(spark, str(tmp_path / "newer"), *paths[1:])
    assert [row.citizen_id for row in read_visits(spark, paths[-1]).collect()] == [5.0]


def test_refresh_of_one_input(spark, inputs, tmp_path):
    paths = inputs([visit(1, month=3), visit(2), visit(3, "060")])
    run(spark, *paths)
    newer = str(tmp_path / "newer")
    raw = [visit(7), visit(7), visit(8, month=3)]
    spark.createDataFrame(raw, RAW_SCHEMA).write.parquet(newer)
    report = {r.measure: r.row_count for r in refresh_visits(spark, newer, paths[-1], 2016, 4).collect()}
    assert (report["rows"], report["records of other months"]) == (1, 1)
    ids = {row.citizen_id for row in read_visits(spark, paths[-1]).collect()}
    assert ids == {1.0, 7.0}
    with pytest.raises(DataQualityError):
        refresh_visits(spark, newer, paths[-1], 2016, 5)

    (tmp_path / "cities2.csv").write_text(CITIES + "Reno;Nevada;1;1;1;1;1;1;1;NV;White;1\n")
    assert refresh_demography(spark, str(tmp_path / "cities2.csv"), paths[-1]) == 3
    assert read_star(spark, paths[-1])[DEMOGRAPHY].count() == 3


@pytest.mark.parametrize(
    "change, message",
    [
        ({"visits": []}, "immigration_facts: 0 rows"),
        ({"labels": LABELS.replace("'060'", "'NYC'")}, "dim_airport_codes: 2 rows"),
        ({"labels": LABELS.replace("236", "x").replace("914", "y")}, "dim_country: 3 rows"),
        ({"labels": LABELS.replace("i94model", "mode")}, "i94model: section not found"),
        ({"labels": LABELS.replace("run ;", "run")}, "I94VISA: section not closed"),
        ({"labels": LABELS.replace("1 = Business", "")}, "dim_visa_category: 0 rows"),
        ({"cities": CITIES.split("\n")[0] + "\n"}, "dim_city_demography: 0 rows"),
    ],
)
def test_job_stops_before_it_writes(spark, inputs, change, message):
    paths = inputs(**{"visits": [visit(1)], **change})
    with pytest.raises(DataQualityError, match=message):
        run(spark, *paths)
    assert not Path(paths[-1]).exists()


def test_job_names_all_failed_tables(spark, inputs):
    labels = LABELS.replace("'060'", "'NYC'").replace("1 = Business", "")
    with pytest.raises(DataQualityError, match="dim_visa_category.*dim_airport_codes"):
        run(spark, *inputs([visit(1)], labels))


def test_city_file_cells(spark, tmp_path):
    (tmp_path / "cities.csv").write_text(CITIES)
    cities = read_demography(spark, str(tmp_path)).orderBy("city", "race").collect()
    assert len(cities) == 3 and len(cities[0]) == 11
    bend = cities[0]
    assert (bend.median_age, bend.male_population, bend.female_population) == (None, None, 2)
    assert (bend.average_household_size, bend.state_id, bend.race) == (None, "OR", "White")


def facts(spark, rows):
    return spark.createDataFrame(
        rows, "citizen_id double, year int, month int, airport_code string"
    )


def read_back(spark, root):
    rows = read_visits(spark, root).select("citizen_id", "year", "month", "airport_code")
    return sorted(map(tuple, rows.collect()), key=repr)


def test_port_codes_of_digits_stay_text(spark, tmp_path):
    rows = [(1.0, 2016, 4, "060"), (2.0, 2016, 4, "888"), (3.0, 2016, 4, None), (4.0, None, 4, "A")]
    write_visits(facts(spark, rows), str(tmp_path))
    assert read_back(spark, str(tmp_path)) == sorted(rows, key=repr)


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_month_refresh_drops_a_port_without_rows(spark, tmp_path, mode):
    root = str(tmp_path) + "/"
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    march = [(1.0, 2016, 3, "A"), (2.0, 2016, 3, "B")]
    write_visits(facts(spark, [*march, (3.0, 2016, 4, "A"), (4.0, 2016, 4, "B")]), root)
    newer = [(9.0, 2016, 4, "A"), (8.0, 2016, 3, "C")]
    for _ in range(2):
        assert refresh_month(facts(spark, newer), root, 2016, 4) == 1
        assert read_back(spark, root) == [*march, newer[0]]
    write_visits(facts(spark, march), root)
    assert read_back(spark, root) == march
    spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_month_refresh_without_rows_empties_the_month(spark, tmp_path):
    rows = [(1.0, 2016, 3, "A"), (2.0, 2016, 4, "A")]
    assert write_visits(facts(spark, rows), str(tmp_path)) == 2
    assert refresh_month(facts(spark, rows[:1]), str(tmp_path), 2016, 4) == 0
    assert read_back(spark, str(tmp_path)) == rows[:1]


def test_one_large_folder_is_split(spark, tmp_path):
    rows = spark.range(60000).select(
        F.col("id").cast("double").alias("citizen_id"),
        F.lit(2016).alias("year"),
        F.lit(4).alias("month"),
        F.when(F.col("id") % 100 == 0, "B").otherwise("A").alias("airport_code"),
        F.sha2(F.col("id").cast("string"), 256).alias("airline"),
    )
    written = write_visits(rows.repartition(20), str(tmp_path), 16)
    folder = tmp_path / VISITS / "year=2016" / "month=4"
    assert len(list((folder / "airport_code=A").glob("*.parquet"))) > 10
    assert len(list((folder / "airport_code=B").glob("*.parquet"))) <= 2
    assert written == read_visits(spark, str(tmp_path)).count() == 60000


@pytest.mark.parametrize("partitions", [3, 20])
def test_files_are_folders_and_partitions_at_most(spark, tmp_path, partitions):
    """More folders than partitions or fewer, and a port with 40 % of the rows."""
    port = F.when(F.col("id") % 5 < 2, 0).otherwise(F.col("id") % 9 + 1).cast("string")
    rows = spark.range(6000).select(
        F.col("id").cast("double").alias("citizen_id"),
        F.lit(2016).alias("year"),
        (1 + F.col("id") % 2).cast("int").alias("month"),
        port.alias("airport_code"),
    )
    write_visits(rows.repartition(7), str(tmp_path), partitions)
    files = list((tmp_path / VISITS).glob("*/*/*/*.parquet"))
    folders = {file.parent for file in files}
    assert len(folders) <= len(files) <= len(folders) + partitions - 1
    assert read_visits(spark, str(tmp_path)).count() == 6000


def test_load_and_refresh_agree_on_odd_values(spark, inputs, tmp_path):
    """Fractions, NaN and text are no year or month; an empty port is none; other text stays."""
    nan = float("nan")
    odd = [visit(1), visit(2, month=4.5), visit(3, i94yr=nan), visit(4, ""), visit(5, i94yr=2016.9), visit(6, month=3)]
    paths = inputs(odd)
    raw = spark.createDataFrame(odd, RAW_SCHEMA)
    raw = raw.withColumn("admnum", F.concat(F.lit("A0"), F.col("cicid").cast("int").cast("string")))
    raw.write.mode("overwrite").parquet(paths[0])
    report = {r.measure: r.row_count for r in run(spark, *paths).collect() if r.table_name == VISITS}
    assert report["unreadable month"] == 1 and report["unreadable year"] == 2
    assert report["blank airport_code"] == 1
    loaded = read_visits(spark, paths[-1])
    assert sorted(r.admin_num for r in loaded.collect()) == [f"A0{i}" for i in range(1, 7)]
    april = sorted(map(tuple, loaded.where("year = 2016 and month = 4").collect()), key=repr)
    months = {(r.year, r.month): r.visits for r in read_months(spark, paths[-1]).collect()}
    assert months == {(2016, 4): 2, (2016, None): 1, (None, 4): 2, (2016, 3): 1}
    for _ in range(2):
        refreshed = refresh_visits(spark, paths[0], paths[-1], 2016, 4)
        left_out = {r.measure: r.row_count for r in refreshed.collect()}["records of other months"]
        assert left_out == 4
        again = read_visits(spark, paths[-1])
        assert sorted(map(tuple, again.where("year = 2016 and month = 4").collect()), key=repr) == april
        assert {(r.year, r.month): r.visits for r in read_months(spark, paths[-1]).collect()} == months


def test_label_folder_with_a_file_per_section(spark, inputs, tmp_path):
    paths = inputs([visit(1)])
    folder = tmp_path / "labels"
    folder.mkdir()
    parts = LABELS.replace(";\n", ";\n\0").split("\0")
    for number, text in enumerate(parts):
        (folder / f"{number}.txt").write_text(text)
    counts = {r.table_name: r.row_count for r in run(spark, *paths[:2], str(folder), paths[-1]).collect() if r.measure == "rows"}
    assert (counts[COUNTRIES], counts[PORTS], counts[MODES], counts[STATES], counts[VISAS]) == (3, 2, 2, 1, 1)
    (folder / "2.txt").write_text("value i94model\n 1 = 'Air'\n")
    with pytest.raises(DataQualityError, match="2.txt: i94model: section not closed"):
        run(spark, *paths[:2], str(folder), paths[-1])


def test_all_failures_at_once(spark, inputs):
    labels = LABELS.replace("i94model", "mode").replace("'060'", "'NYC'")
    with pytest.raises(DataQualityError) as error:
        run(spark, *inputs([], labels))
    for part in ("i94model: section not found", "immigration_facts: 0 rows", "dim_airport_codes: 2 rows"):
        assert part in str(error.value)


def test_job_leaves_no_scratch_behind(spark, inputs):
    root = ensure_checkpoint_dir(spark)
    folder = Path(root.removeprefix("file:"))
    before = set(folder.glob("*")) if folder.exists() else set()
    paths = inputs([visit(1), visit(2)])
    run(spark, *paths)
    refresh_visits(spark, paths[0], paths[-1], 2016, 4)
    with pytest.raises(DataQualityError):
        run(spark, paths[0], paths[1], paths[1], paths[-1])
    assert set(folder.glob("*")) <= before


def test_scratch_paths_are_new_and_in_the_session_folder(spark):
    folder = ensure_checkpoint_dir(spark)
    paths = {new_scratch_path(spark, "x") for _ in range(3)}
    assert len(paths) == 3 and all(path.startswith(folder.rstrip("/")) for path in paths)


def test_join_path():
    assert join_path("s3a://bucket/lake/", "t") == join_path("s3a://bucket/lake", "t")
