"""The section job against a plain statement of its rule."""

import random

import pytest
from pyspark.sql import functions as F

from visitlake.fixed import LABEL_SECTIONS, MODE_SECTION, PORT_SECTION, VISA_SECTION
from visitlake.operators import label_pairs, section_faults
from visitlake.sources import read_label_lines

TEXT = """/* codes, a = b */
  value $i94prtl
   'INT'\t=\t'INT''L FALLS, MN  '
   'CP '\t=\t'X'
   'SKP' = 'a = b'
   a comment without the sign
   'END' = 'LAST' ; 'NOT' = 'IN'
value i94model
\t1 = 'Air'
\t9 = 'Not reported' ;
/* I94VISA - Visa codes:
   1 = Business
   2 = Pleasure
*/
/* I94VISA and i94model again */
 7 = 'late'
run ;
"""


def rule(text, name):
    """Pairs of one section, or None where it is missing or open."""
    before, found, after = text.partition(name)
    body, closed, rest = after.partition(";")
    if not found or not closed:
        return None
    pairs = [line.split("=") for line in (name + body).split("\n") if line.count("=") == 1]
    return [tuple(side.strip().strip("'") for side in pair) for pair in pairs]


def read(spark, folder, texts):
    for number, text in enumerate(texts):
        (folder / f"t{number}.txt").write_bytes(text.encode())
    return read_label_lines(spark, str(folder))


def pairs_by_text(df):
    """(text number, section) -> pairs in the order of the text."""
    number = F.regexp_extract("source", r"t(\d+)\.txt$", 1).cast("int")
    rows = df.select(number.alias("number"), "section", "position", "code", "name").collect()
    found = {}
    for row in sorted(rows, key=lambda row: (row.number, row.section, row.position)):
        found.setdefault((row.number, row.section), []).append((row.code, row.name))
    return found


def test_example(spark, tmp_path):
    pairs = pairs_by_text(label_pairs(read(spark, tmp_path, [TEXT]), LABEL_SECTIONS))
    assert pairs == {
        (0, PORT_SECTION): [("INT", "INT''L FALLS, MN  "), ("CP ", "X"), ("END", "LAST")],
        (0, MODE_SECTION): [("1", "Air"), ("9", "Not reported")],
        (0, VISA_SECTION): [("1", "Business"), ("2", "Pleasure"), ("7", "late")],
    }


def test_windows_line_ends(spark, tmp_path):
    lines = read(spark, tmp_path, [TEXT, TEXT.replace("\n", "\r\n")])
    pairs = pairs_by_text(label_pairs(lines, [PORT_SECTION]))
    assert pairs[(0, PORT_SECTION)] == pairs[(1, PORT_SECTION)] != []


def test_faults_are_listed_and_give_no_rows(spark, tmp_path):
    texts = [
        "value i94model\n 1 = 'Air' ;",
        "value i94model\n 1 = 'Air'",
        "; value\n 1 = 'Air' ;",
        "; i94model 1 = 'Air'",
    ]
    lines = read(spark, tmp_path, texts)
    faults = {
        (row.source[-6:], row.section): row.fault
        for row in section_faults(lines, [MODE_SECTION]).collect()
    }
    assert faults == {
        ("t1.txt", MODE_SECTION): "section not closed",
        ("t2.txt", MODE_SECTION): "section not found",
        ("t3.txt", MODE_SECTION): "section not closed",
    }
    assert pairs_by_text(label_pairs(lines, [MODE_SECTION])) == {
        (0, MODE_SECTION): [("1", "Air")]
    }


@pytest.mark.parametrize("seed", [1, 2])
def test_random_texts(spark, tmp_path, seed):
    """Texts of random pieces, read in splits of a few hundred bytes."""
    draw = random.Random(seed)
    pieces = ["i94model", "I94VISA", "i94", "=", " = ", ";", "'", "\n", "\n", "\n", "a", " ", "\t"]
    weights = [1, 1, 1, 6, 4, 1, 5, 8, 8, 8, 6, 4, 2]
    texts = [
        "".join(draw.choices(pieces, weights, k=draw.randint(1, 400))) for _ in range(120)
    ]
    names = [MODE_SECTION, VISA_SECTION]
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        lines = read(spark, tmp_path, texts)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    assert lines.select("source", "position.block").distinct().count() > len(texts)

    wanted = {(n, name): rule(text, name) for n, text in enumerate(texts) for name in names}
    assert pairs_by_text(label_pairs(lines, names)) == {k: v for k, v in wanted.items() if v}

    faults = section_faults(lines, names).select("source", "section").collect()
    listed = {(int(row.source.rsplit("/t", 1)[1][:-4]), row.section) for row in faults}
    assert listed == {key for key, pairs in wanted.items() if pairs is None}
    assert any(wanted.values()) and listed


def test_one_text_with_most_of_the_lines(spark):
    """A text that holds nearly all lines, over many partitions, with its lines in any order."""
    big = 30000
    body = spark.range(big).select(
        F.lit("big").alias("source"),
        F.col("id").alias("position"),
        F.concat(F.lit(" "), F.col("id").cast("string"), F.lit(" = 'n'")).alias("line"),
    )
    frame = spark.createDataFrame(
        [
            ("big", -1, "value i94model"),
            ("big", big, ";"),
            ("small", 0, "i94model"),
            ("small", 1, "1 = 'Air' ;"),
        ],
        "source string, position bigint, line string",
    )
    lines = body.unionByName(frame).repartition(16)
    counts = label_pairs(lines, [MODE_SECTION]).groupBy("source").count().collect()
    assert {row["source"]: row["count"] for row in counts} == {"big": big, "small": 1}
