"""Stages on the edge rows and the whole pipeline on the smallest tables."""

import pytest

import __spark_entry__ as contract
import corpus_pipeline as pipeline
from visitlake.llm import queries

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("name, stage", pipeline.STAGES[:-1], ids=lambda x: getattr(x, "__name__", None))
def test_stages_return_documents(spark, edge_docs, no_docs, name, stage):
    for docs in (edge_docs, no_docs):
        out = stage(spark, docs, SF_DIR)
        assert out.columns == pipeline.COLUMNS
        out.collect()


def test_one_of_each_group_stays(spark, edge_docs):
    kept = [r["doc_id"] for r in pipeline.one_of_each(spark, edge_docs, SF_DIR).collect()]
    assert kept.count(0) == 1 and kept.count(7) == 1 and kept.count(8) == 0
    assert not {1, 2, 3, 2000, 3000} & set(kept)
    assert {4, 5, 6, 9, 10, 13, 14, 17} <= set(kept)


def test_null_and_repeated_ids(spark):
    words = [[f"{name}{i}" for i in range(100)] for name in "abcdef"]
    text = [" ".join(w) for w in words]
    near = [" ".join([*w[:-1], "changed"]) for w in words]
    rows = [
        (None, text[0]), (None, text[0]), (None, near[0]),  # copies without an id
        (None, text[1]), (9, near[1]),  # an id comes before none
        (1, text[2]), (5, near[2]), (5, text[3]),  # one of the texts of id 5 is a copy of another's
        (6, text[4]), (6, near[4]),  # near copies of one id
        (None, None), (None, None), (None, " "), (7, ""), (7, ""), (7, None),  # nothing to be near to
    ]
    docs = spark.createDataFrame([(*row, "en", "s", 1) for row in rows] + [(1, text[2], "de", "s", 1)], DOCS)
    kept = sorted(((r["doc_id"], r["text"]) for r in pipeline.one_of_each(spark, docs, SF_DIR).collect()), key=repr)
    lone = [row for row in kept if row[0] is None and row[1] and row[1].strip()]
    six = [row for row in kept if row[0] == 6]
    assert len(lone) == 1 and lone[0][1] in (text[0], near[0])
    assert len(six) == 1 and six[0][1] in (text[4], near[4])
    rest = [(1, text[2]), (5, text[3]), (9, near[1]), (None, None), (None, None), (None, " "), (7, ""), (7, None)]
    assert kept == sorted([*lone, *six, *rest], key=repr)


def test_mix_repeats_rows(spark):
    docs = spark.createDataFrame([(i, "w " * 10, "en", "ab"[i % 2], 20) for i in range(40)], DOCS)
    out = pipeline.mixed(spark, docs, SF_DIR).collect()
    taken = {s: sum(10 for r in out if r["source"] == s) for s in "ab"}
    assert abs(taken["a"] - 400 * 5 / 7) <= 10 and abs(taken["b"] - 400 * 2 / 7) <= 10


def test_whole_pipeline(spark):
    first = sorted(map(tuple, pipeline.run(spark, SF_DIR).collect()))
    assert first and first == sorted(map(tuple, pipeline.run(spark, SF_DIR).collect()))


def test_registered():
    names = set(contract.queries())
    assert {f"op{n}" for n in range(1, 11)} <= {name.split("_")[0] for name in names} and "pipeline" in names
    assert set(queries.ORACLE_SQL) <= names
