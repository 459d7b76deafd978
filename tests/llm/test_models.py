"""Held-out accuracy of the trained models, their linear-time forms, and edge cases."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from visitlake.llm import language, quality_fm, queries
from visitlake.llm.textbytes import texts_of, word_hashes, word_spans

SF_DIR = "/root/testdata/sf0.01"


def test_language_held_out(spark):
    rows = queries.op1_language(spark, SF_DIR).collect()
    true = {r["doc_id"]: r["lang"] for r in queries.table(spark, SF_DIR, "documents").collect()}
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(true) and 0.15 < len(held) / len(rows) < 0.35
    assert np.mean([true[r["doc_id"]] == r["lang_pred"] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_edges(spark, edge_docs, no_docs):
    docs = edge_docs.withColumn("lang", F.coalesce("lang", F.lit("en")))
    model = language.train(docs, "doc_id", "text", "lang", F.lit(True))
    rows = language.predict(edge_docs, "doc_id", "text", model).collect()
    texts = {r["doc_id"]: r["text"] for r in edge_docs.collect()}
    for row in rows:
        letters = any(c.isalpha() for c in texts[row["key"]] or "")
        assert (row["lang_pred"] == "und") == (not letters)
    untaught = language.train(no_docs, "doc_id", "text", "lang", F.lit(True))
    assert {r["lang_pred"] for r in language.predict(edge_docs, "doc_id", "text", untaught).collect()} == {"und"}
    assert language.predict(no_docs, "doc_id", "text", model).count() == 0


def test_gram_buckets_stay_in_their_text():
    together, firsts = language.gram_buckets(["ab", "", None, "abcab", "É"])
    for text, i in (("ab", 0), ("abcab", 3), ("é", 4)):
        alone, _ = language.gram_buckets([text])
        for n in range(language.LONGEST):
            assert together[n][firsts[n][i] : firsts[n][i + 1]].tolist() == alone[n].tolist()


def test_ftrl_is_sparse_and_calibrated():
    draw = np.random.default_rng(2)
    examples = [(np.array([label, 10 + draw.integers(0, 500)]), np.array([1.0, 0.05]), label) for label in draw.integers(0, 3, 600)]
    weights, bias = language.fit_ftrl(examples, 3)
    assert np.count_nonzero(weights) < weights.size / 10
    assert all((x @ weights[b] + bias).argmax() == label for b, x, label in examples)
    loose = [(np.array([0]), np.array([1.0]), int(draw.random() < 0.2)) for _ in range(500)]
    steep = np.zeros((language.BUCKETS, 2))
    steep[0, 0] = 12.0
    assert language.fit_temperature(loose, steep, np.zeros(2)) > 3


def test_quality_held_out(spark):
    scored = {r["doc_id"]: r for r in queries.op8_quality(spark, SF_DIR).collect()}
    labels = [r for r in queries.table(spark, SF_DIR, "labels").collect() if scored[r["doc_id"]]["held_out"]]
    assert np.mean([scored[r["doc_id"]]["predicted"] == r["quality"] for r in labels]) > 0.9
    kept = [scored[r["doc_id"]]["predicted"] for r in labels if r["quality"] == 1]
    assert np.mean(kept) > 0.97


def test_pair_term_is_the_sum_over_pairs():
    draw = np.random.default_rng(3)
    size = quality_fm.BUCKETS + quality_fm.STATS
    model = quality_fm.Model(
        0.3, draw.normal(size=size), draw.normal(size=(size, 3)), np.zeros(quality_fm.STATS), np.ones(quality_fm.STATS)
    )
    stats = draw.normal(size=(2, quality_fm.STATS))
    buckets, first = np.array([5, 9, 77, 5]), np.array([0, 3, 4])
    got = quality_fm.raw_scores(model, buckets, first, stats)
    for row in range(2):
        own = buckets[first[row] : first[row + 1]]
        index = [*own, *range(quality_fm.BUCKETS, size)]
        x = [*[1 / np.sqrt(len(own))] * len(own), *stats[row]]
        want = model.bias + sum(model.linear[i] * v for i, v in zip(index, x))
        for a in range(len(index)):
            for b in range(a):
                want += model.factors[index[a]] @ model.factors[index[b]] * x[a] * x[b]
        assert got[row] == pytest.approx(want)


def test_quality_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(0, 1), (0, 0), (1, None), (None, 1), (99, 1), (7, 1)], "doc_id long, quality int")
    model = quality_fm.train(edge_docs, labels, "doc_id", "text", "n_chars", "quality", F.lit(True))
    rows = quality_fm.score(edge_docs, "text", "n_chars", model, ["doc_id", "score"], "quality").collect()
    assert len(rows) == edge_docs.count() and all(0 <= r["quality"] <= 1 for r in rows)
    assert quality_fm.score(no_docs, "text", "n_chars", model, ["doc_id"]).count() == 0
    none = quality_fm.train(edge_docs, labels.limit(0), "doc_id", "text", "n_chars", "quality", F.lit(True))
    assert {r["score"] for r in quality_fm.score(edge_docs, "text", "n_chars", none, ["doc_id"]).collect()} == {0.5}


def test_words_of_many_texts():
    draw = random.Random(1)
    texts = ["".join(draw.choice("ab é\t\n\x0b ") for _ in range(draw.randint(0, 12))) for _ in range(300)] + [None, "", " ", "x"]
    own = texts_of(pa.array(texts, pa.string()).slice(3))
    begins, ends, first = word_spans(own)
    import re

    for i, text in enumerate(texts[3:]):
        got = [bytes(own.data[b:e]) for b, e in zip(begins[first[i] : first[i + 1]], ends[first[i] : first[i + 1]])]
        assert got == [w.encode() for w in re.findall("[^\x20\x09-\x0d]+", text or "")]
    hashes, first = word_hashes(texts_of(pa.array(["Ab ab É é", "ab"])))
    assert hashes[0] == hashes[1] == hashes[4] and hashes[2] != hashes[3]


def test_samples_have_one_row_of_each_id(spark, monkeypatch):
    """One id with very many rows, labelled and chosen."""
    sent = []
    real = quality_fm.fit

    def fit(rows, *more):
        sent.append(len(rows))
        return real(rows, *more)

    monkeypatch.setattr(quality_fm, "fit", fit)
    rows = [(7, f"some words {i}", "en", 1) for i in range(300)] + [(8, "other words", "fr", 1), (9, None, "en", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long")
    labels = spark.createDataFrame([(7, 1), (8, 0), (9, 1)], "doc_id long, quality int")
    quality_fm.train(docs, labels, "doc_id", "text", "n_chars", "quality", F.lit(True))
    assert sent == [3]
    model = language.train(docs, "doc_id", "text", "lang", F.lit(True))
    assert model.languages == ["en", "fr"]
