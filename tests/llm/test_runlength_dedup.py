"""Removed bytes against all windows of the same rows."""

import random
from collections import Counter

import pyarrow as pa

from visitlake.llm import runlength_dedup as rd
from visitlake.llm.textbytes import texts_of


def brute_force(rows, length=rd.LENGTH):
    data = [(text or "").encode() for _, text in rows]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for (key, _), d in zip(rows, data):
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((key, len(d), sum(gone), spans, kept))
    return sorted(out, key=repr)


def found(docs, length=rd.LENGTH):
    rows = rd.remove_repeats(docs, "doc_id", "text", length).collect()
    return sorted(((*tuple(r)[:4], bytes(r["kept"])) for r in rows), key=repr)


def test_edge_documents(edge_docs):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    expected = brute_force(rows)
    assert found(edge_docs) == expected
    assert any(removed for _, _, removed, _, _ in expected)


def random_rows(seed, count=40):
    draw = random.Random(seed)
    passages = ["".join(draw.choice("abcdé ") for _ in range(draw.randint(30, 160))) for _ in range(6)]
    rows = []
    for i in range(count):
        parts = [draw.choice(passages)[draw.randint(0, 20) :] for _ in range(draw.randint(0, 4))]
        fill = ["".join(draw.choice("abcd ") for _ in range(draw.randint(0, 120))) for _ in range(5)]
        rows.append((i, "".join(f + p for f, p in zip(fill, [*parts, ""]))))
    return rows


def test_random_passages_with_short_windows(spark):
    for seed in range(2):
        rows = random_rows(seed)
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        assert found(docs, 60) == brute_force(rows, 60)


def test_common_seeds_counted_as_rows(spark, monkeypatch):
    monkeypatch.setattr(rd, "INDEXED", 2)
    rows = random_rows(9)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(docs, 60) == brute_force(rows, 60)


def test_text_without_broken_characters(spark):
    text = "é" * 250
    rows = [(0, "x" + text + "yes"), (1, text + "no")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r["key"]: r["kept"] for r in rd.remove_repeats(docs, "doc_id", "text", 400, as_text=True).collect()}
    assert kept == {0: "xyes", 1: "no"}


def test_index_finds_every_repeated_window():
    draw = random.Random(3)
    for case in range(25):
        alphabet = "ab" if case % 2 else "abcdefgh"
        base = bytes(ord(draw.choice(alphabet)) for _ in range(300))
        strings = list({base[i : i + draw.randint(1, 120)] for i in (draw.randint(0, 250) for _ in range(20))})
        strings += [bytes(ord(draw.choice(alphabet)) for _ in range(50))]
        length = 12
        seen = Counter(s[i : i + length] for s in strings for i in range(len(s) - length + 1))
        repeated = rd.RunLengthIndex(strings).repeated_starts(length)
        for s, flags in zip(strings, repeated):
            assert flags.tolist() == [seen[s[i : i + length]] > 1 for i in range(len(s) - length + 1)]


def test_every_window_is_in_one_context():
    rows = random_rows(5, 10)
    texts = texts_of(pa.array([text for _, text in rows]))
    found = Counter()
    for doc, _, _, first, last in zip(*rd.contexts_of(texts, 60)):
        found.update((int(doc), i) for i in range(first, last + 1))
    sizes = [len(text.encode()) for _, text in rows]
    assert found == Counter((d, i) for d, size in enumerate(sizes) for i in range(size - 59))


def test_empty_table(no_docs):
    assert found(no_docs) == []
