"""Mixing and WARC archives against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from visitlake.llm import mixing, warc
from visitlake.scratch import new_scratch_path


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def fill_targets(sizes):
    """Targets by sharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    most = {s: 3 * sizes[s] for s in order}
    total, full = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in full]
        rest = total - sum(most[s] for s in full)
        target = {s: most[s] if s in full else rest * weight[s] / sum(weight[f] for f in free) for s in order}
        above = {s for s in free if target[s] > most[s]}
        if not above:
            return target
        full |= above


def mix_of(docs, **options):
    units = docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    return mixing.mix(units, **options).collect()


def check(rows, taken, tolerance):
    sizes = defaultdict(int)
    for row in rows:
        sizes[row["source"]] += words(row["text"])
    targets, got = fill_targets(sizes), defaultdict(int)
    assert len(taken) == len(rows)
    for row in taken:
        assert 0 <= row["times"] <= 3
        assert row["source_size"] == sizes[row["source"]]
        assert row["target"] == pytest.approx(targets[row["source"]])
        got[row["source"]] += row["times"] * row["size"]
    for source, target in targets.items():
        assert abs(got[source] - target) <= tolerance


def test_edge_documents(edge_docs):
    check(edge_docs.collect(), mix_of(edge_docs), 600)  # one document has 9,000 words


def test_blocks_keep_totals_and_reruns_agree(spark):
    draw = random.Random(2)
    rows = [(i, "w " * int(draw.paretovariate(1.1) * 5), "abcdefg"[min(draw.randint(0, 12), 6)]) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").cache()
    one = mix_of(docs, block_rows=40)
    check(docs.collect(), one, 30)
    again = mix_of(docs.repartition(5), block_rows=40)
    assert sorted(map(tuple, one)) == sorted(map(tuple, again))


@pytest.mark.parametrize("names", ["abcd", "abcdefgh"])
def test_sources_of_equal_size_share_all_words(spark, names):
    units = spark.createDataFrame([(s, 10) for s in names], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(units).collect()}
    assert got == pytest.approx(fill_targets({s: 10 for s in names}))
    assert sum(got.values()) == pytest.approx(10 * len(names))


def test_flight_keeps_both_totals():
    draw = random.Random(5)
    for _ in range(20):
        x = [float(draw.randint(0, 50)) for _ in range(200)]
        p = [draw.random()] * 200
        count, total = sum(p), sum(a * b for a, b in zip(p, x))
        left = mixing.fly(p, x, draw.random)
        assert len(left) <= 2 and all(v in (0, 1) for i, v in enumerate(p) if i not in left)
        assert sum(p) == pytest.approx(count)
        assert sum(a * b for a, b in zip(p, x)) == pytest.approx(total)


def test_draws_have_the_wanted_probability():
    hits, draw = 0, random.Random(1)
    for _ in range(300):
        p, x = [0.3] * 30, [float(i) for i in range(30)]
        mixing.land(p, x, mixing.fly(p, x, draw.random), 0.3 * sum(x))
        hits += p[7]
    assert 60 <= hits <= 120


def test_empty_tables(no_docs, spark):
    assert mix_of(no_docs) == []
    path = new_scratch_path(spark, "warc-test")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archives(pages, path, "page_id", "url", "html")
    assert warc.read_archives(spark, path).count() == 0


PAGES = [
    (1, "http://a.org/", "p" * 1500),
    (2, "http://b.org/\r\nX: y", "p" * 1500),
    (9, None, "p" * 1500),
    (3, "", "short"),
    (4, "http://d.org/", "short"),
    (5, "http://e.org/", None),
    (6, "http://f.org/é", "é" * 600 + "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"),
    (7, "http://g.org/", "é" * 600 + "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"),
    (8, "http://h.org/", "x" * 999),
    (10, "http://h.org/", "x" * 999),
    (11, "http://i.org/", "y" * 1000),
    (11, "http://i.org/", "y" * 1000),
    (None, "http://j.org/", "p" * 1500),
    (12, "http://long.org/", "z" * 3_000_000),
]


def test_archives(spark):
    pages = spark.createDataFrame([(*p, "d", "k") for p in PAGES], "page_id long, url string, html string, digest string, key string")
    path = new_scratch_path(spark, "warc-test")
    warc.write_archives(pages.repartition(3), path, "page_id", "url", "html", archive_bytes=1 << 20)
    records = warc.with_original_keys(warc.read_archives(spark, path)).collect()
    last = {}
    for key, _, html in PAGES:
        body = (html or "").encode()
        if len(body) >= 1000 and key is not None:
            last[body] = max(key, last.get(body, key))
    expected = []
    for key, _, html in PAGES:
        body = (html or "").encode()
        original = last.get(body)
        revisit = key is not None and original is not None and key < original
        expected.append((key, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", original if revisit else None))
    got = [(r["key"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in records]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    uris = {r["key"]: r["target_uri"] for r in records}
    assert uris[2] == "http://b.org/  X: y" and uris[9] is None and uris[3] == ""


def test_damaged_payload_is_noticed(spark):
    good = warc.VERSION + "\r\nWARC-Type: response\r\nWARC-Record-ID: <x>\r\nWARC-Payload-Digest: sha1:00\r\nContent-Length: 23\r\n\r\n"
    import pyarrow as pa

    with pytest.raises(ValueError, match="its header says 00"):
        list(warc._parse(pa.py_buffer((good + "HTTP/1.1 200 OK\r\n\r\nbody\r\n\r\n").encode())))
    with pytest.raises(ValueError, match="no record starts"):
        list(warc._parse(pa.py_buffer(b"nonsense\r\n\r\n")))
