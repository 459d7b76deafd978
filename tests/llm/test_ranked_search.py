import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from visitlake.llm import ranked_search as search

TERM = re.compile(search.TERM)
ITEM_SCHEMA = "item_id long, text string, item string, term string, key long"


def terms_of(text):
    lowered = (text or "").translate(str.maketrans(search.UPPER, search.UPPER.lower()))
    return TERM.findall(lowered)


def brute_force(docs, items, k):
    texts = [(key, Counter(terms_of(text))) for key, text in docs]
    texts = [(key, terms, sum(terms.values())) for key, terms in texts if terms]
    n, length = len(texts), sum(size for _, _, size in texts)
    df = Counter(term for _, terms, _ in texts for term in terms)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms_of(text))
    rows = []
    for item, terms in wanted.items():
        scored = []
        for key, found, size in texts:
            m = 50 + (50 * size * n) // length
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * found[t] // (1000 * found[t] + 20 * m))
                for t in terms & found.keys()
            )
            if score > 0:
                scored.append((-score, key is None, key))
        rows += [(item, rank, key, -score) for rank, (score, _, key) in enumerate(sorted(scored, key=lambda r: (r[0], r[1], r[2] or 0))[:k], 1)]
    return sorted(rows, key=repr)


def edge_items():
    rows = [
        (1, "The river and weather, letters: MORNING houses"),
        (2, None),
        (3, "!!! --"),
        (4, "one two"),
        (4, "three stones2"),  # a second row of an item
        (4, "one two"),
        (None, "paper market ελληνικά текст"),
        (5, "xyzzy nothing"),
        (6, "é" * 500 + " ab"),
    ]
    return [(*row, "x", "y", 3) for row in rows]


def run(spark, docs, items, k, **more):
    found = search.top_documents(docs, "doc_id", "text", items, "item_id", "text", k, **more)
    return sorted(map(tuple, found.collect()), key=repr)


@pytest.mark.parametrize("k, block_terms", [(3, 1 << 18), (50, 8)])
def test_equals_brute_force(spark, edge_docs, k, block_terms):
    items = spark.createDataFrame(edge_items(), ITEM_SCHEMA)
    docs = [(row.doc_id, row.text) for row in edge_docs.collect()]
    expected = brute_force(docs, [(row[0], row[1]) for row in edge_items()], k)
    assert run(spark, edge_docs, items, k, block_terms=block_terms) == expected and expected


def test_no_rows(spark, edge_docs, no_docs):
    items = spark.createDataFrame(edge_items(), ITEM_SCHEMA)
    assert run(spark, no_docs, items, 5) == []
    assert run(spark, edge_docs, items.limit(0), 5) == []


def test_intervals_of_several_shards(spark, monkeypatch):
    """Long lists, many ties and shards of a few documents, searched in one process."""
    draw = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    docs = [(i * 7 % 400, " ".join(draw.choices(words, range(60, 0, -1), k=draw.randint(1, 30)))) for i in range(400)]
    docs += [(1000 + i, docs[5][1]) for i in range(90)]
    items = [(i, " ".join(draw.sample(words, 12))) for i in range(6)] + [(9, docs[5][1])]
    expected = brute_force(docs, items, 10)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    asked = spark.createDataFrame(items, "item_id long, text string")
    block = search._block(asked.selectExpr("item_id item", "explode(split(text, ' ')) term").distinct().toArrow())
    rows = search._postings(frame, "doc_id", "text", block).toArrow().to_batches()
    counts = {row.term: row.n for row in search._counts(search._postings(frame, "doc_id", "text", block)).collect()}
    block.documents, block.length = counts.pop(-1), counts.pop(-2)
    block.weights = np.zeros(len(block.hashes), np.int64)
    for term, n in counts.items():
        block.weights[term] = math.floor(1000 * math.log((2 * block.documents + 2) / (2 * n + 1)))
    for documents, short, wave in ((1 << 15, 64, 128), (37, 1, 2), (200, 4, 1)):
        for name, value in (("SHARD_DOCUMENTS", documents), ("SHORT", short), ("WAVE", wave)):
            monkeypatch.setattr(search, name, value)
        best = [search.Best(10) for _ in block.terms]
        for columns in search._shards(iter(rows)):
            shard = search.Shard.build(block, *columns)
            for wanted, top in zip(block.terms, best):
                shard.search(wanted, top)
        got = [
            (item.as_py(), rank, int(key), int(score))
            for item, top in zip(block.items, best)
            for rank, (key, score) in enumerate(zip(top.keys, top.scores), 1)
        ]
        assert sorted(got, key=repr) == expected


def test_range_maxima():
    values = np.random.default_rng(1).integers(0, 9, 300)
    levels = search.maxima(values, 300)
    for left in range(0, 300, 17):
        for right in range(left + 1, 301, 13):
            level = (right - left).bit_length() - 1
            pair = levels[level, left], levels[level, right - (1 << level)]
            assert max(values[p] for p in pair) == values[left:right].max()
            assert all(left <= p < right for p in pair)


def test_norms_beyond_64_bits():
    block = search.Block(None, [], None, None, documents=10**13, length=10**15)
    assert search.norms(np.array([10**7, 100]), block).tolist() == [50 + 50 * 10**7 // 100, 100]
