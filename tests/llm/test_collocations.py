import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from visitlake.llm import collocations as col

LOWERED = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_force(docs, least, per_lang):
    counts = {}
    for lang, text in docs:
        found = counts.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWERED)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for size in range(1, 5):
                found.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    rows = []
    for lang, f in counts.items():
        total = sum(n for phrase, n in f.items() if len(phrase) == 1)
        candidates = {phrase: n for phrase, n in f.items() if n >= least and len(phrase) > 1}
        longer = Counter()
        for phrase, n in candidates.items():
            for size in range(2, len(phrase)):
                for i in range(len(phrase) - size + 1):
                    inner = phrase[i : i + size]
                    longer[inner] = max(longer[inner], n)
        scored = []
        for phrase, a in candidates.items():
            if longer[phrase] and 100 * longer[phrase] >= 80 * a:
                continue
            score, _, left, right = min(
                (2000000 * a // (f[phrase[:k]] + f[phrase[k:]]), k, f[phrase[:k]], f[phrase[k:]]) for k in range(1, len(phrase))
            )
            scored.append((-score, -a, " ".join(phrase).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:per_lang], 1):
            rows.append((lang, rank, phrase.decode(), -a, left, right, total, -score))
    return sorted(rows)


def wordy(seed, rows):
    draw = random.Random(seed)
    words = "a b c d e f ä ß 日本 Long-word_" .split() + ["y" * 90]
    gaps = [" ", "  ", "\t", " ", ". ", ",", "\n", "; ", " "]
    return [
        (draw.choice(["en", "es", None, "und"]), "".join(draw.choice(words) + draw.choice(gaps) for _ in range(draw.randint(0, 60))))
        for _ in range(rows)
    ]


@pytest.mark.parametrize("head", [col.HEAD, 6, 1])
def test_equals_brute_force(spark, head):
    """With ids for all phrases, for few and for one."""
    rows = wordy(3, 400)
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = col.collocations(docs, "lang", "text", least=5, per_lang=40, head=head)
    expected = brute_force(rows, 5, 40)
    assert sorted(map(tuple, got.collect())) == expected and len(expected) > 60
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_edges(spark, edge_docs, no_docs):
    rows = [(row.lang, row.text) for row in edge_docs.collect()]
    got = col.collocations(edge_docs, "lang", "text", least=10)
    assert sorted(map(tuple, got.collect())) == brute_force(rows, 10, 2000)
    assert col.collocations(no_docs, "lang", "text").collect() == []


def test_tiles(monkeypatch):
    draw = np.random.default_rng(5)
    left, right = draw.zipf(1.3, 20000) % 5000, draw.zipf(1.3, 20000) % 5000
    monkeypatch.setattr(col, "DENSE", 500)
    cells, counts = col.tile_counts(left, right)
    assert dict(zip(cells.tolist(), counts.tolist())) == Counter((int(a) << 32 | int(b)) for a, b in zip(left, right))


def test_chunks():
    """Counts of a text do not depend on how it is dealt into chunks."""
    rows = wordy(8, 60)
    batch = pa.RecordBatch.from_arrays([pa.array([lang or "und" for lang, _ in rows]), pa.array([text for _, text in rows])], names=["lang", "text"])
    whole, parts = Counter(), Counter()
    for counts, step in ((whole, 60), (parts, 7)):
        for start in range(0, 60, step):
            chunk, end = col.Chunk(), min(start + step, 60)
            for row in range(start, end, 2):
                chunk.add(batch.slice(row, min(2, end - row)))
            for found in chunk.counts(1, None):
                for _, lang, word, n in zip(*(column.to_pylist() for column in found.columns)):
                    counts[lang, word] += n
    assert whole == parts and sum(whole.values()) > 500


def test_large_counts(spark):
    """Products beyond 64 bits."""
    a = 9 * 10**17
    phrases = spark.createDataFrame(
        [("en", "x y", 2, a), ("en", "x", 1, a + 1), ("en", "y", 1, 2 * a), ("en", "x y z", 3, a * 8 // 10 - 1), ("en", "z", 1, a), ("en", "y z", 2, a)],
        "lang string, phrase string, size int, f long",
    )
    candidates = phrases.where("size > 1").withColumnRenamed("f", "a")
    cut = {row.phrase: tuple(row)[2:] for row in col._cut(candidates, phrases).collect()}
    assert cut["x y"] == (a, 2000000 * a // (3 * a + 1), 1, a + 1, 2 * a)
    kept = {row.phrase for row in col._not_within(col._cut(candidates, phrases), candidates).collect()}
    assert kept == {"x y", "x y z", "y z"}
