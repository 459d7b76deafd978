import random

import numpy as np
import pytest
import xxhash

from visitlake.llm import simhash_vptree as sim


def slow_fingerprint(text):
    words = [w for w in (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).replace("\t", " ").replace("\n", " ").replace("\v", " ").replace("\f", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def components(prints, radius):
    """Label of each fingerprint, by comparing all."""
    prints = np.array(prints, np.uint64)
    labels = list(range(len(prints)))

    def root(i):
        while labels[i] != i:
            i = labels[i]
        return i

    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(prints[i] ^ prints) <= radius):
            labels[max(root(i), root(int(j)))] = min(root(i), root(int(j)))
    return [root(i) for i in range(len(prints))]


def brute_force(rows, radius=3):
    prints = [slow_fingerprint(text) for _, text in rows]
    labels = components(prints, radius)
    least = {}
    for label, (key, _) in zip(labels, rows):
        least[label] = min((k for k in (least.get(label), key) if k is not None), default=None)
    return sorted(((key, f"{p:016x}", least[label]) for (key, _), p, label in zip(rows, prints, labels)), key=repr)


def test_edges_equal_brute_force(spark, edge_docs, no_docs):
    rows = [(row.doc_id, row.text) for row in edge_docs.collect()]
    got = sim.near_duplicates(edge_docs, "doc_id", "text")
    assert sorted(map(tuple, got.collect()), key=repr) == brute_force(rows)
    assert sim.near_duplicates(no_docs, "doc_id", "text").collect() == []


def test_sf_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    got = sim.near_duplicates(docs, "doc_id", "text", shard=64)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_force([tuple(row) for row in docs.collect()])


def clustered(seed, clusters, each):
    draw = random.Random(seed)
    out = set()
    for _ in range(clusters):
        centre = draw.getrandbits(64)
        for _ in range(each):
            x = centre
            for bit in draw.sample(range(64), draw.randint(0, 5)):
                x ^= 1 << bit
            out.add(x)
    return np.array(sorted(out | {draw.getrandbits(64) for _ in range(600)}), np.uint64)


@pytest.mark.parametrize("shard, full", [(1 << 13, 1 << 15), (100, 1 << 15), (50, 60)])
def test_points_over_shards_and_blocks(spark, shard, full):
    prints = clustered(2, 6, 150)
    rows = [(int(p), int(p)) for p in prints.view(np.int64)]
    points = spark.createDataFrame(rows, "print long, least long")
    links = sim.point_links(points, 3, shard, full).collect()
    place = {int(p): i for i, p in enumerate(prints.view(np.int64))}
    labels = np.arange(len(prints))
    a, b = (np.array([place[getattr(row, name)] for row in links]) for name in "ab")
    sim.unite(labels, a, b)
    expected = components(prints, 3)
    assert labels.tolist() == expected and len(set(expected)) < len(prints) - 500


def test_shard_goes_below_a_comparison(monkeypatch):
    monkeypatch.setattr(sim, "PAIRS", 64)
    prints = clustered(7, 4, 100)
    homes, visitors = prints[::2], prints[1::2]
    a, b = sim.shard_links(homes, visitors, 3)
    points = np.concatenate((homes, visitors))
    place = {int(p): i for i, p in enumerate(points)}
    labels = np.arange(len(points))
    sim.unite(labels, np.array([place[int(x)] for x in a]), np.array([place[int(x)] for x in b]))
    wanted = np.arange(len(points))
    for i in range(len(homes)):
        near = np.flatnonzero(np.bitwise_count(points ^ points[i]) <= 3)
        sim.unite(wanted, np.full(len(near), i), near)
    assert labels.tolist() == wanted.tolist()


def test_long_text_in_pieces(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(500))
    whole = sim.fingerprint(text.encode())
    monkeypatch.setattr(sim, "PIECE_HASHES", 7)
    assert sim.fingerprint(text.encode()) == whole == slow_fingerprint(text)
