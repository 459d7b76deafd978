"""Components against all pairs of the same rows."""

import re

import numpy as np
import pyarrow as pa

from visitlake.llm import jaccard_rtree as jr
from visitlake.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute_force(rows):
    """(id, size, component) of each row, by comparing all pairs."""
    sets = [shingles(text) for _, text in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                parent[root(i)] = root(j)
    groups = {}
    for i, (key, _) in enumerate(rows):
        groups.setdefault(root(i), []).append(key)
    least = {r: min((k for k in keys if k is not None), default=None) for r, keys in groups.items()}
    return sorted(((key, len(sets[i]), least[root(i)]) for i, (key, _) in enumerate(rows)), key=repr)


def found(docs):
    return sorted((tuple(r) for r in jr.near_duplicates(docs, "doc_id", "text").collect()), key=repr)


def test_edge_documents(edge_docs):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    assert found(edge_docs) == brute_force(rows)


def test_chains_and_passages(spark):
    """Chains of edits, where the ends do not link, and a passage that is most of many texts."""
    draw = np.random.default_rng(7)
    words = [f"w{i}" for i in range(4000)]
    passage = list(draw.choice(words, 40))
    rows = []
    for chain in range(6):
        text = list(draw.choice(words, 80))
        for step in range(7):
            rows.append((len(rows), " ".join(text)))
            at = int(draw.integers(0, 70))
            text = text[:at] + list(draw.choice(words, 4)) + text[at + 3 :]
    for size in (2, 4, 6, 8, 10, 12, 14, 30, 60):
        for _ in range(4):
            rows.append((len(rows), " ".join([*draw.choice(words, size), *passage, *draw.choice(words, size)])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute_force(rows)
    assert found(docs) == expected
    assert len({c for _, _, c in expected}) < len(rows)


def test_classes_of_size_meet(spark):
    """Links between documents just below and above the sizes where points get more groups."""
    draw = np.random.default_rng(9)
    rows = []
    for size in (590, 604, 2399):
        base = [f"u{x}" for x in draw.integers(0, 10**6, size + 4)]
        rows += [(len(rows) + i, " ".join(base + [f"more{i}x{j}" for j in range(12 * i)])) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(docs) == brute_force(rows)


def test_small_blocks(spark, monkeypatch):
    """A cell over many blocks gives the same links."""
    monkeypatch.setattr(jr, "BLOCK", 3)
    draw = np.random.default_rng(8)
    words = [f"v{i}" for i in range(3000)]
    base = list(draw.choice(words, 60))
    rows = [(i, " ".join([*base[: 60 - 2 * i], *draw.choice(words, 2 * i)])) for i in range(25)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(docs) == brute_force(rows)


def test_rounds_of_few_pairs(spark, monkeypatch):
    """Components whose best pair does not link are searched again, until all their pairs have been verified."""
    monkeypatch.setattr(jr, "FEW", 2)
    draw = np.random.default_rng(12)
    words = [f"r{i}" for i in range(3000)]
    rows = []
    for size in (40, 44, 48):
        base = list(draw.choice(words, size))
        for change in (0, 1, 2, 3, 4, 5, 6, 8, 12):
            for _ in range(3):
                text = list(base)
                for at in draw.integers(0, size, change):
                    text[at] = str(draw.choice(words))
                rows.append((len(rows), " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(docs) == brute_force(rows)


def test_pairs_left_out_are_named():
    """The best pairs of each component stay; one that is left out has both its components named."""
    draw = np.random.default_rng(2)
    for keep in (1, 3, 50):
        nodes = np.arange(40)
        component = nodes % 6
        a, b = np.array([(x, y) for x in nodes for y in nodes if x < y and x % 6 != y % 6]).T
        share = draw.integers(0, 9, len(a)) / 9
        crossing = jr.Crossing(keep)
        for part in np.array_split(draw.permutation(np.tile(np.arange(len(a)), 2)), 7):
            flip = draw.integers(0, 2, len(part)).astype(bool)
            both = np.where(flip, np.stack((a[part], b[part])), np.stack((b[part], a[part])))
            crossing.add(both, component[both], share[part])
            crossing.settle()
        rows = crossing.rows().to_pylist()
        kept = {(r["a"], r["b"]) for r in rows if not r["more"]}
        named = {r["a"] for r in rows if r["more"]}
        of = dict(zip(zip(a.tolist(), b.tolist()), share))
        assert kept <= set(of) and len(kept) <= 6 * keep
        for x, y in set(of) - kept:
            assert {x % 6, y % 6} <= named
        for c in range(6):
            own = sorted((s for (x, y), s in of.items() if c in (x % 6, y % 6)), reverse=True)
            assert sorted((of[x, y] for x, y in kept if c in (x % 6, y % 6)), reverse=True)[:keep] == own[:keep]
    assert jr.Crossing(4).rows().num_rows == 0


def test_tree_skips_no_pair():
    draw = np.random.default_rng(1)
    for _ in range(30):
        base = draw.poisson(3, (1, jr.GROUPS[0]))
        points = np.maximum(base + draw.integers(-2, 3, (60, jr.GROUPS[0])), 0)
        points[::3] = draw.poisson(3, (20, jr.GROUPS[0]))
        over = draw.integers(0, 40, 60)
        sizes = points.sum(1) + over
        tree = jr.CountTree(points, over, sizes)
        for q in range(60):
            least = np.minimum(points, points[q]).sum(1) + np.minimum(over, over[q])
            fits = (7 * least >= 3 * (sizes + sizes[q])) & (
                4 * np.minimum(sizes, sizes[q]) >= 3 * np.maximum(sizes, sizes[q])
            )
            assert sorted(tree.search(points[q], over[q], sizes[q])) == np.flatnonzero(fits).tolist()


def test_points_of_many_counts():
    draw = np.random.default_rng(4)
    sets = [draw.integers(0, 2**50, size).astype(np.uint64) for size in (0, 599, 600, 2400, 700)]
    sets.append(np.repeat(sets[1][:1], 40))
    first = np.cumsum([0, *map(len, sets)])
    values = jr.points(np.concatenate(sets), first)
    assert jr.groups_of(values).tolist() == [256, 256, 1024, 4096, 1024, 256]
    for some in ([0, 1, 2, 4, 5], [2, 3]):
        groups = min(jr.groups_of([values[i] for i in some]))
        low, over = jr.read_points([values[i] for i in some], groups)
        for row, i in enumerate(some):
            counts = np.bincount((sets[i] % np.uint64(groups)).astype(int), minlength=groups)
            assert (low[row].sum(dtype=int) + over[row]) == len(sets[i])
            assert (low[row] <= counts).all()


def random_cells(seed, cells, most):
    """Rows (cell, node, n, place) by cell and node, some of them twice."""
    draw = np.random.default_rng(seed)
    rows = set()
    for cell in range(cells):
        for _ in range(int(draw.integers(1, most))):
            n = int(draw.integers(8, 20))
            rows.add((cell, int(draw.integers(0, 500)), n, int(draw.integers(0, jr.needed_length(np.int64(n))))))
    rows = {row[:2]: row for row in sorted(rows)}
    return sorted([*rows.values(), *list(rows.values())[::5]])


def test_members_have_a_partner(monkeypatch):
    """In any batches; a row without one is left out, unless its cell has very many."""
    for block, size in ((1000, 7), (1000, 400), (20, 3), (20, 64)):
        monkeypatch.setattr(jr, "BLOCK", block)
        monkeypatch.setattr(jr, "PAIRS", size)
        rows = random_cells(block + size, 60, 40)
        columns = [np.array(x) for x in zip(*rows)]
        whole = pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["cell", "node", "n", "place"])
        batches = [whole.slice(at, size) for at in range(0, len(rows), size)]
        found = [tuple(r.values()) for b in jr._members(iter(batches)) for r in b.to_pylist()]
        expected = []
        for cell in range(60):
            own = sorted({r[1:] for r in rows if r[0] == cell})
            kept = [
                (x, n, p) for x, n, p in own
                if len(own) > block or any(
                    x != y and 4 * min(n, m) >= 3 * max(n, m) and 7 * min(n - p, m - o) >= 3 * (n + m) for y, m, o in own
                )
            ]
            expected += [(cell, kept[0][0], *row) for row in kept]
        assert found == expected
        assert 0 < len(expected) < len(set(rows)) or block == 20


def test_cells_are_made_and_moved_once(spark, edge_docs, monkeypatch):
    plans, written = {}, jr.via_table

    def via_table(df, name):
        plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString())
        return written(df, name)

    monkeypatch.setattr(jr, "via_table", via_table)
    jr.near_duplicates(edge_docs, "doc_id", "text")
    assert plans["members"].count("Exchange") == 1 and "Join" not in plans["members"]


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (5, 5)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(links).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100}


def test_empty_table(no_docs):
    assert found(no_docs) == []
