"""Top-k search against all scores."""

import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from visitlake.llm import voronoi

SCHEMA = "vec_id long, embedding array<float>, length int, v binary, pivot int, rank int"


def brute_force(rows, k=10):
    whole = [
        (key, [math.floor(1024 * x) for x in v]) for key, v in rows
        if key is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q, v in whole:
        if q % 100 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), key) for key, w in whole if key != q and len(w) == len(v))
            out += [(q, i + 1, key, -score) for i, (score, key) in enumerate(scored[:k])]
    return sorted(out)


def found(spark, rows, k=10):
    table = spark.createDataFrame([(*r, 1, b"x", 2, 3) for r in rows], SCHEMA)
    return sorted(tuple(r) for r in voronoi.top_k(table, "vec_id", "embedding", F.col("vec_id") % 100 == 0, k).collect())


def exact32(x):
    return round(x * 4096) / 4096


@pytest.mark.parametrize("clustered", [True, False])
def test_equals_all_scores(spark, clustered, monkeypatch):
    monkeypatch.setattr(voronoi, "BLOCK_ROWS", 50)
    monkeypatch.setattr(voronoi, "BLOCK_QUERIES", 3)
    draw = random.Random(1)
    centres = [[draw.gauss(0, 1) for _ in range(6)] for _ in range(8)]
    rows = []
    for i in range(900):
        centre = draw.choice(centres) if clustered else [0] * 6
        rows.append((i, [exact32(c + draw.gauss(0, 0.05 if clustered else 1)) for c in centre]))
    assert found(spark, rows) == brute_force(rows)


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (100, [0.5, -0.25]), (200, []), (201, []), (300, [1.0]), (400, None), (500, [nan, 1.0])]
    rows += [(1, [None, 1.0]), (2, [inf, 1.0]), (None, [1.0, 1.0]), (3, [-0.0001, 0.0]), (600, [0.0, 0.0, 0.0])]
    rows += [(4 + i, [0.5, 0.5]) for i in range(30)]  # ties
    rows += [(50, [0.75, 0.5]), (50, [0.75, 0.5])]  # a repeated row
    assert found(spark, rows) == brute_force(rows)


def clamped(rows, k=10):
    """Brute force with scores as near as a long can be."""
    limit = 1.7976931348623157e308
    whole = [(key, [math.floor(min(max(1024 * x, -limit), limit)) for x in v]) for key, v in rows]
    out = []
    for q, v in whole:
        if q % 100 == 0:
            scores = [(sum(a * b for a, b in zip(v, w)), key) for key, w in whole if key != q and len(w) == len(v)]
            scored = sorted((-min(max(score, -(2**63)), 2**63 - 1), key) for score, key in scores)
            out += [(q, i + 1, key, -score) for i, (score, key) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("kind, large", [("float", 1e15), ("float", 3e38), ("double", 1e300), ("double", 1.7e308), ("double", 40000.0)])
def test_large_components(spark, kind, large):
    """Long rows meet every query and change nothing for the others; long queries meet every row."""
    draw = random.Random(3)
    rows = [(i, [exact32(draw.gauss(0, 1)) for _ in range(3)]) for i in range(400)]
    rows += [(1000, [large, 0.0, 1.0]), (1001, [-large, large, 0.0]), (1002, [0.0, 0.0, large]), (1003, [1e5, -1e5, 1e5])]
    if kind == "float":
        rows = [(key, [struct.unpack("f", struct.pack("f", x))[0] for x in v]) for key, v in rows]
    table = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    got = voronoi.top_k(table, "vec_id", "embedding", F.col("vec_id") % 100 == 0, 10)
    assert sorted(map(tuple, got.collect())) == clamped(rows)


def test_fewer_than_k_and_none(spark):
    rows = [(0, [1.0, 2.0]), (1, [2.0, 1.0])]
    assert found(spark, rows) == brute_force(rows)
    assert found(spark, [(0, [1.0])]) == []
    assert found(spark, []) == []


def test_large_components_stay_exact(spark):
    rows = [(i, [float(2**30 + i * 2**8), float(-(2**29) + i * 2**9)]) for i in range(20)]
    rows = [(key, [x / 1024 for x in v]) for key, v in rows]
    assert found(spark, rows) == brute_force(rows)


def test_far_groups_are_not_searched():
    import numpy as np

    near, far = (voronoi.Group(50, 0.0, 1.0, np.full(11, 0.5), np.arange(11) + b) for b in (0, 50))
    apart = np.array([[1.0, 100.0]])
    assert voronoi._wanted(apart, np.array([999]), [near, far], 10).tolist() == [[True, False]]
