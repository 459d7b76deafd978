"""Exact top-k search by inner product as a Voronoi kNN join.

Vectors become integers, floor(1024 * x). With one more coordinate, sqrt(M^2 - |x|^2) for a row and 0
for a query, M being the largest norm, the k highest inner products are the k nearest
neighbours. Rows and queries are grouped by their nearest pivot. Each group of rows is summed up by its
size, its least and largest distance to the pivot and its k + 1 nearest ids. From these a query
gets a bound on the distance of its k-th neighbour, and goes only to the groups that may hold a
nearer row. The groups are solved one by one and the best k per query are merged.

At scale: pivots are a fixed number of rows; only they and the summaries (k + 1 lines a pivot) go
through the driver. A group is cut into blocks of ``BLOCK_ROWS``, so a pivot that a third of
all rows lie near uses many tasks, and queries into blocks of ``BLOCK_QUERIES``. Where bounds cannot
prune, as with vectors in random directions, every query meets every block: rows times queries.
Distances are exact as long as squared norms are below ``LARGEST_NORM2`` (components of some ten thousands). Longer
rows have no pivot and meet every query, and longer queries meet every group.

Defined results: vectors that are null or hold null or non-finite components, and null ids, take no part.
Vectors are compared with those of their own length only. Rows that repeat an id are candidates of
their own, but never for the query of that id; of queries that repeat an id the least vector counts.
Ties go to the smaller id. A score that a long cannot hold is the nearest long, and ties there; 1024 * x beyond
doubles is the largest double. Columns that are not named do not matter; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitlake.llm.arrow import map_batches, show_library
from visitlake.scratch import via_table

SCALE = 1024
PIVOTS = 32
BLOCK_ROWS = 8192
BLOCK_QUERIES = 4096
#: Whole numbers up to here are exact in doubles.
EXACT = float(2**53)
ROUNDING = 1e-9
#: Squared norms up to here, and the sums that distances are made of, are exact in doubles.
LARGEST_NORM2 = float(2**50)
LEAST_LONG, MOST_LONG = -(2**63), 2**63 - 1


@dataclass
class Group:
    """What is known of the rows near one pivot; group -1 holds those without a pivot."""

    count: int
    least: float
    largest: float
    near: np.ndarray  # distances of the rows nearest to the pivot
    near_ids: np.ndarray


def top_k(df: DataFrame, key: str, vector: str, is_query: Column, k: int = 10) -> DataFrame:
    """Rows (query_id, rank, vec_id, score)."""
    rows = _whole_vectors(df, key, vector, is_query)
    ordinary = rows.where(F.col("norm2") <= LARGEST_NORM2)
    largest = ordinary.agg(F.max("norm2")).first()[0] or 0.0
    pivots = [
        np.frombuffer(row["v"])
        for row in ordinary.orderBy(F.xxhash64("vec_id"), "v").limit(PIVOTS).select("v").collect()
    ]
    assigned = via_table(_assign(rows, pivots, largest), "voronoi-rows")
    groups = _summaries(assigned, k)
    queries = (
        assigned.where("is_query").groupBy("vec_id").agg(F.min(F.struct("v", "length")).alias("q"))
    ).select("vec_id", "q.v", "q.length")
    query_blocks = max(1, -(-queries.count() // BLOCK_QUERIES))
    blocks = {group: -(-known.count // BLOCK_ROWS) for group, known in groups.items()}
    sent = _send(queries, pivots, largest, groups, blocks, k).withColumn(
        "query_block", F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks))
    )
    of_group = F.create_map(
        *[F.lit(x) for (length, pivot), n in blocks.items() for x in (f"{length}/{pivot}", n)]
    ).cast("map<string,int>")
    stored = (
        assigned.withColumn("blocks", of_group[F.concat_ws("/", "length", "pivot")])
        .withColumn("block", F.pmod(F.xxhash64("vec_id"), "blocks").cast("int"))
        .withColumn("query_block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(query_blocks - 1).cast("long"))))
        .select("length", "pivot", "block", "query_block", "vec_id", "v")
    )
    by = ["length", "pivot", "block", "query_block"]
    show_library(df.sparkSession)
    local = (
        stored.groupBy(*by)
        .cogroup(sent.groupBy(*by))
        .applyInArrow(lambda a, b: _solve(a, b, k), "query_id long, vec_id long, score long")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        local.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _whole_vectors(df: DataFrame, key: str, vector: str, is_query: Column) -> DataFrame:
    """Rows (vec_id, is_query, length, v, norm2); v holds the whole components as doubles."""
    values = F.col(vector).cast("array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    source = df.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & finite).select(
        F.col(key).cast("long").alias("vec_id"), is_query.alias("is_query"), values.alias("values")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("values")
            with np.errstate(over="ignore"):
                flat = np.nan_to_num(np.floor(SCALE * lists.flatten().to_numpy(zero_copy_only=False)))
            ends = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy())))
            vectors = [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    batch.column("is_query"),
                    pa.array(np.diff(ends), pa.int32()),
                    pa.array([v.tobytes() for v in vectors], pa.binary()),
                    pa.array(_norms2(vectors), pa.float64()),
                ],
                names=["vec_id", "is_query", "length", "v", "norm2"],
            )

    schema = "vec_id long, is_query boolean, length int, v binary, norm2 double"
    return map_batches(source, run, schema)


def _norms2(vectors: list[np.ndarray] | np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.array([float(v @ v) for v in vectors])


def _distances(points: np.ndarray, norms: np.ndarray, pivots: np.ndarray, largest: float) -> np.ndarray:
    """Distances of rows to pivots, both with the further coordinate."""
    pivot_norms = (pivots**2).sum(1)
    apart = norms[:, None] + pivot_norms[None] - 2 * points @ pivots.T
    further = np.sqrt(np.maximum(largest - norms, 0))[:, None] - np.sqrt(
        np.maximum(largest - pivot_norms, 0)
    )
    return np.sqrt(np.maximum(apart, 0) + further**2)


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places, matrix) for each length of vector in a batch."""
    lengths = batch.column("length").to_numpy()
    values = batch.column("v").to_pylist()
    for length in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == length)
        yield length, at, np.frombuffer(b"".join(values[i] for i in at)).reshape(len(at), length)


def _pivots_of(pivots: list[np.ndarray], length: int) -> tuple[np.ndarray, np.ndarray]:
    numbers = np.array([i for i, p in enumerate(pivots) if len(p) == length], int)
    return numbers, np.array([pivots[i] for i in numbers]).reshape(len(numbers), length)


def _assign(rows: DataFrame, pivots: list[np.ndarray], largest: float) -> DataFrame:
    """The rows with their nearest pivot and its distance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pivot = np.full(batch.num_rows, -1, np.int32)
            distance = np.zeros(batch.num_rows)
            norms = batch.column("norm2").to_numpy()
            for length, at, points in _by_length(batch):
                numbers, centres = _pivots_of(pivots, length)
                ordinary = norms[at] <= LARGEST_NORM2
                at, points = at[ordinary], points[ordinary]
                if len(numbers):
                    apart = _distances(points, norms[at], centres, largest)
                    nearest = apart.argmin(1)
                    pivot[at] = numbers[nearest]
                    distance[at] = apart[np.arange(len(at)), nearest]
            keep = ["vec_id", "is_query", "length", "v"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(pivot), pa.array(distance)],
                names=[*keep, "pivot", "distance"],
            )

    schema = "vec_id long, is_query boolean, length int, v binary, pivot int, distance double"
    return map_batches(rows, run, schema)


def _summaries(assigned: DataFrame, k: int) -> dict[tuple[int, int], Group]:
    """A group per length and pivot. Its near rows have ids of their own, so that k remain
    for the query of any id."""
    nearest = Window.partitionBy("length", "pivot").orderBy("distance", "vec_id")
    near = (
        assigned.groupBy("length", "pivot", "vec_id")
        .agg(F.min("distance").alias("distance"))
        .withColumn("place", F.row_number().over(nearest))
        .where(F.col("place") <= k + 1)
    ).collect()
    stats = assigned.groupBy("length", "pivot").agg(
        F.count("*").alias("n"), F.min("distance").alias("least"), F.max("distance").alias("largest")
    )
    groups = {}
    for row in stats.collect():
        own = [x for x in near if (x["length"], x["pivot"]) == (row["length"], row["pivot"])]
        groups[row["length"], row["pivot"]] = Group(
            row["n"],
            row["least"],
            row["largest"],
            np.array([x["distance"] for x in own]),
            np.array([x["vec_id"] for x in own]),
        )
    return groups


def _send(
    queries: DataFrame, pivots: list[np.ndarray], largest: float, groups: dict, blocks: dict, k: int
) -> DataFrame:
    """The queries, once for every block of a group that may hold one of their k nearest."""
    names = ["length", "pivot", "block", "vec_id", "v"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, values, out = batch.column("vec_id").to_numpy(), batch.column("v"), []
            for length, at, points in _by_length(batch):
                numbers, centres = _pivots_of(pivots, length)
                norms = _norms2(points)
                own = [groups.get((length, i)) for i in numbers]
                wanted = np.tile([group is not None for group in own], (len(at), 1)).astype(bool)
                some = np.flatnonzero(norms <= LARGEST_NORM2)
                apart = norms[some, None] + largest - 2 * points[some] @ centres.T
                wanted[some] = _wanted(np.sqrt(np.maximum(apart, 0)), ids[at[some]], own, k)
                for column, pivot in enumerate(numbers):
                    for place in at[wanted[:, column]]:
                        out += [(length, pivot, b, place) for b in range(blocks[length, pivot])]
                if (length, -1) in groups:
                    out += [(length, -1, b, p) for p in at for b in range(blocks[length, -1])]
            lengths, numbers, block, places = np.array(out, np.int64).reshape(-1, 4).T
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(lengths, pa.int32()),
                    pa.array(numbers, pa.int32()),
                    pa.array(block, pa.int32()),
                    pa.array(ids[places]),
                    values.take(pa.array(places)),
                ],
                names=names,
            )

    return map_batches(queries, run, "length int, pivot int, block int, vec_id long, v binary")


def _wanted(apart: np.ndarray, ids: np.ndarray, groups: list[Group | None], k: int) -> np.ndarray:
    """Which groups each query needs: those whose nearest possible row is within the bound."""
    wanted = np.zeros(apart.shape, bool)
    known = [g for g in groups if g is not None]
    if not known:
        return wanted
    near_ids = np.concatenate([g.near_ids for g in known])
    upper = np.concatenate(
        [apart[:, [j]] + g.near[None] for j, g in enumerate(groups) if g is not None], axis=1
    )
    upper = np.where(near_ids[None] == ids[:, None], np.inf, upper)
    bound = np.partition(upper, k - 1, axis=1)[:, k - 1] if upper.shape[1] >= k else np.inf
    for j, group in enumerate(groups):
        if group is not None:
            lower = np.maximum(apart[:, j] - group.largest, group.least - apart[:, j])
            slack = ROUNDING * (apart[:, j] + group.largest + 1)
            wanted[:, j] = lower <= bound + slack
    return wanted


def _solve(rows: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    """The k best rows of one block for each query that was sent to it."""
    names = ["query_id", "vec_id", "score"]
    if not rows.num_rows or not queries.num_rows:
        return pa.table({name: pa.array([], pa.int64()) for name in names})
    ids = rows["vec_id"].to_numpy()
    order = np.argsort(ids, kind="stable")  # a stable sort by score then keeps ties by id
    ids = ids[order]
    length = rows["length"][0].as_py()
    points = np.frombuffer(b"".join(rows["v"].to_pylist())).reshape(rows.num_rows, length)[order]
    asked = np.frombuffer(b"".join(queries["v"].to_pylist())).reshape(queries.num_rows, length)
    # Divided, not multiplied: the product may be beyond doubles.
    if length and np.abs(points).max() >= EXACT / length / max(np.abs(asked).max(), 1.0):
        points, asked = (np.array([[int(x) for x in v] for v in m], object) for m in (points, asked))
    query_ids = queries["vec_id"].to_numpy()
    found: list[tuple[np.ndarray, ...]] = []
    for start in range(0, len(asked), 128):
        some = query_ids[start : start + 128]
        scores = asked[start : start + 128] @ points.T
        if scores.dtype == object:
            scores = np.minimum(np.maximum(scores, LEAST_LONG), MOST_LONG)
        own = some[:, None] == ids[None]
        if scores.dtype == object:
            by_score = [
                sorted(range(len(ids)), key=lambda j: (own[i, j], -scores[i, j], j))[:k]
                for i in range(len(some))
            ]
            best = np.array(by_score)
        else:
            best = np.argsort(np.where(own, np.inf, -scores), axis=1, kind="stable")[:, :k]
        row = np.repeat(np.arange(len(some)), best.shape[1])
        best = best.ravel()
        kept = ~own[row, best]
        row, best = row[kept], best[kept]
        found.append((some[row], ids[best], scores[row, best].astype(np.int64)))
    return pa.table({name: np.concatenate(x) for name, x in zip(names, zip(*found))})
