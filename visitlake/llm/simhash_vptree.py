"""SimHash near duplicates: fingerprints of word shingles, joined within a Hamming distance by vantage-point trees.

A bit of a fingerprint is set if it is set in over half of the hashes of a text's shingles. Distinct
fingerprints are the points. A tree over a bounded sample of them cuts the space: each of its nodes has a
vantage point and a distance, and points up to that distance lie inside, the others outside. Two points within ``radius``
of each other differ by no more than that in their distance to any vantage point, so only points close to a boundary also
visit the shard beyond it. A shard goes on cutting its points and visitors by vantage points of its own
until few are left, and compares those bit by bit: all pairs within the radius are met, and only them.

How it is distributed: texts never move; equal texts, and texts of equal fingerprint, are one point from then
on. A shard is one task's group of about ``SHARD`` points with its visitors. A shard with more than
``FULL`` points, which no vantage point could cut, is dealt into blocks; each block visits those after it. A shard
gives one link per point at most, to the least point of its own component. The tree comes from a sample of at most
``SAMPLE`` fingerprints and has at most ``LEAVES`` shards.

Random fingerprints lie about 32 bits apart, with a spread of 4: a boundary is then within 3 bits for about half of
the points, so the work grows faster than the number of points (about as its power 1.6).

Defined results: texts without words (null, empty) have fingerprint zero and are linked like any others; a text of
fewer words than a shingle has its whole sequence. Rows that repeat are in one component. Null ids get a
component like others; it is null only if all its ids are. Columns that are not named do not matter; an
empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlake.llm.arrow import map_batches, map_groups, pieces
from visitlake.llm.components import components
from visitlake.llm.textbytes import LOWER
from visitlake.scratch import via_table

SEED = 42
SHINGLE = 3
RADIUS = 3
BITS = 64
#: Points of a shard, and the number above which it is dealt into blocks.
SHARD = 1 << 13
FULL = 1 << 15
LEAVES = 1 << 12
#: Fingerprints that the tree is made from, and candidates for each of its vantage points.
SAMPLE = 1 << 17
CANDIDATES = 16
#: Pairs that are compared bit by bit at a time.
PAIRS = 1 << 20
#: Hashes of a text that are held as bits at a time.
PIECE_HASHES = 1 << 16


def near_duplicates(
    documents: DataFrame, key: str, text: str, radius: int = RADIUS, shard: int = SHARD, full: int = FULL
) -> DataFrame:
    """Rows (key, fingerprint, component_id): the fingerprint as 16 hexadecimal digits, and the least key that
    can be reached through fingerprints of at most ``radius`` different bits."""
    marked = via_table(fingerprints(documents, key, text), "fingerprints")
    points = via_table(marked.groupBy("print").agg(F.min("key").alias("least")), "points")
    links = via_table(point_links(points, radius, shard, full), "point-links")
    found = components(links).select(F.col("node").alias("print"), F.col("component"))
    of_point = via_table(
        points.join(found, "print", "left").select("print", "least", F.coalesce("component", "print").alias("component")),
        "components",
    )
    least = of_point.groupBy("component").agg(F.min("least").alias("component_id"))
    named = via_table(of_point.join(least, "component").select("print", "component_id"), "component-ids")
    digits = F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint")
    return marked.join(named, "print").select("key", digits, "component_id")


# --- fingerprints ---------------------------------------------------------------------------------


def fingerprints(documents: DataFrame, key: str, text: str) -> DataFrame:
    """Rows (key, print): the fingerprint as a long of the same bits."""
    source = documents.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            texts = batch.column("text").cast(pa.large_binary()).to_pylist()
            prints = np.array([fingerprint(raw or b"") for raw in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(prints.view(np.int64))], names=["key", "print"])

    return map_batches(source, run, f"key {source.schema['key'].dataType.simpleString()}, print long")


_LOWER = LOWER.tobytes()


def fingerprint(raw: bytes) -> int:
    """The fingerprint of a text in UTF-8."""
    from xxhash import xxh64_intdigest

    words = raw.translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = min(SHINGLE, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.concatenate(([0], ends[:-1] + 1))
    total = len(words) - size + 1
    counts = np.zeros(BITS, np.int64)
    for start in range(0, total, PIECE_HASHES):
        some = slice(start, min(start + PIECE_HASHES, total))
        spans = zip(begins[some].tolist(), ends[size - 1 :][some].tolist())
        hashes = np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, BITS // 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


# --- the tree over all points --------------------------------------------------------------------


@dataclass
class Node:
    """Points up to ``bound`` bits from ``vantage`` lie inside; a leaf has the number of its shard."""

    vantage: int = 0
    bound: int = 0
    inside: Node | None = None
    outside: Node | None = None
    shard: int = -1


def distances(points: np.ndarray, vantage: int) -> np.ndarray:
    return np.bitwise_count(points ^ np.uint64(vantage))


def vantage_point(points: np.ndarray, draw: np.random.Generator) -> tuple[int, int] | None:
    """The one of some points to which the distances spread most, and their middle; None if none cuts the points."""
    some = points if len(points) <= 1024 else points[draw.integers(0, len(points), 1024)]
    best = None
    for place in draw.integers(0, len(points), CANDIDATES):
        far = distances(some, points[place])
        bound = int(np.median(far))
        inside = np.count_nonzero(far <= bound)
        if inside == len(some):
            bound -= 1
            inside = np.count_nonzero(far <= bound)
        if 0 < inside < len(some):
            spread = float(far.var())
            if best is None or spread > best[0]:
                best = spread, int(points[place]), bound
    return best and best[1:]


def tree(sample: np.ndarray, depth: int, draw: np.random.Generator, shards: list) -> Node:
    cut = vantage_point(sample, draw) if depth and len(sample) > 1 else None
    if cut is None:
        shards.append(len(shards))
        return Node(shard=shards[-1])
    inside = distances(sample, cut[0]) <= cut[1]
    return Node(*cut, tree(sample[inside], depth - 1, draw, shards), tree(sample[~inside], depth - 1, draw, shards))


def routes(node: Node, points: np.ndarray, at: np.ndarray, homes: int, radius: int) -> Iterator[tuple]:
    """(shard, places of points, number of them that are at home) for every shard that points belong to or visit.

    ``at`` has the places of the points that come to this node; the first ``homes`` of them live below it.
    """
    if not len(at):
        return
    if node.shard >= 0:
        yield node.shard, at, homes
        return
    far = distances(points[at], node.vantage).astype(np.int64)
    home = np.arange(len(at)) < homes
    # A pair across the boundary is met outside: what lives inside visits there, not the other way round.
    lives_in, lives_out = home & (far <= node.bound), home & (far > node.bound)
    goes_in, goes_out = ~home & (far <= node.bound + radius), (~home | lives_in) & (far > node.bound - radius)
    for child, lives, goes in ((node.inside, lives_in, goes_in), (node.outside, lives_out, goes_out)):
        yield from routes(child, points, np.concatenate((at[lives], at[goes])), int(lives.sum()), radius)


def point_links(points: DataFrame, radius: int, shard: int, full: int) -> DataFrame:
    """Links (a, b) between fingerprints that have the same components as all pairs within the radius."""
    spark = points.sparkSession
    count = points.count()
    share = min(1.0, SAMPLE / max(count, 1))
    chosen = points.where(F.pmod(F.xxhash64(F.lit(7), "print"), F.lit(1 << 20)) < share * (1 << 20))
    sample = np.sort(chosen.select("print").toArrow()["print"].to_numpy()).view(np.uint64)
    depth = max(0, math.ceil(math.log2(max(1, min(LEAVES, count / shard)))))
    shards: list[int] = []
    root = tree(sample, depth, np.random.default_rng(11), shards)
    sent = spark.sparkContext.broadcast(root)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column("print").to_numpy().view(np.uint64)
            for number, at, homes in routes(sent.value, prints, np.arange(len(prints)), len(prints), radius):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(at), number, np.int32)),
                        pa.array(np.arange(len(at)) < homes),
                        pa.array(prints[at].view(np.int64)),
                    ],
                    names=["shard", "home", "print"],
                )

    dealt = via_table(map_batches(points.select("print"), deal, "shard int, home boolean, print long"), "dealt-points")
    sizes = {row["shard"]: row["n"] for row in dealt.where("home").groupBy("shard").agg(F.count("*").alias("n")).collect()}
    crowded = {number: -(-n // shard) for number, n in sizes.items() if n > full}
    if crowded:
        number = F.create_map(*[F.lit(x) for pair in crowded.items() for x in pair])
        blocks = F.coalesce(F.element_at(number, F.col("shard")), F.lit(1))
        own = F.pmod(F.xxhash64(F.lit(13), "print"), blocks).cast("int")
        first = F.when(F.col("home"), own).otherwise(0)
        dealt = (
            dealt.withColumns({"own": own, "block": F.explode(F.sequence(first, blocks - 1))})
            .withColumn("home", F.col("home") & (F.col("own") == F.col("block")))
            .select("shard", "block", "home", "print")
        )
    else:
        dealt = dealt.withColumn("block", F.lit(0))

    def join(group: pa.Table) -> pa.Table:
        prints, home = group["print"].to_numpy().view(np.uint64), group["home"].to_numpy()
        links = shard_links(prints[home], prints[~home], radius)
        return pa.table([pa.array(side.view(np.int64)) for side in links], names=["a", "b"])

    return map_groups(dealt, ["shard", "block"], join, "a long, b long")


# --- within a shard ---------------------------------------------------------------------------------


def shard_links(homes: np.ndarray, visitors: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Each point that is linked with others of the shard, and the least point of its component in the shard.
    Visitors are not compared with one another."""
    points = np.concatenate((homes, visitors))
    labels = np.arange(len(points))
    places = np.arange(len(points))
    _join_below(points, places[: len(homes)], places[len(homes) :], radius, labels, np.random.default_rng(17))
    linked = np.flatnonzero(labels != places)
    return points[linked], points[labels[linked]]


def _join_below(points, homes, visitors, radius, labels, draw) -> None:
    """Unite the labels of all pairs within the radius of which one at least is at home."""
    if not len(homes) or len(homes) + len(visitors) < 2:
        return
    small = len(homes) * (len(homes) + len(visitors)) <= PAIRS
    cut = None if small else vantage_point(points[homes], draw)
    if cut is None:
        _compare(points, homes, visitors, radius, labels)
        return
    vantage, bound = cut
    far, away = distances(points[homes], vantage).astype(np.int64), distances(points[visitors], vantage).astype(np.int64)
    inside = far <= bound
    near = homes[inside & (far > bound - radius)]
    if inside.all() or not inside.any():
        _compare(points, homes, visitors, radius, labels)
        return
    _join_below(points, homes[inside], visitors[away <= bound + radius], radius, labels, draw)
    beyond = np.concatenate((near, visitors[away > bound - radius]))
    _join_below(points, homes[~inside], beyond, radius, labels, draw)


def _compare(points, homes, visitors, radius, labels) -> None:
    everyone = np.concatenate((homes, visitors))
    width = min(len(homes), 1 << 12)
    rows = max(1, PAIRS // width)
    for left in range(0, len(homes), width):
        some = homes[left : left + width]
        # Of pairs at home one half is enough: those before ``left`` have met these already.
        for start in range(left, len(everyone), rows):
            others = everyone[start : start + rows]
            near = np.bitwise_count(points[others][:, None] ^ points[some][None, :]) <= radius
            a, b = np.nonzero(near)
            unite(labels, others[a], some[b])


def unite(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give both ends of each link the least label that either reaches; labels are places that have themselves."""
    while True:
        one, other = labels[a], labels[b]
        apart = one != other
        if not apart.any():
            return
        a, b, one, other = a[apart], b[apart], one[apart], other[apart]
        np.minimum.at(labels, np.maximum(one, other), np.minimum(one, other))
        while True:
            next_ = labels[labels]
            if (next_ == labels).all():
                break
            labels[:] = next_
