"""Documents whose word shingles overlap, by count vectors in R-trees, and their components.

The shingles of a document are hashed into groups, and the counts of its groups are a point. The
overlap of two documents is at most the sum of the lesser counts of each group, so a pair can
link only if 7 * that sum >= 3 * (sum of both sizes), which is a similarity of 0.75 or more.

1. Documents with the same shingles are one node. A node's shingles are ordered, those of
   seldom filled groups first. By the same bound with the finest groups, two nodes that link share one of the
   first n - ceil(0.75 n) + 1, so it is enough to compare nodes that meet in such a cell. The cells are made and shuffled
   once, and a node that by sizes and places can link with no other of a cell leaves it (unless it has over ``BLOCK`` rows).
2. In each cell every node is held against the cell's least node, so a cell of g nodes gives g - 1 pairs. The first
   shingle that a pair shares bounds its overlap by what follows it in either, so a pair that cannot link if this
   cell is its first is left to the cell that is; but every node is held against the one that it meets most. Pairs that pass the bounds are verified with their full sets, and linked nodes become components.
3. Cells that still hold several components get packed R-trees over their points, in blocks of
   ``BLOCK`` points. Nodes outside the component of the least one search all blocks of their cell; boxes and points that
   cannot reach the overlap are skipped, and surviving pairs of different components are verified.
4. Two components of near copies may have a surviving pair for each two of their nodes, where one link unites them. So a
   bucket of cells gives the ``FEW`` pairs of each component that may overlap most, and names the components that have more.
   Those that are still apart when these pairs are verified search again, for ``FEW`` times as many, until none has more.

So no link between different components is lost (a pair is only left out while both its components are named, and then
searched again), and pairs within a component are not made. All rows of a cell meet in one task, which
passes a large one on in batches and never holds it; copies are sent once by each task that reads them. Trees of large cells are
dealt in blocks. Sets are built again from the text, for the nodes of surviving pairs alone.

Defined results: A to Z are lower-cased and words are what blanks and the controls 0x09 to 0x0D
separate. A text with fewer than five words is one shingle. A null text, or one without words, has none
and links with nothing. Repeated rows share a node. A null id takes part, but names no component.
Columns that are not named do not matter; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitlake.llm.arrow import PIECE_ROWS, map_batches, map_groups, pieces
from visitlake.llm.components import components
from visitlake.llm.textbytes import Texts, mixed, owners, prefix_hashes, span_hashes, texts_of, word_hashes
from visitlake.scratch import release, via_table

WORDS = 5
#: Bits of a shingle's hash; with the document's place in its piece and the level they fill 64.
BITS = 51
LEVEL_BITS = 4
#: Sizes at which a class of sets begins, and the groups of each class. Sets that link differ by a
#: third in size at most, so they are of one class or of neighbouring ones.
CLASS_SIZES = (600, 2400, 9600)
GROUPS = (256, 1024, 4096, 16384)
MOST_IN_GROUP = 15
ORDER_BITS = 18
SLICES = 64
BLOCK = 4096
#: Rows of cells that a bucket has, about.
BUCKET_ROWS = 1 << 13
#: Pairs of each component that a bucket of cells gives in the first round.
FEW = 8
#: Pairs that a bucket collects before it leaves out what it need not give.
COLLECTED = 1 << 18
#: Pairs of rows that are compared at once, and bytes of points that a tree has, about.
PAIRS = 1 << 18
TREE_BYTES = 1 << 24
LEAF = 16
NO_ID = -(2**63)
FILTER_BITS = 1 << 20
MASK = np.uint64((1 << BITS) - 1)
assert PIECE_ROWS <= 1 << (64 - BITS - LEVEL_BITS)


def shingle_sets(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted in each text, and the place of each text's first one."""
    words, first = word_hashes(texts)
    prefix = prefix_hashes(words)
    counts = np.diff(first)
    shingles = np.where(counts >= WORDS, counts - WORDS + 1, np.minimum(counts, 1))
    owner = np.repeat(np.arange(len(texts)), shingles)
    begin = first[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(shingles) - shingles, shingles)
    end = begin + np.minimum(counts, WORDS)[owner]
    hashes = span_hashes(prefix, begin, end) >> np.uint64(64 - BITS)
    marked = np.unique((owner.astype(np.uint64) << np.uint64(BITS)) | hashes)
    edges = np.arange(len(texts) + 1, dtype=np.uint64) << np.uint64(BITS)
    return marked & MASK, np.searchsorted(marked, edges)


def prints(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One hash for each set."""
    total = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(mixed(hashes * np.uint64(0x9FB21C651E98DF25)), out=total[1:])
    size = np.diff(first).astype(np.uint64)
    whole = total[first[1:]] - total[first[:-1]]
    return mixed(whole + size * np.uint64(0xA24BAED4963EE407)).view(np.int64)


def points(hashes: np.ndarray, first: np.ndarray) -> list[bytes]:
    """Counts of the groups of each set, in four bits each, and the sum of what is over 15.

    A larger set has more groups, four times as many for each class of size, so that its groups hold few.
    """
    out = []
    for start, end in zip(first[:-1], first[1:]):
        groups = GROUPS[int(np.searchsorted(CLASS_SIZES, end - start, "right"))]
        counts = np.bincount((hashes[start:end] % np.uint64(groups)).astype(np.int64), minlength=groups)
        low = np.minimum(counts, MOST_IN_GROUP).astype(np.uint8)
        over = np.uint32(end - start - low.sum(dtype=np.int64))
        out.append(((low[0::2] << 4) | low[1::2]).tobytes() + over.tobytes())
    return out


def groups_of(values: list[bytes]) -> np.ndarray:
    """Number of groups of each point."""
    return np.array([2 * (len(value) - 4) for value in values], np.int64)


def read_points(values: list[bytes], groups: int) -> tuple[np.ndarray, np.ndarray]:
    """The counts as a matrix, and what is over. Points of more groups are folded into ``groups``."""
    low, over = np.zeros((len(values), groups), np.uint8), np.zeros(len(values), np.int64)
    own = groups_of(values)
    for number in np.unique(own).tolist():
        at = np.flatnonzero(own == number)
        data = np.frombuffer(b"".join(values[i] for i in at), np.uint8).reshape(len(at), number // 2 + 4)
        counts = np.empty((len(at), number), np.uint8)
        counts[:, 0::2], counts[:, 1::2] = data[:, :-4] >> 4, data[:, :-4] & 15
        # At most four groups are folded into one here, so a byte is enough.
        low[at] = counts.reshape(len(at), number // groups, groups).sum(1, dtype=np.uint8)
        over[at] = np.ascontiguousarray(data[:, -4:]).view(np.uint32)[:, 0]
    return low, over


def most_overlap(low_a, over_a, low_b, over_b) -> np.ndarray:
    """Sum of the lesser counts of the groups, or somewhat more where counts are over 15."""
    return np.minimum(low_a, low_b).sum(-1, dtype=np.int64) + np.minimum(over_a, over_b)


def needed_length(size: np.ndarray) -> np.ndarray:
    """How many shingles from the front of the order a linking pair must share one of."""
    return size - (75 * size + 99) // 100 + 1


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document's size, print and point; and the task's counts of the order's groups in slices."""
    names = ["id", "n", "print", "point", "slice", "task"]
    filled = np.zeros(1 << ORDER_BITS, np.int64)
    for batch in pieces(batches, 1):
        hashes, first = shingle_sets(texts_of(batch.column("text")))
        filled += np.bincount((hashes >> np.uint64(BITS - ORDER_BITS)).astype(np.int64), minlength=len(filled))
        rows = batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"),
                pa.array(np.diff(first)),
                pa.array(prints(hashes, first)),
                pa.array(points(hashes, first), pa.binary()),
                pa.nulls(rows, pa.int32()),
                pa.nulls(rows, pa.int32()),
            ],
            names=names,
        )
    if filled.any():
        yield pa.RecordBatch.from_arrays(
            [
                pa.nulls(SLICES, pa.int64()),
                pa.nulls(SLICES, pa.int64()),
                pa.nulls(SLICES, pa.int64()),
                pa.array([part.tobytes() for part in filled.reshape(SLICES, -1)], pa.binary()),
                pa.array(np.arange(SLICES, dtype=np.int32)),
                pa.array(np.full(SLICES, TaskContext.get().partitionId(), np.int32)),
            ],
            names=names,
        )


def _add_up(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x.as_py(), np.int64) for x in table["point"])
    return pa.table(
        {"slice": table["slice"].slice(0, 1), "task": table["task"].slice(0, 1), "point": pa.array([total.tobytes()], pa.binary())}
    )


def group_levels(described: DataFrame) -> np.ndarray:
    """Level of each group of the order: how many times its count doubles the mean one."""
    counts = described.where(F.col("slice").isNotNull()).select("slice", "task", "point")
    schema = "slice int, task int, point binary"
    some = map_groups(counts, ["slice", F.pmod("task", F.lit(32))], lambda t: _add_up(t), schema)
    parts = map_groups(some, ["slice"], lambda t: _add_up(t), schema).collect()
    filled = np.zeros((SLICES, (1 << ORDER_BITS) // SLICES), np.int64)
    for row in parts:
        filled[row["slice"]] = np.frombuffer(row["point"], np.int64)
    filled = filled.ravel()
    times = filled / max(filled.mean(), 1)
    return np.clip(np.floor(np.log2(np.maximum(times, 1))), 0, (1 << LEVEL_BITS) - 1).astype(np.uint64)


def _cells(texts: DataFrame, levels: np.ndarray) -> DataFrame:
    """Rows (cell, node, n, place): the shingles from the front of each document's order, and their places in it."""
    sent = texts.sparkSession.sparkContext.broadcast(levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in pieces(batches):
            hashes, first = shingle_sets(texts_of(batch.column("text")))
            nodes, size = prints(hashes, first), np.diff(first)
            _, kept = np.unique(nodes, return_index=True)
            kept = kept[[node not in seen for node in nodes[kept].tolist()]]  # copies within the task say the same
            seen.update(nodes[kept].tolist())
            once = np.zeros(len(nodes), bool)
            once[kept] = True
            level = sent.value[(hashes >> np.uint64(BITS - ORDER_BITS)).astype(np.int64)]
            owner = owners(first)
            ranked = (owner.astype(np.uint64) << np.uint64(BITS + LEVEL_BITS)) | (level << np.uint64(BITS)) | hashes
            ranked.sort()
            place = np.arange(len(ranked)) - first[owner]
            front = (place < needed_length(size)[owner]) & once[owner]
            owner = owner[front]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array((ranked[front] & MASK).view(np.int64)),
                    pa.array(nodes[owner]),
                    pa.array(size[owner].astype(np.int32)),
                    pa.array(place[front].astype(np.int32)),
                ],
                names=["cell", "node", "n", "place"],
            )

    return map_batches(texts.select("text"), run, "cell long, node long, n int, place int")


def may_link(n: np.ndarray, rest: np.ndarray, other_n: np.ndarray, other_rest: np.ndarray) -> np.ndarray:
    """Whether two sets can link by their sizes, if a cell is the first that they share: nothing before it is common,
    so what either has from there on (``rest``) bounds the overlap."""
    fits = 4 * np.minimum(n, other_n) >= 3 * np.maximum(n, other_n)
    return fits & (7 * np.minimum(rest, other_rest) >= 3 * (n + other_n))


def pairs_within(begin: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All (i, j) with begin[i] <= j < end[i], in parts of about ``PAIRS``."""
    counts = end - begin
    total = np.cumsum(counts)
    start = 0
    while start < len(counts):
        done = total[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(total, done + PAIRS, "right")))
        own = counts[start:stop]
        i = np.repeat(np.arange(start, stop), own)
        yield i, np.arange(len(i)) - np.repeat(np.cumsum(own) - own, own) + begin[i]
        start = stop


def with_partner(cell: np.ndarray, n: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Which of the rows, ordered by cell, have another one in their cell with which they may link."""
    begin, end = np.searchsorted(cell, cell), np.searchsorted(cell, cell, "right")
    found = np.zeros(len(cell), bool)
    for i, j in pairs_within(np.arange(1, len(cell) + 1), end):
        fits = may_link(n[i], rest[i], n[j], rest[j])
        found[i[fits]] = found[j[fits]] = True
    # Pairs of a cell of very many rows are not formed.
    return found | (end - begin > BLOCK)


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows ordered by cell and node those that may link with another one in their cell, once each, with the least
    node of these as the cell's lead. A cell of more rows than ``BLOCK`` is passed on as it comes, whole."""
    names = ["cell", "node", "n", "place"]
    rows = [np.zeros(0, np.int64) for _ in names]
    large, lead, last = None, 0, 0  # a cell of which rows have been passed on

    def settled(rows: list[np.ndarray]) -> pa.RecordBatch:
        cell, node, n, place = rows
        kept = with_partner(cell, n, n - place)
        cell, node, n, place = (x[kept] for x in rows)
        least = node[np.searchsorted(cell, cell)]
        columns = [cell, least, node, n.astype(np.int32), place.astype(np.int32)]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["cell", "lead", "node", "n", "place"])

    def passed(rows: list[np.ndarray]) -> pa.RecordBatch:
        cell, node, n, place = rows
        columns = [cell, np.full(len(cell), lead), node, n.astype(np.int32), place.astype(np.int32)]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["cell", "lead", "node", "n", "place"])

    for batch in batches:
        rows = [np.concatenate((x, batch.column(name).to_numpy().astype(np.int64))) for x, name in zip(rows, names)]
        once = np.ones(len(rows[0]), bool)
        once[1:] = (rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1])
        rows = [x[once] for x in rows]
        if large is not None:
            more = int(np.searchsorted(rows[0], large, "right"))
            own = [x[:more] for x in rows]
            fresh = own[1] != last
            if fresh.any():
                yield passed([x[fresh] for x in own])
                last = own[1][-1]
            rows = [x[more:] for x in rows]
            if not len(rows[0]):
                continue
            large = None
        if not len(rows[0]):
            continue
        whole = int(np.searchsorted(rows[0], rows[0][-1]))
        if whole:
            yield settled([x[:whole] for x in rows])
            rows = [x[whole:] for x in rows]
        if len(rows[0]) > BLOCK:
            large, lead, last = rows[0][0], rows[1][0], rows[1][-1]
            yield passed(rows)
            rows = [x[:0] for x in rows]
    if len(rows[0]):
        yield settled(rows)


def _within(a: str, b: str) -> Column:
    """Sizes that allow a link."""
    return 4 * F.least(a, b) >= 3 * F.greatest(a, b)


def _may_meet_first(n: str, place: str, other_n: str, other_place: str) -> Column:
    """Whether two nodes can link if a shingle at these places is the first that they share: nothing before it is
    common, so the rest of either bounds the overlap."""
    most = F.least(F.col(n) - F.col(place), F.col(other_n) - F.col(other_place))
    return 7 * most >= 3 * (F.col(n) + F.col(other_n))


def _verified(texts: DataFrame, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) that link: first by their points, then by their sets."""
    for side in "ab":
        own = nodes.select(
            F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("point").alias(f"point_{side}")
        )
        pairs = pairs.join(own, side)
    pairs = pairs.where(_within("n_a", "n_b")).select("a", "b", "n_a", "n_b", "point_a", "point_b")
    pairs = via_table(map_batches(pairs, _may_overlap, "a long, b long"), "may-overlap")
    sets, wanted = _sets(texts, nodes, pairs)
    with_sets = pairs
    for side in "ab":
        own = sets.select(F.col("node").alias(side), F.col("shingles").alias(f"set_{side}"))
        with_sets = with_sets.join(own, side)
    linked = map_batches(with_sets.select("a", "b", "set_a", "set_b"), _overlap, "a long, b long")
    linked = via_table(linked, "verified-links")
    release(pairs, wanted)
    return linked


def _may_overlap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose summed lesser counts reach the overlap that a link needs."""
    for batch in pieces(batches):
        values = [batch.column(name).to_pylist() for name in ("point_a", "point_b")]
        groups = np.minimum(*map(groups_of, values))
        least = np.zeros(batch.num_rows, np.int64)
        for number in np.unique(groups).tolist():
            at = np.flatnonzero(groups == number)
            a, b = (read_points([side[i] for i in at], number) for side in values)
            least[at] = most_overlap(*a, *b)
        sizes = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
        yield batch.select(["a", "b"]).filter(pa.array(7 * least >= 3 * sizes))


def _overlap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose sets have at least three quarters of their union in common."""
    for batch in pieces(batches):
        linked = []
        for x, y in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist()):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(x) + len(y) - len(np.union1d(x, y))
            linked.append(100 * both >= 75 * (len(x) + len(y) - both))
        yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))


def _sets(texts: DataFrame, nodes: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (node, shingles) for the nodes of the pairs, from the text of one document each; and
    the table of these nodes.

    A bit field of fixed size tells which documents may be wanted; only their sets are built and
    move. Where so many are wanted that the field is full, all sets are built.
    """
    ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))
    wanted = via_table(ends.distinct().join(nodes, "node").select("node", "id"), "wanted")
    bit = F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS)).alias("bit")
    field = np.zeros(FILTER_BITS, bool)
    field[wanted.select(bit).distinct().toArrow()["bit"].to_numpy()] = True
    packed = np.packbits(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("bit").to_numpy()
            maybe = (packed[at >> 3] >> (7 - (at & 7))) & 1
            for piece in pieces([batch.filter(pa.array(maybe.astype(bool)))]):
                hashes, first = shingle_sets(texts_of(piece.column("text")))
                sets = [hashes[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("id"), pa.array(prints(hashes, first)), pa.array(sets, pa.binary())],
                    names=["id", "node", "shingles"],
                )

    built = map_batches(texts.select("id", bit, "text"), run, "id long, node long, shingles binary")
    sets = built.join(wanted, ["id", "node"], "left_semi").select("node", "shingles")
    return sets.dropDuplicates(["node"]), wanted


class CountTree:
    """A packed R-tree of two levels over points: leaves of up to ``LEAF`` points of similar size, of one cell each."""

    def __init__(self, points: np.ndarray, over: np.ndarray, sizes: np.ndarray, cells: np.ndarray | None = None):
        cells = np.zeros(len(points), np.int64) if cells is None else cells
        self.order = np.lexsort((points.argmax(1), sizes, cells))
        self.place = np.empty(len(points), np.int64)
        self.place[self.order] = np.arange(len(points))
        self.points, self.over, self.sizes = points[self.order], over[self.order], sizes[self.order]
        ordered = cells[self.order]
        starts = (np.arange(len(points)) - np.searchsorted(ordered, ordered)) % LEAF == 0
        self.leaf = np.cumsum(starts) - 1
        starts = np.flatnonzero(starts)
        self.high = np.maximum.reduceat(self.points, starts, axis=0)
        self.high_over = np.maximum.reduceat(self.over, starts)
        self.least_size = np.minimum.reduceat(self.sizes, starts)
        self.most_size = np.maximum.reduceat(self.sizes, starts)

    def search(self, point: np.ndarray, over: int, size: int) -> np.ndarray:
        """Places of the points whose summed coordinate minima with ``point`` allow a link."""
        every = np.arange(len(self.points))
        return every[self.reach(point[None], np.array([over]), np.array([size]), np.zeros_like(every), every)[0]]

    def reach(
        self, points: np.ndarray, over: np.ndarray, sizes: np.ndarray, asked: np.ndarray, found: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Which pairs of a query (place in ``points``) and a point of the tree allow a link, and their summed minima.
        Boxes that a query cannot link with are skipped with all their points."""
        place = self.place[found]
        leaves = len(self.high)
        visits, visit = np.unique(asked * leaves + self.leaf[place], return_inverse=True)
        query, leaf = np.divmod(visits, leaves)
        boxes = (4 * self.least_size[leaf] <= 5.34 * sizes[query]) & (4 * self.most_size[leaf] >= 3 * sizes[query])
        most = _overlaps(self.high, self.high_over, points, over, leaf, query, boxes)
        boxes &= 7 * most >= 3 * (self.least_size[leaf] + sizes[query])
        n, other = self.sizes[place], sizes[asked]
        fits = boxes[visit] & (4 * np.minimum(n, other) >= 3 * np.maximum(n, other))
        most = _overlaps(self.points, self.over, points, over, place, asked, fits)
        fits &= 7 * most >= 3 * (n + other)
        return fits, most


def _overlaps(low_a, over_a, low_b, over_b, a, b, wanted) -> np.ndarray:
    """``most_overlap`` of the wanted pairs of places, 0 for others; a part at a time."""
    most = np.zeros(len(a), np.int64)
    rows = np.flatnonzero(wanted)
    step = max(1, TREE_BYTES // 4 // low_a.shape[1])
    for start in range(0, len(rows), step):
        at = rows[start : start + step]
        most[at] = most_overlap(low_a[a[at]], over_a[a[at]], low_b[b[at]], over_b[b[at]])
    return most


class Crossing:
    """Pairs of nodes of different components: for each component the ``keep`` that may overlap most."""

    def __init__(self, keep: int):
        self.keep, self.waiting, self.size = keep, [], 0
        self.kept = np.zeros((4, 0), np.int64), np.zeros(0)
        self.more = np.zeros(0, np.int64)

    def add(self, nodes: np.ndarray, components: np.ndarray, share: np.ndarray) -> None:
        """Pairs as two rows of nodes, two of their components, and the share that they may have in common."""
        turned = nodes[0] > nodes[1]
        nodes, components = (np.where(turned, x[::-1], x) for x in (nodes, components))
        self.waiting.append((np.concatenate((nodes, components)), share))
        self.size += len(share)
        if self.size >= COLLECTED:
            self.settle()

    def settle(self) -> None:
        """Leave out pairs that are among the best of neither of their components, and remember both."""
        pairs, share = (np.concatenate(x, -1) for x in zip(self.kept, *self.waiting))
        self.waiting, self.size = [], 0
        _, once = np.unique(pairs[:2], axis=1, return_index=True)
        pairs, share = pairs[:, once], share[once]
        component, place = pairs[2:].ravel(), np.tile(np.arange(len(share)), 2)
        order = np.lexsort((place, -share[place], component))
        ordered = component[order]
        rank = np.arange(len(order)) - np.searchsorted(ordered, ordered)
        best = np.zeros(len(share), bool)
        best[place[order[rank < self.keep]]] = True
        self.more = np.union1d(self.more, pairs[2:, ~best])
        self.kept = pairs[:, best], share[best]

    def rows(self) -> pa.Table:
        self.settle()
        a, b = self.kept[0][:2]
        more = np.repeat([False, True], [len(a), len(self.more)])
        return pa.table({"a": np.append(a, self.more), "b": np.append(b, self.more), "more": more})


def _search_cells(table: pa.Table, keep: int) -> pa.Table:
    """Pairs (a, b) of different components from the cells of a bucket, by trees whose leaves are of one cell each, and
    (a, a) for each component that has more of them."""
    table = table.take(np.argsort(table["cell"].to_numpy(), kind="stable"))
    cell, node, n = table["cell"].to_numpy(), table["node"].to_numpy(), table["n"].to_numpy().astype(np.int64)
    component, lead = table["component"].to_numpy(), table["lead"].to_numpy()
    rest = n - table["place"].to_numpy()
    searches, stored = table["searches"].to_numpy(zero_copy_only=False), table["stored"].to_numpy(zero_copy_only=False)
    values = table["point"].to_pylist()
    groups = groups_of(values)
    crossing = Crossing(keep)
    data, queries = np.flatnonzero(stored), np.flatnonzero(searches & (node != lead))
    begin, end = (np.searchsorted(cell[data], cell[queries], side) for side in ("left", "right"))
    for i, j in pairs_within(begin, end):
        q, d = queries[i], data[j]
        # A pair with the cell's least node has been verified already; one that cannot link if this
        # cell is the first that it shares is met in another; one that meets both ways here is searched once.
        wanted = (component[d] != component[q]) & (node[d] != lead[q]) & may_link(n[q], rest[q], n[d], rest[d])
        wanted &= ~(searches[d] & stored[q]) | (node[q] > node[d])
        q, d = q[wanted], d[wanted]
        least = np.minimum(groups[q], groups[d])
        for number in np.unique(least).tolist():
            own = least == number
            for some_q, some_d in _parts(q[own], d[own], max(1, TREE_BYTES // number)):
                (asked, by), (kept, to) = (np.unique(x, return_inverse=True) for x in (some_q, some_d))
                tree = CountTree(*read_points([values[x] for x in kept], number), n[kept], cell[kept])
                fits, most = tree.reach(*read_points([values[x] for x in asked], number), n[asked], by, to)
                found, most = np.stack((some_d[fits], some_q[fits])), most[fits]
                if len(most):
                    crossing.add(node[found], component[found], most / n[found].sum(0))
    return crossing.rows()


def _parts(q: np.ndarray, d: np.ndarray, rows: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs in parts that name about so many different rows on either side."""
    step = rows if max(len(np.unique(q)), len(np.unique(d))) > rows else max(len(q), 1)
    for start in range(0, len(q), step):
        yield q[start : start + step], d[start : start + step]


def _labelled(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """Rows (node, component) of all nodes."""
    found = components(links).select(F.col("node").alias("linked"), F.col("component").alias("found"))
    return nodes.select("node").join(found, F.col("node") == F.col("linked"), "left").select(
        "node", F.coalesce("found", "node").alias("component")
    )


def near_duplicates(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Rows (key, n_shingles, component_id) for every document."""
    texts = docs.select(
        F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    schema = "id long, n long, print long, point binary, slice int, task int"
    described = via_table(map_batches(texts, _describe, schema), "described")
    sized = described.where(F.col("slice").isNull())
    nodes = (
        sized.where(F.col("n") > 0)
        .groupBy(F.col("print").alias("node"))
        .agg(F.min("id").alias("id"), F.min(F.nullif("id", F.lit(NO_ID))).alias("least"),
             F.first("n").cast("int").alias("n"), F.first("point").alias("point"))
    )
    nodes = via_table(nodes, "nodes")

    met = _cells(texts, group_levels(described)).repartition("cell").sortWithinPartitions("cell", "node")
    members = via_table(map_batches(met, _members, "cell long, lead long, node long, n int, place int"), "members")
    leads = members.where(F.col("node") == F.col("lead")).select(
        F.col("cell").alias("of"), F.col("n").alias("lead_n"), F.col("place").alias("lead_place")
    )
    met_leads = (
        members.where(F.col("node") != F.col("lead"))
        .join(leads, F.col("cell") == F.col("of"))
        .groupBy(F.col("lead").alias("a"), F.col("node").alias("b"))
        .agg(F.count("*").alias("cells"), F.max(_may_meet_first("n", "place", "lead_n", "lead_place")).alias("first"))
    )
    # Besides, each node with the lead that it meets most often, which unites groups of copies at once.
    often = F.row_number().over(Window.partitionBy("b").orderBy(F.desc("cells"), "a"))
    led = met_leads.withColumn("often", often).where(F.col("first") | (F.col("often") == 1)).select("a", "b")
    links = [_verified(texts, nodes, led)]
    labels = via_table(_labelled(nodes, links[0]), "labels")
    apart, keep = None, FEW
    while apart is None or apart.count() > 1:
        crossing = _crossing(members, nodes, labels, apart, keep)
        links.append(_verified(texts, nodes, crossing.where("not more").select("a", "b")))
        release(labels, *[] if apart is None else [apart])
        labels = via_table(_labelled(nodes, reduce(DataFrame.unionByName, links)), "labels")
        more = crossing.where("more").join(labels, F.col("a") == F.col("node"))
        apart = via_table(more.select("component").distinct(), "apart")
        release(crossing)
        keep *= FEW
    release(members, apart)
    least = nodes.join(labels, "node").groupBy("component").agg(F.min("least").alias("found"))
    named = labels.join(least, "component").select(F.col("node").alias("print"), "found")
    named = via_table(named, "components")
    slim = via_table(sized.select("id", "n", "print"), "sizes")
    release(described, nodes, labels, *links)
    return (
        slim.withColumn("print", F.when(F.col("n") > 0, F.col("print")).otherwise(F.xxhash64("id")))
        .join(named, "print", "left")
        .select(
            F.nullif("id", F.lit(NO_ID)).alias("key"),
            F.col("n").alias("n_shingles"),
            F.when(F.col("n") > 0, F.col("found")).otherwise(F.nullif("id", F.lit(NO_ID))).alias("component_id"),
        )
    )


def _crossing(
    members: DataFrame, nodes: DataFrame, labels: DataFrame, only: DataFrame | None, keep: int
) -> DataFrame:
    """Rows (a, b, more): pairs of different components that meet in a cell and pass the tree's bounds, of each
    component and bucket of cells at least the ``keep`` best; and with ``more`` the components that have others. With
    ``only``, pairs between these components."""
    own = labels if only is None else via_table(labels.join(only, "component", "left_semi"), "own-labels")
    known = members.join(own, "node").join(
        labels.select(F.col("node").alias("lead"), F.col("component").alias("lead_component")), "lead"
    )
    known = via_table(known, "labelled-members")
    if only is not None:
        release(own)
    # Two members of a whole cell are the least one and another, which have been verified.
    open_cells = (
        known.groupBy(F.col("cell").alias("of"))
        .agg(
            F.count("*").alias("size"),
            F.count_if(F.col("component") != F.col("lead_component")).alias("outside"),
            (F.min("component") < F.max("component")).alias("several"),
        )
        .where((F.col("size") > (2 if only is None else 1)) & (F.col("outside") > 0) & F.col("several"))
        .withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    )
    open_cells = via_table(open_cells, "open-cells")
    dealt = open_cells.agg(F.sum(F.col("size") + F.col("outside") * (F.col("blocks") - 1))).first()[0] or 0
    own = nodes.select(F.col("node").alias("point_of"), "point")
    rows = (
        known.join(open_cells, F.col("cell") == F.col("of"))
        .join(own, F.col("node") == F.col("point_of"))
        .withColumn("home", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("searches", F.col("component") != F.col("lead_component"))
        .withColumn(
            "block",
            F.explode(
                F.when(F.col("searches"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("home"))
            ),
        )
        .withColumn("stored", F.col("block") == F.col("home"))
        .withColumn("bucket", F.xxhash64("cell", "block"))
        .select("cell", "block", "node", "n", "place", "component", "lead", "searches", "stored", "point", "bucket")
    )
    partitions = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.pmod("bucket", F.lit(max(8 * partitions, -(-dealt // BUCKET_ROWS)))).alias("bucket_number")]
    pairs = map_groups(rows, by, lambda t: _search_cells(t, keep), "a long, b long, more boolean").distinct()
    pairs = via_table(pairs, "crossing-pairs")
    release(known, open_cells)
    return pairs
