"""Ranked lexical search: posting lists with range-maximum tables, searched best first.

The terms of a block of items are the vocabulary. One pass over the documents finds their terms that are in
it; counts over all documents give each term its weight and each posting its impact, a whole number. A
task holds the postings of some thousand documents at a time, term by term in ascending order of
document, with one sparse table of range maxima over them.

For an item, an interval of documents is bounded by the sum of its terms' maxima in it. The intervals
with the highest bounds are split at the document that holds their largest impact: that document is scored and
what lies on each side becomes an interval with its own bound. Short intervals are scored whole. A
search ends when no bound reaches the k-th best score that its task knows. The tasks' best rows are merged in two steps.

How it is distributed: texts and postings never move. Only a block's vocabulary (``BLOCK_TERMS``, and what one item
has beyond it) and its weights are sent to all tasks; items beyond that are further blocks, each of
which passes over the documents. Results of a task are k rows per item at most.

Defined results: a null text has no terms; rows of one item id are one item with the terms of all; an item
without terms, or whose terms no document has, gives no rows; a null item id is an id. A repeated document counts
and is listed as often as it occurs. Equal scores are in ascending order of key, null keys last.
Columns that are not named do not matter; without documents or items there are no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitlake.llm.arrow import map_batches, pieces
from visitlake.llm.textbytes import (
    LOWER_VALUES,
    OTHER_LOWER_VALUES,
    Texts,
    owners,
    prefix_hashes,
    span_hashes,
    texts_of,
    word_spans,
)
from visitlake.scratch import via_table

#: Fixed value: what a term is, in any alphabet; only A to Z are lower-cased.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BETWEEN_TERMS = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])

#: Terms of the items that are searched together.
BLOCK_TERMS = 1 << 18
#: Postings and documents that a task indexes at a time.
SHARD_POSTINGS = 1 << 20
SHARD_DOCUMENTS = 1 << 15
#: Intervals of at most so many documents are scored whole; so many intervals are split at a time.
SHORT = 64
WAVE = 128
#: The tasks' best rows are first merged in so many parts.
PARTS = 64
#: Whole numbers up to here are exact as doubles.
EXACT = 1 << 53


def top_documents(
    documents: DataFrame,
    key: str,
    text: str,
    items: DataFrame,
    item: str,
    item_text: str,
    k: int = 50,
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """Rows (item, rank, key, score): the ``k`` best documents of each item. ``key`` is a long."""
    lowered = F.translate(F.col(item_text).cast("string"), UPPER, UPPER.lower())
    terms = items.select(
        F.col(item).alias("item"), F.explode(F.regexp_extract_all(lowered, F.lit(TERM), 0)).alias("term")
    )
    terms = via_table(terms.distinct(), "item-terms")
    blocks = max(1, math.ceil(terms.count() / block_terms))
    found = None
    for block in range(blocks):
        mine = terms.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block)
        rows = _search_block(documents, key, text, mine, k)
        found = rows if found is None else found.unionByName(rows)
    best = [F.desc("score"), F.asc_nulls_last("key")]
    some = F.row_number().over(Window.partitionBy("item", "part").orderBy(*best))
    rank = F.row_number().over(Window.partitionBy("item").orderBy(*best))
    return (
        found.withColumn("place", some)
        .where(F.col("place") <= k)
        .withColumn("rank", rank)
        .where(F.col("rank") <= k)
        .select("item", "rank", "key", "score")
    )


@dataclass
class Block:
    """Some items: their vocabulary with two hashes and the weight of each term, and each item's terms."""

    items: pa.Array
    terms: list[np.ndarray]
    hashes: np.ndarray
    others: np.ndarray
    weights: np.ndarray | None = None
    documents: int = 0
    length: int = 0


def _block(rows: pa.Table) -> Block:
    vocabulary = pc.unique(rows.column("term").combine_chunks()) if len(rows) else pa.array([], pa.string())
    found, items = rows.column("term"), rows.column("item")
    place = pc.index_in(found, vocabulary).to_numpy().astype(np.int64)
    texts = texts_of(vocabulary)
    hashes, others = _hashes(texts, *_ends(texts))
    order = np.argsort(hashes)
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    place = rank[place]
    distinct = pc.unique(items.combine_chunks()) if len(rows) else pa.array([], rows.schema.field("item").type)
    owner = pc.index_in(items, distinct).to_numpy().astype(np.int64)
    by_owner = np.argsort(owner, kind="stable")
    cuts = np.searchsorted(owner[by_owner], np.arange(1, len(distinct)))
    terms = [np.sort(part) for part in np.split(place[by_owner], cuts)] if len(rows) else []
    return Block(distinct, terms, hashes[order], others[order])


def _ends(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    return texts.starts[:-1], texts.starts[1:]


def _hashes(texts: Texts, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return tuple(
        span_hashes(prefix_hashes(values[texts.data]), begins, ends)
        for values in (LOWER_VALUES, OTHER_LOWER_VALUES)
    )


def _search_block(documents: DataFrame, key: str, text: str, terms: DataFrame, k: int) -> DataFrame:
    spark = documents.sparkSession
    block = _block(terms.toArrow())
    item_type = terms.schema["item"].dataType
    schema = T.StructType(
        [
            T.StructField("item", item_type),
            T.StructField("key", T.LongType()),
            T.StructField("score", T.LongType()),
            T.StructField("part", T.IntegerType()),
        ]
    )
    if not block.terms:
        return spark.createDataFrame([], schema)
    postings = via_table(_postings(documents, key, text, block), "postings")
    block.weights = np.zeros(len(block.hashes), np.int64)
    found = {row["term"]: row["n"] for row in _counts(postings).collect()}
    block.documents, block.length = found.pop(-1, 0), found.pop(-2, 0)
    for term, n in found.items():
        block.weights[term] = math.floor(1000 * math.log((2 * block.documents + 2) / (2 * n + 1)))
    sent = spark.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in sent.value.items]
        for keys, nulls, n, terms, times, first in _shards(batches):
            shard = Shard.build(sent.value, keys, nulls, n, terms, times, first)
            for wanted, top in zip(sent.value.terms, best):
                shard.search(wanted, top)
        yield from _best_rows(sent.value.items, best)

    rows = map_batches(postings, run, T.StructType(schema.fields[:-1]))
    return rows.withColumn("part", F.spark_partition_id() % PARTS)


def _postings(documents: DataFrame, key: str, text: str, block: Block) -> DataFrame:
    """Rows (key, n, terms, times): the number of terms of each document that has any, and those of the
    vocabulary in it, as places, with how often they occur (packed 32-bit integers)."""
    sent = documents.sparkSession.sparkContext.broadcast((block.hashes, block.others))
    source = documents.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, others = sent.value
        for batch in pieces(batches):
            texts = texts_of(batch.column("text"))
            begins, ends, first = word_spans(texts, BETWEEN_TERMS)
            hashes = span_hashes(prefix_hashes(LOWER_VALUES[texts.data]), begins, ends)
            place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            met = np.flatnonzero(known[place] == hashes)
            place = place[met]
            second = span_hashes(prefix_hashes(OTHER_LOWER_VALUES[texts.data]), begins[met], ends[met])
            same = others[place] == second
            met, place = met[same], place[same]
            marked, times = np.unique((owners(first)[met] << 32) | place, return_counts=True)
            cuts = np.searchsorted(marked, np.arange(len(texts) + 1, dtype=np.int64) << 32)
            n = np.diff(first)
            kept = np.flatnonzero(n > 0)
            place, times = (marked & 0xFFFFFFFF).astype(np.int32), times.astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key").take(pa.array(kept)),
                    pa.array(n[kept].astype(np.int64)),
                    pa.array([place[cuts[i] : cuts[i + 1]].tobytes() for i in kept], pa.binary()),
                    pa.array([times[cuts[i] : cuts[i + 1]].tobytes() for i in kept], pa.binary()),
                ],
                names=["key", "n", "terms", "times"],
            )

    return map_batches(source, run, "key long, n long, terms binary, times binary")


def _counts(postings: DataFrame) -> DataFrame:
    """Rows (term, n): documents of each term; of all documents as -1, and of all their terms as -2."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = pc.sum(batch.column("n")).as_py() or 0
            packed = np.frombuffer(b"".join(batch.column("terms").to_pylist()), np.int32)
            found, times = np.unique(packed, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(([-1, -2], found)).astype(np.int64)),
                    pa.array(np.concatenate(([batch.num_rows, n], times)).astype(np.int64)),
                ],
                names=["term", "n"],
            )

    counted = map_batches(postings.select("n", "terms"), run, "term long, n long")
    return counted.groupBy("term").agg(F.sum("n").alias("n"))


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Columns of some thousand documents at a time; the last is the place of each one's first posting."""
    held: list[tuple] = []
    rows = size = 0
    for batch in batches:
        lengths = pc.divide(pc.binary_length(batch.column("terms")), 4).to_numpy().astype(np.int64)
        start = 0
        while start < batch.num_rows:
            # As many rows as still fit, by number and by postings, and one at least.
            room = np.searchsorted(np.cumsum(lengths[start:]), SHARD_POSTINGS - size, side="right")
            count = max(1, min(int(room), SHARD_DOCUMENTS - rows)) if not rows else min(int(room), SHARD_DOCUMENTS - rows)
            if count:
                held.append((batch.slice(start, count), lengths[start : start + count]))
                rows, size, start = rows + count, size + int(lengths[start : start + count].sum()), start + count
            if start < batch.num_rows:
                yield _columns(held)
                held, rows, size = [], 0, 0
    if held:
        yield _columns(held)


def _columns(held: list[tuple]) -> tuple:
    keys = pa.concat_arrays([part.column("key") for part, _ in held])
    packed = [
        np.frombuffer(b"".join(value for part, _ in held for value in part.column(name).to_pylist()), np.int32)
        for name in ("terms", "times")
    ]
    first = np.concatenate(([0], np.cumsum(np.concatenate([lengths for _, lengths in held]))))
    n = np.concatenate([part.column("n").to_numpy() for part, _ in held])
    return pc.fill_null(keys, 0).to_numpy(), keys.is_null().to_numpy(zero_copy_only=False), n, *packed, first


@dataclass
class Best:
    """The k best rows so far, best first."""

    k: int
    scores: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    nulls: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))

    def add(self, scores: np.ndarray, keys: np.ndarray, nulls: np.ndarray) -> None:
        if self.is_full():
            may = scores >= self.scores[-1]
            scores, keys, nulls = scores[may], keys[may], nulls[may]
        scores = np.concatenate((self.scores, scores))
        keys, nulls = np.concatenate((self.keys, keys)), np.concatenate((self.nulls, nulls))
        order = np.lexsort((keys, nulls, -scores))[: self.k]
        self.scores, self.keys, self.nulls = scores[order], keys[order], nulls[order]

    def is_full(self) -> bool:
        return len(self.scores) == self.k


def _best_rows(items: pa.Array, best: list[Best]) -> Iterator[pa.RecordBatch]:
    for start in range(0, len(best), 1000):
        some = best[start : start + 1000]
        owner = np.repeat(np.arange(start, start + len(some)), [len(top.scores) for top in some])
        yield pa.RecordBatch.from_arrays(
            [
                items.take(pa.array(owner)),
                pa.array(np.concatenate([top.keys for top in some]), mask=np.concatenate([top.nulls for top in some])),
                pa.array(np.concatenate([top.scores for top in some])),
            ],
            names=["item", "key", "score"],
        )


@dataclass
class Shard:
    """Postings of some documents, term by term, and their range maxima.

    ``places`` orders all postings by term and document; ``levels[j][i]`` is the place of the largest impact
    among the 2^j postings from i on.
    """

    keys: np.ndarray
    nulls: np.ndarray
    places: np.ndarray
    impacts: np.ndarray
    levels: np.ndarray

    @staticmethod
    def build(block: Block, keys, nulls, n, terms, times, first) -> Shard:
        order = np.lexsort((keys, nulls))
        new = np.empty_like(order)
        new[order] = np.arange(len(order))
        document = new[owners(first)]
        size = norms(n, block)[owners(first)]
        times = times.astype(np.int64)
        impacts = block.weights[terms] * ((1_000_000_000 * times) // (1000 * times + 20 * size))
        places = terms.astype(np.int64) * len(keys) + document
        by_term = np.argsort(places)
        places, impacts = places[by_term], impacts[by_term]
        return Shard(keys[order], nulls[order], places, impacts, maxima(impacts, len(keys)))

    def search(self, terms: np.ndarray, best: Best) -> None:
        """Add this shard's documents to the best of an item."""
        size = len(self.keys)
        left, right = np.searchsorted(self.places, terms * size), np.searchsorted(self.places, (terms + 1) * size)
        some = right > left
        terms, open_ = terms[some], Intervals.whole(self, left[some], right[some])
        if not len(terms):
            return
        while len(open_.low):
            open_ = open_.only(self._may_hold(open_, best))
            if not len(open_.low):
                return
            first = np.argsort(-open_.bound, kind="stable")
            wave, open_ = open_.only(first[:WAVE]), open_.only(first[WAVE:])
            short = wave.high - wave.low <= SHORT
            if short.any():
                self._score_whole(wave.only(short), best)
            if not short.all():
                open_ = open_.joined(self._split(wave.only(~short), terms, best))

    def _may_hold(self, open_: Intervals, best: Best) -> np.ndarray:
        """Intervals in which a document can still be among the best."""
        if not best.is_full():
            return open_.bound > 0
        last, null = best.keys[-1], best.nulls[-1]
        given = len(self.nulls) - np.count_nonzero(self.nulls)
        earlier = given if null else np.searchsorted(self.keys[:given], last)
        least = best.scores[-1]
        return (open_.bound > least) | ((open_.bound == least) & (open_.low < earlier))

    def _split(self, wave: Intervals, terms: np.ndarray, best: Best) -> Intervals:
        """Score the document with the largest impact of each interval; returns what lies beside them."""
        rows = np.arange(len(wave.low))
        largest = np.argmax(wave.impacts(self), axis=1)
        size = len(self.keys)
        middle = self.places[wave.top[rows, largest]] % size
        wanted = terms[None, :] * size + middle[:, None]
        at = np.searchsorted(self.places, wanted)
        has = self.places[np.minimum(at, len(self.places) - 1)] == wanted
        scores = (self.impacts[np.minimum(at, len(self.impacts) - 1)] * has).sum(1)
        best.add(scores, self.keys[middle], self.nulls[middle])
        before = Intervals.of(self, wave.low, middle, wave.left, at)
        return before.joined(Intervals.of(self, middle + 1, wave.high, at + has, wave.right))

    def _score_whole(self, short: Intervals, best: Best) -> None:
        counts = short.right - short.left
        total = counts.ravel()
        begins = np.repeat(short.left.ravel() - np.concatenate(([0], np.cumsum(total)[:-1])), total)
        at = begins + np.arange(len(begins))
        row = np.repeat(np.arange(len(short.low)), counts.sum(1))
        slot = row * SHORT + self.places[at] % len(self.keys) - short.low[row]
        impacts = self.impacts[at]
        if short.bound.max() < EXACT:
            scores = np.bincount(slot, impacts, len(short.low) * SHORT).astype(np.int64)
        else:
            scores = np.zeros(len(short.low) * SHORT, np.int64)
            np.add.at(scores, slot, impacts)
        scored = np.flatnonzero(scores > 0)
        document = short.low[scored // SHORT] + scored % SHORT
        best.add(scores[scored], self.keys[document], self.nulls[document])


@dataclass
class Intervals:
    """Intervals of documents, low to high; per term the places of its postings there, left to right, and
    that of the largest (-1 without any); and the sum of the largest impacts."""

    low: np.ndarray
    high: np.ndarray
    left: np.ndarray
    right: np.ndarray
    top: np.ndarray
    bound: np.ndarray

    @staticmethod
    def whole(shard: Shard, left: np.ndarray, right: np.ndarray) -> Intervals:
        ends = np.array([0]), np.array([len(shard.keys)])
        return Intervals.of(shard, *ends, left[None, :], right[None, :])

    @staticmethod
    def of(shard: Shard, low, high, left, right) -> Intervals:
        count = right - left
        some = count > 0
        level = np.frexp(np.maximum(count, 1))[1] - 1
        start = np.minimum(left, len(shard.places) - 1)
        end = np.maximum(right - (1 << level), 0)
        one, other = shard.levels[level, start], shard.levels[level, np.minimum(end, len(shard.places) - 1)]
        top = np.where(shard.impacts[one] >= shard.impacts[other], one, other)
        bound = np.where(some, shard.impacts[top], 0).sum(1)
        out = Intervals(low, high, left, right, np.where(some, top, -1), bound)
        return out.only(bound > 0)

    def impacts(self, shard: Shard) -> np.ndarray:
        return np.where(self.top >= 0, shard.impacts[self.top], -1)

    def only(self, which: np.ndarray) -> Intervals:
        return Intervals(*[column[which] for column in self._columns()])

    def joined(self, more: Intervals) -> Intervals:
        return Intervals(*[np.concatenate(both) for both in zip(self._columns(), more._columns())])

    def _columns(self) -> tuple:
        return self.low, self.high, self.left, self.right, self.top, self.bound


def maxima(impacts: np.ndarray, longest: int) -> np.ndarray:
    """The sparse table for ranges of at most ``longest`` postings."""
    size = len(impacts)
    levels = np.empty((max(1, int(longest).bit_length()), size), np.int32)
    levels[0] = np.arange(size)
    for level in range(1, len(levels)):
        step = 1 << (level - 1)
        below = levels[level - 1]
        levels[level] = below
        if step < size:
            one, other = below[:-step], below[step:]
            levels[level, : size - step] = np.where(impacts[one] >= impacts[other], one, other)
    return levels


def norms(n: np.ndarray, block: Block) -> np.ndarray:
    """100 - 50 + (50 n N) div L of each document."""
    if len(n) and int(n.max()) * 50 * block.documents >= 1 << 63:
        return np.array([50 + 50 * int(x) * block.documents // block.length for x in n], np.int64)
    return 50 + 50 * n * block.documents // max(block.length, 1)
