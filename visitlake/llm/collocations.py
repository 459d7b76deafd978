"""Phrase collocations: n-grams counted in tiles of frequency-ranked ids, extended word by word.

The frequent words of each language get ids by falling frequency. A pair of ids is a cell of a square
table cut into tiles: a task counts a tile that many of its pairs fall into with a dense ``bincount``, and the others as
sorted lists of cells. Frequent pairs are ranked again by their own frequency, and a pair's
id with the id of the next word is a cell of the next table; so phrases grow to ``LONGEST`` words. A phrase can
only be frequent if both phrases of one word less in it are, so few places are left to count.

How it is distributed: each length is one pass over the texts, in which a task keeps the words of
``CHUNK`` tokens; its counts are summed by cell, so a frequent phrase sends a row per chunk. Only
``HEAD`` phrases of each length have ids, the most frequent ones of at most ``HEAD_BYTES`` bytes; they are sent
to all tasks and have a size bound. Every other frequent phrase is counted under its own text, and a bit field of
bounded size tells the tasks which of those may be frequent: beyond its bound more is counted, never less. Inside a
chunk phrases meet by a 64-bit hash and are told apart by a second one.

Defined results: null texts are empty; a null language is ``und``, like that name itself. Repeated rows count
as often as they occur. A word is any run between separators, as long as it may be. Equal scores are in order of
count and phrase. Columns that are not named do not matter; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from visitlake.llm.arrow import map_batches, pieces
from visitlake.llm.textbytes import (
    BYTE_VALUES,
    LOWER,
    LOWER_VALUES,
    OTHER_LOWER_VALUES,
    mixed,
    owners,
    prefix_hashes,
    span_hashes,
    texts_of,
    word_spans,
)
from visitlake.scratch import via_table

#: What ends a piece, and what ends a word besides.
PIECE_ENDS = np.isin(np.arange(256), [*b".,;:!?", *range(0x0A, 0x0E)])
WORD_ENDS = PIECE_ENDS | np.isin(np.arange(256), [0x20, 0x09])

LONGEST = 4
#: Phrases of each length that have ids, and the bytes that such a phrase may have.
HEAD = 1 << 18
HEAD_BYTES = 64
#: Words that a task holds at a time.
CHUNK = 1 << 19
#: Side of a tile, and the pairs from which on it is counted densely.
TILE = 1 << 10
DENSE = TILE * TILE // 32
#: Places of the table that turns away most phrases without ids at once.
SIEVE = 1 << 22
#: Most bits of the field of frequent phrases without ids.
FIELD_BITS = 1 << 26

U = np.uint64
_NEXT = U(0xA24BAED4963EE407)


def frequent_phrases(
    documents: DataFrame, lang: str, text: str, least: int, head: int = HEAD
) -> tuple[DataFrame, DataFrame]:
    """Rows (lang, phrase, size, f) of all phrases of 1 to ``LONGEST`` words that occur ``least`` times, and
    rows (lang, n) with the number of words of each language."""
    spark = documents.sparkSession
    source = documents.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("string").alias("text")
    )
    words = via_table(_counted(source, 1, None, None), "words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    levels = [words.where(F.col("f") >= least).select("lang", "phrase", "f")]
    known = right = Known.of(levels[0], 1, head)
    names = right_names = known.names(spark)
    for size in range(2, LONGEST + 1):
        counted = _counted(source, size, known, right).where(F.col("f") >= least)
        counted = via_table(counted, "phrases")
        first = names.select(F.col("id").alias("left_id"), "lang", F.col("phrase").alias("first"))
        last = right_names.select(F.col("id").alias("right_id"), F.col("phrase").alias("last"))
        named = (
            counted.where("cell is not null")
            .select("f", F.shiftright("cell", 32).alias("left_id"), F.col("cell").bitwiseAND(0xFFFFFFFF).alias("right_id"))
            .join(first, "left_id")
            .join(last, "right_id")
            .select("lang", F.concat_ws(" ", "first", "last").alias("phrase"), "f")
        )
        spelled = counted.where("cell is null").select("lang", "phrase", "f")
        levels.append(via_table(named.unionByName(spelled), "frequent"))
        if size < LONGEST:
            known = Known.of(levels[-1], size, head)
            names = known.names(spark)
    sized = [level.withColumn("size", F.lit(size)) for size, level in enumerate(levels, 1)]
    return reduce(DataFrame.unionByName, sized).select("lang", "phrase", "size", "f"), totals


def collocations(
    documents: DataFrame, lang: str, text: str, least: int = 30, per_lang: int = 2000, head: int = HEAD
) -> DataFrame:
    """Rows (lang, rank, phrase, a, l, r, n, score): the first phrases of each language.

    ``a`` counts the phrase, ``l`` and ``r`` the parts of its lowest-scoring cut; the score is
    floor(2,000,000 a / (l + r)). A phrase within a longer one that has at least 80 % of its count is left out.
    """
    phrases, totals = frequent_phrases(documents, lang, text, least, head)
    phrases = via_table(phrases, "all-phrases")
    candidates = phrases.where("size > 1").withColumnRenamed("f", "a")
    return _ranked(_not_within(_cut(candidates, phrases), candidates), per_lang).join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )


def _cut(candidates: DataFrame, phrases: DataFrame) -> DataFrame:
    """Candidates with the lowest-scoring of their cuts; of equal ones that after the fewest words."""
    cuts = candidates.withColumn("k", F.explode(F.expr("sequence(1, size - 1)"))).withColumns(
        {
            "first": F.expr("substring_index(phrase, ' ', k)"),
            "rest": F.expr("substring_index(phrase, ' ', k - size)"),
        }
    )
    firsts = phrases.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    rests = phrases.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    scored = cuts.join(firsts, ["lang", "first"]).join(rests, ["lang", "rest"])
    # Decimals hold these products whole; div of decimals is exact.
    score = F.expr(
        "(cast(2000000 as decimal(7, 0)) * cast(a as decimal(19, 0)))"
        " div (cast(l as decimal(19, 0)) + cast(r as decimal(19, 0)))"
    )
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("lowest")
    return scored.groupBy("lang", "phrase", "a").agg(lowest).select("lang", "phrase", "a", "lowest.*")


def _not_within(scored: DataFrame, candidates: DataFrame) -> DataFrame:
    """Without those that stand in a longer candidate nearly as often as at all."""
    inside = candidates.where("size > 2").select(
        "lang",
        F.col("a").alias("longer"),
        F.expr(
            "explode(flatten(transform(sequence(2, size - 1), m -> transform(sequence(1, size - m + 1),"
            " i -> array_join(slice(split(phrase, ' '), i, m), ' ')))))"
        ).alias("phrase"),
    )
    most = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    within = F.expr(
        "cast(100 as decimal(3, 0)) * cast(longer as decimal(19, 0)) >= cast(80 as decimal(3, 0)) * cast(a as decimal(19, 0))"
    )
    joined = scored.join(most, ["lang", "phrase"], "left")
    return joined.where(~F.coalesce(within, F.lit(False))).drop("longer")


def _ranked(scored: DataFrame, per_lang: int) -> DataFrame:
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    return scored.withColumn("rank", rank).where(F.col("rank") <= per_lang)


# --- what tasks know of frequent phrases -------------------------------------------------------


@dataclass
class Known:
    """Frequent phrases of one length: those with ids by hash, and a bit field of the others."""

    frame: pa.Table
    hashes: np.ndarray
    others: np.ndarray
    ids: np.ndarray
    field: np.ndarray

    @staticmethod
    def of(frequent: DataFrame, size: int, head: int) -> Known:
        """``frequent`` has rows (lang, phrase, f)."""
        short = F.octet_length("phrase") + F.octet_length("lang") <= HEAD_BYTES
        first = frequent.where(short).orderBy(F.desc("f"), "lang", "phrase").limit(head)
        frame = first.select("lang", "phrase", "f").toArrow().combine_chunks()
        frame = frame.append_column("id", pa.array(_ids(frame)))
        hashes, others = phrase_hashes(frame["lang"], frame["phrase"], size)
        field = _field(frequent, frame, short, size, head)
        known, first = np.unique(hashes, return_index=True)
        if len(known) < len(hashes):  # of one hash, only the first phrase has an id
            field = _with_bits(field, np.delete(hashes, first))
        return Known(frame, known, others[first], frame["id"].to_numpy()[first], field)

    def names(self, spark: SparkSession) -> DataFrame:
        return via_table(spark.createDataFrame(self.frame.select(["id", "lang", "phrase"])), "phrase-ids")

    def sent(self) -> tuple:
        sieve = np.zeros(SIEVE, bool)
        sieve[(self.hashes & U(SIEVE - 1)).view(np.int64)] = True
        return self.hashes, self.others, self.ids, self.field, sieve


def _ids(frame: pa.Table) -> np.ndarray:
    """Rank in the own language; a language's ids begin with a tile of their own."""
    codes = pc.fill_null(frame["lang"].combine_chunks().dictionary_encode().indices, 0).to_numpy().astype(np.int64)
    order = np.argsort(codes, kind="stable")
    counts = np.bincount(codes, minlength=1)
    rank = np.empty(len(codes), np.int64)
    rank[order] = np.arange(len(codes)) - np.repeat(np.concatenate(([0], np.cumsum(counts)[:-1])), counts)
    tiles = -(-counts // TILE)
    return rank + (np.concatenate(([0], np.cumsum(tiles)[:-1])) * TILE)[codes]


def _field(frequent: DataFrame, frame: pa.Table, short, size: int, head: int) -> np.ndarray:
    """Bits of the frequent phrases that have no id, found by the tasks; at most ``FIELD_BITS``."""
    spark = frequent.sparkSession
    if len(frame) < head:
        rest = frequent.where(~short)
    else:
        last = {name: frame[name][len(frame) - 1].as_py() for name in ("f", "lang", "phrase")}
        after = (F.col("f") < last["f"]) | (
            (F.col("f") == last["f"])
            & ((F.col("lang") > last["lang"]) | ((F.col("lang") == last["lang"]) & (F.col("phrase") > last["phrase"])))
        )
        rest = frequent.where(~short | after)
    count = rest.count()
    if not count:
        return np.zeros(0, np.uint64)
    bits = min(FIELD_BITS, 1 << max(10, (16 * count).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = phrase_hashes(batch.column("lang"), batch.column("phrase"), size)[0] & U(bits - 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array((at >> U(6)).astype(np.int64)), pa.array((U(1) << (at & U(63))).view(np.int64))],
                names=["word", "bit"],
            )

    words = map_batches(rest.select("lang", "phrase"), run, "word long, bit long")
    words = words.groupBy("word").agg(F.expr("bit_or(bit)").alias("bits")).toArrow()
    field = np.zeros(bits // 64, np.uint64)
    field[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return field


def _with_bits(field: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    field = field.copy() if len(field) else np.zeros(16, np.uint64)
    at = hashes & U(len(field) * 64 - 1)
    np.bitwise_or.at(field, (at >> U(6)).astype(np.int64), U(1) << (at & U(63)))
    return field


def _look_up(sent: tuple, words: list[np.ndarray], size: int, at: np.ndarray | None = None) -> np.ndarray:
    """The id of the phrase of ``size`` words at each word, or at those in ``at``; -2 for one that may be
    frequent, -1 for others."""
    known, known_others, ids, field, sieve = sent
    hashes = _joined_hashes(words[0], size) if at is None else _joined_at(words[0], size, at)
    found = np.full(len(hashes), -1, np.int64)
    if len(field):
        bit = hashes & U(len(field) * 64 - 1)
        found[(field[(bit >> U(6)).astype(np.int64)] >> (bit & U(63))) & U(1) == 1] = -2
    may = np.flatnonzero(sieve[(hashes & U(len(sieve) - 1)).view(np.int64)])
    if len(may):
        place = np.minimum(np.searchsorted(known, hashes[may]), len(known) - 1)
        same = known[place] == hashes[may]
        may, place = may[same], place[same]
        same = known_others[place] == _joined_at(words[1], size, may if at is None else at[may])
        found[may[same]] = ids[place[same]]
    return found


# --- hashes -------------------------------------------------------------------------------------


def _lang_hashes(langs: pa.Array) -> np.ndarray:
    """Unlike the hash of a word of the same letters, so that the two can be added."""
    texts = texts_of(langs)
    hashes = span_hashes(prefix_hashes(BYTE_VALUES[texts.data]), texts.starts[:-1], texts.starts[1:])
    return mixed(hashes * _NEXT + U(1))


def _word_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, salt: np.ndarray) -> list[np.ndarray]:
    """Two hashes of each word and its language."""
    return [
        mixed(span_hashes(prefix_hashes(values[data]), begins, ends) + salt)
        for values in (LOWER_VALUES, OTHER_LOWER_VALUES)
    ]


def _joined_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of the phrase of ``size`` words that starts at each word, as far as there are so many."""
    out = words
    for step in range(1, size):
        out = mixed(out[:-1] * _NEXT + words[step:])
    return out


def _joined_at(words: np.ndarray, size: int, at: np.ndarray) -> np.ndarray:
    """The same for the phrases that start at some of the words."""
    out = words[at]
    for step in range(1, size):
        out = mixed(out * _NEXT + words[at + step])
    return out


def phrase_hashes(langs, phrases, size: int) -> list[np.ndarray]:
    """Two hashes of each phrase of ``size`` words with single blanks between them, and its language."""
    langs, phrases = (x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in (langs, phrases))
    texts = texts_of(phrases)
    begins, ends, first = word_spans(texts, np.arange(256) == 0x20)
    salt = _lang_hashes(langs)[owners(first)]
    return [_joined_at(words, size, first[:-1]) for words in _word_hashes(texts.data, begins, ends, salt)]


# --- counting in tasks ----------------------------------------------------------------------------


def _counted(source: DataFrame, size: int, known: Known | None, right: Known | None) -> DataFrame:
    """Rows (cell, lang, phrase, f): how often each phrase of ``size`` words occurs that may be frequent. A cell
    is the id of all but its last word and the id of that; without both, language and phrase are spelled."""
    tables = (known.sent(), right.sent()) if size > 1 else None
    sent = source.sparkSession.sparkContext.broadcast(tables)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = Chunk()
        for batch in pieces(batches):
            chunk.add(batch)
            if chunk.words >= CHUNK:
                yield from chunk.counts(size, sent.value)
                chunk = Chunk()
        if chunk.words:
            yield from chunk.counts(size, sent.value)

    counted = map_batches(source, run, "cell long, lang string, phrase string, f long")
    return counted.groupBy("cell", "lang", "phrase").agg(F.sum("f").alias("f"))


class Chunk:
    """Words of some texts, one after the other."""

    def __init__(self) -> None:
        self.langs: dict[str, int] = {}
        self.parts: list[tuple] = []
        self.words = self.bytes = self.runs = 0

    def add(self, batch: pa.RecordBatch) -> None:
        texts = texts_of(batch.column("text"))
        begins, ends, first = word_spans(texts, WORD_ENDS)
        langs = batch.column("lang").dictionary_encode()
        codes = np.array([self.langs.setdefault(name, len(self.langs)) for name in langs.dictionary.to_pylist()], np.int64)
        owner = owners(first)
        of_text = langs.indices.to_numpy()[owner] if len(langs) else owner
        salt = _lang_hashes(langs.dictionary)[of_text] if len(of_text) else np.zeros(0, U)
        hashes = _word_hashes(texts.data, begins, ends, salt)
        # Words of one piece of one text have the same run.
        run = np.cumsum(PIECE_ENDS[texts.data])[begins] + owner + self.runs
        lang = codes[of_text] if len(of_text) else of_text
        self.parts.append((*hashes, run, lang, begins + self.bytes, ends + self.bytes, texts.data))
        self.words += len(begins)
        self.bytes += len(texts.data)
        self.runs += len(texts.data) + len(texts) + 1

    def counts(self, size: int, tables: tuple | None) -> Iterator[pa.RecordBatch]:
        columns, self.parts = list(zip(*self.parts)), []
        h, other, run, lang, begins, ends, data = (np.concatenate(columns.pop(0)) for _ in range(7))
        at = np.flatnonzero(run[size - 1 :] == run[: len(run) - size + 1]) if len(run) >= size else np.zeros(0, np.int64)
        if size > 1:
            known, right = tables
            lower = _look_up(known, [h, other], size - 1)
            at = at[(lower[at] != -1) & (lower[at + 1] != -1)]
            last = lower[at + 1] if size == 2 else _look_up(right, [h, other], 1, at + size - 1)
            has_ids = (lower[at] >= 0) & (last >= 0)
            yield from _cells(*tile_counts(lower[at[has_ids]], last[has_ids]))
            at = at[~has_ids]
        if len(at):
            yield from self._spelled(at, size, [h, other], lang, begins, ends, data)

    def _spelled(self, at, size, words, lang, begins, ends, data) -> Iterator[pa.RecordBatch]:
        hashes, others = (_joined_at(x, size, at) for x in words)
        _, first, group, times = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
        if (others != others[first][group]).any():  # one hash, two phrases
            both = np.rec.fromarrays([hashes, others])
            _, first, times = np.unique(both, return_index=True, return_counts=True)
        first = at[first]
        names = list(self.langs)
        lowered = LOWER[data]
        for start in range(0, len(first), 50_000):
            some = first[start : start + 50_000]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.nulls(len(some), pa.int64()),
                    pa.array([names[code] for code in lang[some]], pa.string()),
                    _texts(lowered, [(begins[some + step], ends[some + step]) for step in range(size)]),
                    pa.array(times[start : start + 50_000].astype(np.int64)),
                ],
                names=["cell", "lang", "phrase", "f"],
            )


def _texts(data: np.ndarray, words: list[tuple[np.ndarray, np.ndarray]]) -> pa.Array:
    """Phrases of words given by where they begin and end, with a blank between them."""
    columns = []
    for begins, ends in words:
        lengths = ends - begins
        offsets = np.concatenate(([0], np.cumsum(lengths)))
        at = np.repeat(begins - offsets[:-1], lengths) + np.arange(offsets[-1])
        buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[at].tobytes())]
        columns.append(pa.Array.from_buffers(pa.large_string(), len(lengths), buffers).cast(pa.string()))
    return columns[0] if len(columns) == 1 else pc.binary_join_element_wise(*columns, " ")


def tile_counts(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells ``left << 32 | right`` that occur, and how often, tile by tile."""
    if not len(left):
        return left, left
    tile = (left // TILE << 31) | right // TILE
    inner = (left % TILE * TILE + right % TILE).astype(np.int64)
    order = np.argsort(tile, kind="stable")
    tile, inner = tile[order], inner[order]
    starts = np.flatnonzero(np.concatenate(([True], tile[1:] != tile[:-1])))
    sizes = np.diff(np.concatenate((starts, [len(tile)])))
    cells, counts = [], []
    for start, size in zip(starts[sizes >= DENSE], sizes[sizes >= DENSE]):
        dense = np.bincount(inner[start : start + size], minlength=TILE * TILE)
        found = np.flatnonzero(dense)
        cells.append(_cell(tile[start], found))
        counts.append(dense[found])
    sparse = np.repeat(sizes < DENSE, sizes)
    found, times = np.unique(_cell(tile[sparse], inner[sparse]), return_counts=True)
    return np.concatenate([*cells, found]), np.concatenate([*counts, times])


def _cell(tile: np.ndarray, inner: np.ndarray) -> np.ndarray:
    left = (tile >> 31) * TILE + inner // TILE
    return left << 32 | (tile & 0x7FFFFFFF) * TILE + inner % TILE


def _cells(cells: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    for start in range(0, len(cells), 200_000):
        some = cells[start : start + 200_000]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(some),
                pa.nulls(len(some), pa.string()),
                pa.nulls(len(some), pa.string()),
                pa.array(counts[start : start + 200_000].astype(np.int64)),
            ],
            names=["cell", "lang", "phrase", "f"],
        )
