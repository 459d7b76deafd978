"""Remove long repeated strings with run-length compressed Burrows-Wheeler indexes.

A byte goes if it is covered by a string of ``LENGTH`` bytes that also starts anywhere else, in the same
document or another. No single index of a large corpus fits a task, so the strings are dealt out so
that equal ones meet: the anchor of a window of ``LENGTH`` bytes is the leftmost of its 32-byte
seeds with the least hash, which depends on nothing but the window. All windows of a document with one
anchor form a context. Equal windows lie in contexts with the same seed.

1. Contexts are listed as (seed, hash of the context, document, first and last window), and counted by both
   hashes with partial sums in each task. A context that occurs twice is repeated as a whole;
   its copies are one string of the index, which so does not grow with their number.
2. Seeds with several different contexts need the index: one string per context is cut out of its
   document, and each bucket of seeds gets an index of its own. It is a Burrows-Wheeler transform,
   compressed to its runs. The suffixes at run starts and run ends are sampled, and the length of their match
   with the suffix before and after is taken there alone. The matching statistics of all other places follow in
   text order: inside a run the match is that of the place before, less one.
3. Places whose longest match reaches ``LENGTH`` start a repeated window. The spans of all windows go back to
   their documents, and are united and cut out there.

A seed with more contexts than ``INDEXED`` (a passage that very many documents share, each followed by
something else) would make a large index. Its windows are counted as rows instead, which Spark
splits over tasks; the result is the same.

Defined results: a null text is empty. A text shorter than ``LENGTH`` stays as it is. Repeated rows are
documents of their own, so both lose what they share. Order of rows does not matter. Ids may repeat or be
null. Columns that are not named do not matter; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitlake.llm.arrow import map_batches, map_groups, pieces
from visitlake.llm.textbytes import BYTE_VALUES, Texts, prefix_hashes, span_hashes, texts_of
from visitlake.scratch import release, via_table

LENGTH = 400
SEED = 32
#: A seed with more contexts is counted as rows.
INDEXED = 4000
#: Bytes of a bucket's index, about.
BUCKET_BYTES = 1 << 20
PLACE_BITS = 28
SEPARATOR = 0xFF  # never part of UTF-8

REF = ["id", "print"]


def _keyed(docs: DataFrame, key: str, text: str, keep: Sequence[str]) -> DataFrame:
    """Rows (id, print, text). Rows that agree in id and print have the same text, so what holds for one
    holds for the other."""
    return docs.select(
        F.coalesce(F.col(key).cast("long"), F.lit(-(2**63))).alias("id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        *[F.col(name).alias(f"__{name}") for name in keep],
    ).withColumn("print", F.xxhash64("text"))


def contexts_of(texts: Texts, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(document, seed hash, context hash, first window, last window) of every context; windows are
    places in their own text."""
    data, starts = texts.data, texts.starts
    prefix = prefix_hashes(BYTE_VALUES[data])
    sizes = np.diff(starts)
    long_enough = np.flatnonzero(sizes >= length)
    if not len(long_enough):
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    width = length - SEED + 1
    seeds = len(data) - SEED + 1
    at = np.arange(seeds)
    hashes = span_hashes(prefix, at, at + SEED)
    low = np.uint64((1 << PLACE_BITS) - 1)
    ranked = (hashes & ~low) | at.astype(np.uint64)
    # Least value of each run of `width` seeds, from running minima in blocks of that width.
    padded = np.full(-(-seeds // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:seeds] = ranked
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = len(data) - length + 1
    least = np.minimum(behind[:windows], ahead[width - 1 : width - 1 + windows])
    anchor = (least & low).astype(np.int64)
    owner = np.repeat(long_enough, sizes[long_enough] - length + 1)
    base = np.cumsum(sizes[long_enough] - length + 1) - (sizes[long_enough] - length + 1)
    window = np.arange(len(owner)) - np.repeat(base - starts[long_enough], sizes[long_enough] - length + 1)
    anchor = anchor[window]
    new = np.ones(len(owner), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(new)) - 1
    begin, end, doc = window[first], window[last], owner[first]
    return (
        doc,
        hashes[anchor[first]].view(np.int64),
        span_hashes(prefix, begin, end + length).view(np.int64),
        begin - starts[doc],
        end - starts[doc],
    )


def _context_rows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1):
            found = contexts_of(texts_of(batch.column("text")), length)
            doc, seed, context, first, last, here = _once_per_text(*found, length)
            place, known = pa.array(doc, pa.int64()), here > 0
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(place),
                    batch.column("print").take(place),
                    pa.array(seed, pa.int64(), mask=~known),
                    pa.array(context, pa.int64(), mask=~known),
                    pa.array(first.astype(np.int64)),
                    pa.array(last.astype(np.int64)),
                    pa.array(here),
                ],
                names=[*REF, "seed", "context", "first", "last", "here"],
            )

    return run


def _once_per_text(doc, seed, context, first, last, length: int) -> tuple[np.ndarray, ...]:
    """One row per text and context with its number of places in the text (``here``).

    The places of a context that a text holds several times are repeated as they stand; they are united
    into few rows with ``here`` 0, so a text that repeats a short line does not give a row per line.
    """
    order = np.lexsort((first, context, seed, doc))
    new = np.ones(len(order), bool)
    same = [np.diff(column[order]) == 0 for column in (doc, seed, context)]
    new[1:] = ~(same[0] & same[1] & same[2])
    group = np.cumsum(new) - 1
    counts = np.bincount(group) if len(order) else np.zeros(0, np.int64)
    one = order[new]
    several = np.sort(order[counts[group] > 1])  # places are in the order of the texts
    begin, end, owner = first[several], last[several], doc[several]
    apart = np.ones(len(several), bool)
    apart[1:] = (owner[1:] != owner[:-1]) | (begin[1:] > end[:-1] + length)
    starts = np.flatnonzero(apart)
    ends = np.append(starts[1:], len(several))[: len(starts)] - 1
    none = np.zeros(len(starts), np.int64)
    return (
        np.concatenate((doc[one], owner[starts])),
        np.concatenate((seed[one], none)),
        np.concatenate((context[one], none)),
        np.concatenate((first[one], begin[starts])),
        np.concatenate((last[one], end[ends])),
        np.concatenate((counts, none)).astype(np.int64),
    )


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Rows (id, print, spans): the spans (start, end) of repeated windows; they may overlap."""
    listed = map_batches(
        docs.select("id", "text", "print").where(F.octet_length("text") >= length),
        _context_rows(length),
        "id long, print long, seed long, context long, first long, last long, here long",
    )
    listed = via_table(listed, "dedup-contexts")
    contexts = listed.where(F.col("seed").isNotNull())
    counted = contexts.groupBy("seed", "context").agg(F.sum("here").alias("copies"))
    shared = (
        counted.groupBy("seed")
        .agg(F.count("*").alias("contexts"), F.sum("copies").alias("places"))
        .where(F.col("places") > 1)
        .select(F.col("seed").alias("shared_seed"), "contexts")
    )
    # First the counted rows, so that no join meets all rows of a common seed at once.
    counts = via_table(
        counted.join(shared, F.col("seed") == F.col("shared_seed")).drop("shared_seed"), "dedup-counts"
    )
    met = via_table(contexts.drop("here").join(counts, ["seed", "context"]), "dedup-met")
    release(counts)
    whole = met.where(F.col("copies") > 1).select(
        *REF, F.col("first").alias("start"), (F.col("last") + length).alias("end")
    )
    differing = _cut_out(docs, met.where(F.col("contexts") > 1), length)
    within = listed.where(F.col("seed").isNull()).select(
        *REF, F.col("first").alias("start"), (F.col("last") + length).alias("end")
    )
    spans = within.unionByName(whole).unionByName(_by_index(differing, length))
    spans = spans.unionByName(_by_rows(differing, length))
    united = spans.groupBy(*REF).agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    united = via_table(united, "dedup-spans")
    release(listed, met, differing)
    return united


def _cut_out(docs: DataFrame, met: DataFrame, length: int) -> DataFrame:
    """Rows (id, print, seed, contexts, copies, first, string): one string per context."""
    wanted = (
        met.groupBy("seed", "context")
        .agg(F.min(F.struct(*REF, "first", "last", "contexts", "copies")).alias("x"))
        .select("seed", "x.*")
        .groupBy(*REF)
        .agg(F.collect_list(F.struct("seed", "first", "last", "contexts", "copies")).alias("wanted"))
    )
    one_each = docs.join(wanted, REF)
    data = F.col("text").cast("binary")
    strings = F.transform(
        "wanted",
        lambda x: F.struct(
            x["seed"].alias("seed"),
            x["contexts"].alias("contexts"),
            x["copies"].alias("copies"),
            x["first"].alias("first"),
            F.substring(data, x["first"].cast("int") + 1, (x["last"] - x["first"]).cast("int") + length).alias("string"),
        ),
    )
    cut = one_each.select(*REF, F.explode(strings).alias("x")).select(*REF, "x.*")
    # A document that occurs twice with its id is cut twice; one string is enough.
    return via_table(cut.dropDuplicates(["seed", "string"]), "dedup-strings")


def _by_index(strings: DataFrame, length: int) -> DataFrame:
    """Spans of the contexts that occur once, by the index of their bucket of seeds."""
    some = strings.where(F.col("contexts") <= INDEXED)
    total = some.agg(F.sum(F.octet_length("string"))).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_BYTES))
    dealt = some.withColumn("bucket", F.pmod(F.xxhash64("seed"), F.lit(buckets)))
    return map_groups(
        dealt, ["bucket"], lambda table: _index_spans(table, length), "id long, print long, start long, end long"
    )


def _index_spans(table: pa.Table, length: int) -> pa.Table:
    strings = table["string"].to_pylist()
    repeated = RunLengthIndex(strings).repeated_starts(length)
    once = table["copies"].to_numpy() == 1
    first = table["first"].to_numpy()
    row, start, end = [], [], []
    for i in np.flatnonzero(once):
        begins, ends = _runs(repeated[i])
        row += [i] * len(begins)
        start += (first[i] + begins).tolist()
        end += (first[i] + ends - 1 + length).tolist()
    taken = table.select(REF).take(pa.array(row, pa.int64()))
    return pa.table([*taken.columns, pa.array(start, pa.int64()), pa.array(end, pa.int64())], names=[*REF, "start", "end"])


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each run of true flags."""
    edges = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


class RunLengthIndex:
    """Runs of the Burrows-Wheeler transform of some strings, with the suffixes at run ends."""

    def __init__(self, strings: list[bytes]):
        sizes = np.array([len(string) for string in strings], np.int64)
        self.starts = np.concatenate(([0], np.cumsum(sizes + 1)))
        self.sizes = sizes
        separator = bytes([SEPARATOR])
        self.text = np.frombuffer(separator.join(strings) + separator, np.uint8)
        order = self._suffix_order(int(sizes.max(initial=0)) + 1)
        transform = self.text[order - 1]
        head = np.ones(len(order), bool)
        head[1:] = transform[1:] != transform[:-1]
        # No place comes before the text's first, so its suffix is a run of its own.
        first = int(np.flatnonzero(order == 0)[0])
        head[first : first + 2] = True
        heads = np.flatnonzero(head)
        tails = np.append(heads[1:], len(order)) - 1
        self.symbols = transform[heads]
        # At a run start the suffix before, and at a run end the suffix after, belong to another run.
        self.head_places, self.head_before = order[heads[1:]], order[heads[1:] - 1]
        self.tail_places, self.tail_after = order[tails[:-1]], order[tails[:-1] + 1]
        self.first_place, self.last_place = order[0], order[-1]

    def _suffix_order(self, longest: int) -> np.ndarray:
        """Suffix array by prefix doubling. Ranks of each length stay for comparing suffixes."""
        n = len(self.text)
        padded = np.concatenate((self.text, np.zeros(8, np.uint8))).astype(np.uint64)
        key = np.zeros(n, np.uint64)
        for i in range(8):
            key = (key << np.uint64(8)) | padded[i : i + n]
        self.levels: list[tuple[int, np.ndarray]] = []
        width = 8
        while True:
            order = np.argsort(key)
            ordered = key[order]
            step = np.zeros(n, np.int64)
            step[1:] = ordered[1:] != ordered[:-1]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(step) + 1
            self.levels.append((width, rank.astype(np.int32)))
            if rank.max(initial=0) == n or width > 2 * longest:
                return order
            further = np.zeros(n, np.int64)
            further[: max(n - width, 0)] = rank[width:]
            key = rank.astype(np.uint64) * np.uint64(n + 1) + further.astype(np.uint64)
            width *= 2

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of suffixes, taken at samples only."""
        n, done = len(self.text), np.zeros(len(a), np.int64)
        a, b = a.copy(), b.copy()
        for width, rank in reversed(self.levels):
            inside = (a < n) & (b < n)
            same = np.zeros(len(a), bool)
            same[inside] = rank[a[inside]] == rank[b[inside]]
            done[same] += width
            a[same] += width
            b[same] += width
        going = np.ones(len(a), bool)
        for _ in range(8):
            inside = going & (a < n) & (b < n)
            going = np.zeros(len(a), bool)
            going[inside] = self.text[a[inside]] == self.text[b[inside]]
            done[going] += 1
            a[going] += 1
            b[going] += 1
        return done

    def _stream(self, places: np.ndarray, lengths: np.ndarray, without: int) -> np.ndarray:
        """Match lengths in text order: a sample's own, else one less than at the place before."""
        n = len(self.text)
        sampled = np.zeros(n, bool)
        value = np.zeros(n, np.int64)
        sampled[places], value[places] = True, lengths
        sampled[without], value[without] = True, 0
        sampled[0] = True
        last = np.maximum.accumulate(np.where(sampled, np.arange(n), 0))
        return np.maximum(value[last] - (np.arange(n) - last), 0)

    def repeated_starts(self, length: int) -> list[np.ndarray]:
        """For each string, whether a window that starts at each of its places occurs elsewhere."""
        before = self._stream(
            self.head_places, self._common(self.head_places, self.head_before), self.first_place
        )
        after = self._stream(
            self.tail_places, self._common(self.tail_places, self.tail_after), self.last_place
        )
        repeated = np.maximum(before, after) >= length
        return [
            repeated[start : start + max(size - length + 1, 0)]
            for start, size in zip(self.starts[:-1], self.sizes)
        ]


def _by_rows(strings: DataFrame, length: int) -> DataFrame:
    """Spans of the contexts of very common seeds: their windows counted as rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            texts = texts_of(batch.column("string"))
            prefix = prefix_hashes(BYTE_VALUES[texts.data])
            counts = np.maximum(np.diff(texts.starts) - length + 1, 0)
            row = np.repeat(np.arange(len(texts)), counts)
            offset = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            begin = texts.starts[row] + offset
            place = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(place),
                    batch.column("print").take(place),
                    batch.column("copies").take(place),
                    pa.array(batch.column("first").to_numpy()[row] + offset),
                    pa.array(span_hashes(prefix, begin, begin + length).view(np.int64)),
                ],
                names=[*REF, "copies", "start", "window"],
            )

    common = strings.where(F.col("contexts") > INDEXED)
    windows = map_batches(common, run, "id long, print long, copies long, start long, window long")
    repeated = (
        windows.groupBy("window").agg(F.count("*").alias("n")).where(F.col("n") > 1)
        .select(F.col("window").alias("w"))
    )
    return (
        windows.where(F.col("copies") == 1)
        .join(repeated, F.col("window") == F.col("w"))
        .select(*REF, "start", (F.col("start") + length).alias("end"))
    )


def remove_repeats(
    docs: DataFrame, key: str, text: str, length: int = LENGTH, keep: Sequence[str] = (), as_text: bool = False
) -> DataFrame:
    """Rows (key, n_bytes, n_removed, n_spans, kept) for every row, and the columns in ``keep``.

    ``kept`` is binary; with ``as_text`` it is a string, without the bytes of characters that were cut.
    """
    keyed = _keyed(docs, key, text, keep)
    spans = repeated_spans(keyed.select(*REF, "text"), length)
    joined = keyed.join(spans, REF, "left").select(
        F.nullif("id", F.lit(-(2**63))).alias("key"),
        F.transform("spans", lambda x: x["start"]).alias("begins"),
        F.transform("spans", lambda x: x["end"]).alias("ends"),
        F.col("text").cast("binary").alias("data"),
        *[F.col(f"__{name}").alias(f"__{name}") for name in keep],
    )
    kinds = {f.name: f.dataType for f in joined.schema.fields}
    schema = T.StructType(
        [
            *[T.StructField(n, T.LongType()) for n in ("key", "n_bytes", "n_removed", "n_spans")],
            T.StructField("kept", T.StringType() if as_text else T.BinaryType()),
            *[T.StructField(name, kinds[f"__{name}"]) for name in keep],
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, list(kinds).index("data")):
            rows = [
                cut(*row)
                for row in zip(*(batch.column(c).to_pylist() for c in ("data", "begins", "ends")))
            ]
            kept, removed, spans = zip(*rows)
            total = [len(k) + r for k, r in zip(kept, removed)]
            out = [k.decode("utf-8", "ignore") for k in kept] if as_text else kept
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    pa.array(total, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(spans, pa.int64()),
                    pa.array(out, pa.string() if as_text else pa.binary()),
                    *[batch.column(f"__{name}") for name in keep],
                ],
                names=schema.names,
            )

    return map_batches(joined, run, schema)


def cut(data: bytes, begins: list[int] | None, ends: list[int] | None) -> tuple[bytes, int, int]:
    """What is left of ``data``, the number of bytes removed and of maximal removed runs."""
    if not begins:
        return data, 0, 0
    kept, at, runs, removed = [], -1, 0, 0
    for begin, end in sorted(zip(begins, ends)):
        if begin > at:
            kept.append(data[max(at, 0) : begin])
            runs += 1
            removed += end - begin
        elif end > at:
            removed += end - at
        at = max(at, end)
    kept.append(data[at:])
    return b"".join(kept), removed, runs

