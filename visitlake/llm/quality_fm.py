"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(b + sum_j w_j x_j + sum over pairs <v_i, v_j> x_i x_j). The pair term is computed in
linear time as half of (sum_j v_j x_j)^2 - sum_j (v_j x_j)^2 for each factor.

The model is fitted with Adagrad on at most about ``SAMPLE`` labelled rows, chosen by a hash of their
ids over all of them; every document is scored. Scoring is map-only: texts never move. The model has
a fixed size and is broadcast; the sample's ids are a bounded table, also broadcast.

Defined results: a null or empty text has no words and zero statistics, and gets a score; null
metadata counts as 0. Rows that repeat get equal scores. Documents with null ids are scored but never
learned from; of several labels of a document the least counts. Without any label the score is 0.5.
Columns that are not named do not matter; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitlake.llm.arrow import map_batches, pieces
from visitlake.llm.textbytes import (
    LOWER_VALUES,
    Texts,
    owners,
    prefix_hashes,
    span_hashes,
    sums,
    texts_of,
    word_spans,
)

BUCKETS = 1 << 16
FACTORS = 8
#: Labelled rows that the model is fitted on, about.
SAMPLE = 8000
EPOCHS = 6
BATCH = 64
RATE = 0.1
SHRINK = 1e-4
STATS = 16


@dataclass
class Model:
    bias: float
    linear: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    spread: np.ndarray


def _class(test) -> np.ndarray:
    return np.array([bool(test(byte)) for byte in range(256)])


IS_UPPER = _class(lambda b: 0x41 <= b <= 0x5A)
IS_LOWER = _class(lambda b: 0x61 <= b <= 0x7A)
IS_DIGIT = _class(lambda b: 0x30 <= b <= 0x39)
IS_BEYOND_ASCII = _class(lambda b: b >= 0x80)
IS_STOP = _class(lambda b: b in b".,;:")
IS_OTHER_MARK = _class(lambda b: 0x21 <= b <= 0x7E and not chr(b).isalnum() and b not in b".,;:'-")
IS_LINE_END = _class(lambda b: b == 0x0A)


def features(texts: Texts, metadata: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct word buckets, the place of each text's first one, and its statistics."""
    begins, ends, first = word_spans(texts)
    hashes = span_hashes(prefix_hashes(LOWER_VALUES[texts.data]), begins, ends)
    owner = owners(first)
    marked = np.unique((owner.astype(np.int64) << 16) | (hashes & np.uint64(BUCKETS - 1)).astype(np.int64))
    distinct_first = np.searchsorted(marked, np.arange(len(texts) + 1, dtype=np.int64) << 16)
    same_as_last = np.zeros(len(hashes), bool)
    same_as_last[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])

    size = np.diff(texts.starts).astype(float)
    words = np.diff(first).astype(float)
    per_byte = [
        sums(kind[texts.data], texts.starts) / np.maximum(size, 1)
        for kind in (IS_UPPER, IS_LOWER, IS_DIGIT, IS_BEYOND_ASCII, IS_STOP, IS_OTHER_MARK)
    ]
    lines = sums(IS_LINE_END[texts.data], texts.starts)
    last_byte = texts.data[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    first_byte = texts.data[begins] if len(begins) else np.zeros(0, np.uint8)
    per_word = [
        sums(value, first) / np.maximum(words, 1)
        for value in (
            (ends - begins).astype(float),
            same_as_last,
            IS_OTHER_MARK[last_byte],
            IS_UPPER[first_byte],
            (ends - begins) == 1,
        )
    ]
    distinct = np.diff(distinct_first)
    stats = np.column_stack(
        [
            np.log1p(size),
            np.log1p(words),
            *per_byte,
            lines / np.maximum(words, 1),
            *per_word,
            distinct / np.maximum(words, 1),
            np.log1p(np.maximum(metadata, 0)),
        ]
    )
    return marked & (BUCKETS - 1), distinct_first, stats


def raw_scores(
    model: Model, buckets: np.ndarray, first: np.ndarray, stats: np.ndarray
) -> np.ndarray:
    """The model's sum, before the sigmoid."""
    scaled = np.clip((stats - model.mean) / model.spread, -4, 4)
    weight = 1 / np.sqrt(np.maximum(np.diff(first), 1))
    linear, factors = model.linear, model.factors
    result = model.bias + sums(linear[buckets], first) * weight + scaled @ linear[BUCKETS:]
    summed = sums(factors[buckets], first) * weight[:, None] + scaled @ factors[BUCKETS:]
    squared = sums(factors[buckets] ** 2, first) * (weight**2)[:, None]
    squared += scaled**2 @ factors[BUCKETS:] ** 2
    return result + 0.5 * (summed**2 - squared).sum(1)


def fit(rows: list[tuple[np.ndarray, np.ndarray, float]], seed: int = 3) -> Model:
    """Logistic loss, Adagrad, small batches. A row is (buckets, statistics, label)."""
    random = np.random.default_rng(seed)
    size = BUCKETS + STATS
    model = Model(
        0.0,
        np.zeros(size, np.float32),
        random.normal(0, 0.02, (size, FACTORS)).astype(np.float32),
        np.zeros(STATS),
        np.ones(STATS),
    )
    if not rows:
        model.factors[:] = 0
        return model
    stats = np.array([row[1] for row in rows])
    labels = np.array([row[2] for row in rows], float)
    model.mean, model.spread = stats.mean(0), stats.std(0) + 1e-6
    scaled = np.clip((stats - model.mean) / model.spread, -4, 4)
    seen = np.full(size, 1e-3, np.float32)
    seen_factors = np.full((size, FACTORS), 1e-3, np.float32)
    seen_bias = 1e-3
    for _ in range(EPOCHS):
        order = random.permutation(len(rows))
        for start in range(0, len(order), BATCH):
            some = order[start : start + BATCH]
            counts = np.array([len(rows[i][0]) for i in some])
            index = np.concatenate([*[rows[i][0] for i in some], np.tile(np.arange(STATS) + BUCKETS, len(some))]).astype(np.int64)
            value = np.concatenate([np.repeat(1 / np.sqrt(np.maximum(counts, 1)), counts), scaled[some].ravel()])
            owner = np.concatenate([np.repeat(np.arange(len(some)), counts), np.repeat(np.arange(len(some)), STATS)])
            v = model.factors[index] * value[:, None]
            summed = np.column_stack([np.bincount(owner, v[:, f], len(some)) for f in range(FACTORS)])
            squared = np.bincount(owner, (v**2).sum(1), len(some))
            score = model.bias + np.bincount(owner, model.linear[index] * value, len(some))
            score += 0.5 * ((summed**2).sum(1) - squared)
            error = 1 / (1 + np.exp(-np.clip(score, -30, 30))) - labels[some]
            slope = error[owner] * value / len(some)
            used, place = np.unique(index, return_inverse=True)
            down = np.bincount(place, slope, len(used)) + SHRINK * model.linear[used]
            pull = slope[:, None] * (summed[owner] - v)
            down_factors = np.column_stack([np.bincount(place, pull[:, f], len(used)) for f in range(FACTORS)])
            down_factors += SHRINK * model.factors[used]
            seen[used] += down**2
            seen_factors[used] += down_factors**2
            seen_bias += error.mean() ** 2
            model.linear[used] -= RATE * down / np.sqrt(seen[used])
            model.factors[used] -= RATE * down_factors / np.sqrt(seen_factors[used])
            model.bias -= RATE * error.mean() / np.sqrt(seen_bias)
    return model


def train(
    docs: DataFrame, labels: DataFrame, key: str, text: str, metadata: str, label: str, may_learn: Column
) -> Model:
    """Fit on a bounded sample of the labelled rows for which ``may_learn`` holds."""
    known = (
        labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & may_learn)
        .groupBy(F.col(key).alias("__id"))
        .agg(F.min(label).cast("double").alias("__label"))
    )
    share = min(1.0, SAMPLE / max(known.count(), 1))
    chosen = known.where(F.pmod(F.xxhash64(F.lit(5), "__id"), F.lit(1 << 20)) < share * (1 << 20))
    source = docs.join(F.broadcast(chosen), docs[key] == chosen["__id"]).select(
        F.col("__id").alias("id"), F.col("__label").alias("label"),
        F.coalesce(F.col(metadata).cast("double"), F.lit(0.0)).alias("metadata"),
        F.col(text).cast("string").alias("text"),
    )
    # One row of each id, so that the sample stays bounded whatever repeats.
    source = source.groupBy("id").agg(F.min(F.struct("text", "metadata", "label")).alias("least")).select("id", "least.label", "least.metadata", "least.text")
    fitted = map_batches(source, _feature_rows, "id long, label double, buckets binary, stats binary")
    rows = sorted(fitted.collect(), key=lambda row: (row["id"], bytes(row["buckets"])))
    return fit(
        [
            (np.frombuffer(row["buckets"], np.uint16), np.frombuffer(row["stats"]), row["label"])
            for row in rows
        ]
    )


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches):
        buckets, first, stats = features(texts_of(batch.column("text")), batch.column("metadata").to_numpy())
        packed = buckets.astype(np.uint16)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"),
                batch.column("label"),
                pa.array([packed[a:b].tobytes() for a, b in zip(first[:-1], first[1:])], pa.binary()),
                pa.array([row.tobytes() for row in stats], pa.binary()),
            ],
            names=["id", "label", "buckets", "stats"],
        )


def score(
    docs: DataFrame, text: str, metadata: str, model: Model, keep: Sequence[str], name: str = "score"
) -> DataFrame:
    """The columns in ``keep`` and the score of each row. A text that is kept is sent to Python once."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kept_text = text in keep and docs.schema[text].dataType == T.StringType()
    source = docs.select(
        *[F.col(column) for column in keep],
        *([] if kept_text else [F.col(text).cast("string").alias("__text")]),
        F.coalesce(F.col(metadata).cast("double"), F.lit(0.0)).alias("__metadata"),
    )
    place = keep.index(text) if kept_text else len(keep)
    schema = T.StructType([*source.schema.fields[: len(keep)], T.StructField(name, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, place):
            found = features(texts_of(batch.column(place)), batch.column(batch.num_columns - 1).to_numpy())
            result = 1 / (1 + np.exp(-np.clip(raw_scores(sent.value, *found), -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(result)], names=[*batch.schema.names[: len(keep)], name]
            )

    return map_batches(source, run, schema)
