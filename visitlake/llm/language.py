"""Language identification by sparse multinomial logistic regression on character n-grams.

Features are the TF-IDF weights of hashed character n-grams (one to three characters). The model is
trained with follow-the-regularised-leader (FTRL-Proximal) with elastic-net penalties, and its
scores are calibrated with one temperature, fitted on rows of the sample that training left out.

Document frequencies are counted over all documents that may be learned from. The model is fitted on at
most about ``SAMPLE`` of them, an equal number per language as far as there are so many, chosen by a
hash of their ids. Prediction is map-only and reads whole texts; the model has a fixed size and is
broadcast.

Defined results: a text that is null or has no letter is ``und`` with score 0. Repeated rows get equal
results; ties go to the first language in code point order. Rows with a null id or language are not learned from. With
nothing to learn from, every text is ``und``. Columns that are not named do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlake.llm.arrow import map_batches, pieces
from visitlake.llm.textbytes import sums

UNKNOWN = "und"
BITS = 15
BUCKETS = 1 << BITS
LONGEST = 3
#: Documents that the model is fitted on, about.
SAMPLE = 4000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1
FEATURE_SCALE = 8.0
CALIBRATION_PART = 5
_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # bucket x language, with the inverse document frequency in it
    bias: np.ndarray
    temperature: float


def gram_buckets(texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Per length of n-gram: buckets, and the place of each text's first one."""
    lowered = [(text or "").lower() for text in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.concatenate(([0], np.cumsum([len(text) for text in lowered])))
    lengths = np.diff(starts)
    buckets, firsts = [], []
    rolled = np.zeros(len(codes), np.uint32)
    for n in range(1, LONGEST + 1):
        # Hash of the n characters from each place on; the last n - 1 of a text start none.
        rolled = rolled[: len(codes) - n + 1] * _MULTIPLIERS[0] + codes[n - 1 :] * _MULTIPLIERS[1]
        hashed = (rolled ^ (rolled >> np.uint32(15))) * _MULTIPLIERS[2] + np.uint32(n)
        hashed = (hashed >> np.uint32(32 - BITS)).astype(np.int32)
        counts = np.maximum(lengths - n + 1, 0)
        first = np.concatenate(([0], np.cumsum(counts)))
        if n > 1 and len(codes):
            keep = np.ones(len(codes), bool)
            for back in range(1, n):
                ends = starts[1:] - back
                keep[ends[ends >= starts[:-1]]] = False
            hashed = hashed[keep[: len(hashed)]]
        buckets.append(hashed)
        firsts.append(first)
    return buckets, firsts


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per bucket that occurs in the task's documents."""
    found = np.zeros(BUCKETS, np.int64)
    for batch in pieces(batches):
        texts = batch.column("text").to_pylist()
        seen = np.zeros((len(texts), BUCKETS), bool)
        for buckets, first in zip(*gram_buckets(texts)):
            seen[np.repeat(np.arange(len(texts)), np.diff(first)), buckets] = True
        found += seen.sum(0)
    used = np.flatnonzero(found)
    yield pa.RecordBatch.from_arrays(
        [pa.array(used.astype(np.int32)), pa.array(found[used])], names=["bucket", "documents"]
    )


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sparse n-gram counts of each document of the sample."""
    for batch in pieces(batches):
        texts = batch.column("text").to_pylist()
        grams = gram_buckets(texts)
        rows = []
        for i in range(len(texts)):
            own = np.concatenate([b[f[i] : f[i + 1]] for b, f in zip(*grams)])
            used, counts = np.unique(own, return_counts=True)
            rows.append((used.astype(np.int32).tobytes(), counts.astype(np.int32).tobytes()))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"),
                batch.column("lang"),
                pa.array([row[0] for row in rows], pa.binary()),
                pa.array([row[1] for row in rows], pa.binary()),
            ],
            names=["id", "lang", "buckets", "counts"],
        )


def train(docs: DataFrame, key: str, text: str, language: str, may_learn: Column) -> Model:
    """Learn from text and language of the rows for which ``may_learn`` holds."""
    source = docs.where(F.col(key).isNotNull() & F.col(language).isNotNull() & may_learn).select(
        F.col(key).cast("long").alias("id"),
        F.col(language).alias("lang"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    sizes = {row["lang"]: row["count"] for row in source.groupBy("lang").count().collect()}
    languages = sorted(sizes, key=lambda name: name.encode())
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0), 1.0)
    spread = 1 << 24
    shares = F.create_map(
        *[
            F.lit(x)
            for name in languages
            for x in (name, int(spread * min(1.0, SAMPLE / len(languages) / sizes[name])))
        ]
    )
    chosen = source.where(F.pmod(F.xxhash64(F.lit(3), "id"), F.lit(spread)) < shares[F.col("lang")])
    # One row of each id, so that the sample stays bounded whatever repeats.
    chosen = chosen.groupBy("id").agg(F.min(F.struct("text", "lang")).alias("least")).select("id", "least.lang", "least.text")
    rows = map_batches(chosen, _counts, "id long, lang string, buckets binary, counts binary").collect()
    rows.sort(key=lambda row: (row["id"], bytes(row["buckets"]), bytes(row["counts"])))

    frequency = np.zeros(BUCKETS)
    frequencies = map_batches(source.select("text"), _document_frequencies, "bucket int, documents long")
    for row in frequencies.groupBy("bucket").agg(F.sum("documents").alias("documents")).collect():
        frequency[row["bucket"]] = row["documents"]
    idf = np.log((1 + sum(sizes.values())) / (1 + frequency)) + 1

    place = {name: i for i, name in enumerate(languages)}
    examples = []
    for row in rows:
        buckets = np.frombuffer(row["buckets"], np.int32)
        counts = np.frombuffer(row["counts"], np.int32)
        if len(buckets):
            x = FEATURE_SCALE * idf[buckets] * counts / counts.sum()
            examples.append((buckets, x, place[row["lang"]]))
    held = examples[::CALIBRATION_PART]
    fitted = [example for i, example in enumerate(examples) if i % CALIBRATION_PART or len(examples) < 50]
    weights, bias = fit_ftrl(fitted, len(languages))
    temperature = fit_temperature(held, weights, bias)
    scaled = (weights * idf[:, None] * FEATURE_SCALE).astype(np.float32)
    return Model(languages, scaled, bias, temperature)


def fit_ftrl(examples: list[tuple], classes: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-Proximal, one example at a time. The bias is a feature of its own, without penalty."""
    z, n = np.zeros((BUCKETS + 1, classes)), np.zeros((BUCKETS + 1, classes))

    def weights_of(z: np.ndarray, n: np.ndarray, l1: float = L1, l2: float = L2) -> np.ndarray:
        shrunk = np.sign(z) * np.maximum(np.abs(z) - l1, 0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + l2)

    order = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for i in order.permutation(len(examples)):
            buckets, x, label = examples[i]
            rows, values = np.append(buckets, BUCKETS), np.append(x, 1.0)
            w = weights_of(z[rows], n[rows])
            w[-1] = weights_of(z[BUCKETS], n[BUCKETS], 0.0, 0.0)
            error = softmax(values @ w)
            error[label] -= 1
            slope = values[:, None] * error
            before = n[rows]
            after = before + slope**2
            z[rows] += slope - (np.sqrt(after) - np.sqrt(before)) / ALPHA * w
            n[rows] = after
    return weights_of(z[:-1], n[:-1]), weights_of(z[-1], n[-1], 0.0, 0.0)


def softmax(scores: np.ndarray) -> np.ndarray:
    powers = np.exp(scores - scores.max(-1, keepdims=True))
    return powers / powers.sum(-1, keepdims=True)


def fit_temperature(held: list[tuple], weights: np.ndarray, bias: np.ndarray) -> float:
    """The temperature with the least log loss on rows that training has not seen."""
    if not held:
        return 1.0
    scores = np.array([x @ weights[buckets] + bias for buckets, x, _ in held])
    labels = np.array([label for _, _, label in held])
    tried = np.geomspace(0.05, 20, 121)
    losses = [
        -np.log(softmax(scores / t)[np.arange(len(labels)), labels] + 1e-12).mean() for t in tried
    ]
    return float(tried[int(np.argmin(losses))])


def predict(docs: DataFrame, key: str, text: str, model: Model) -> DataFrame:
    """Rows (key, lang_pred, score)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        has_letter = regex.compile(r"\p{L}").search
        model = sent.value
        names = np.array([*model.languages, UNKNOWN], object)
        for batch in pieces(batches):
            texts = batch.column("text").to_pylist()
            known = np.array([bool(text and model.languages and has_letter(text)) for text in texts], bool)
            best, score = np.full(len(texts), len(names) - 1), np.zeros(len(texts))
            if known.any():
                logits, grams = 0.0, 0
                for buckets, first in zip(*gram_buckets(texts)):
                    grams = grams + np.diff(first)
                    logits = logits + np.column_stack(
                        [sums(model.weights[:, c][buckets], first) for c in range(len(model.languages))]
                    )
                logits = logits / np.maximum(grams, 1)[:, None] + model.bias
                shares = softmax(logits / model.temperature)
                best = np.where(known, shares.argmax(1), best)
                score = np.where(known, shares.max(1), 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(names[best].tolist(), pa.string()), pa.array(score)],
                names=["key", "lang_pred", "score"],
            )

    return map_batches(source, run, "key long, lang_pred string, score double")
