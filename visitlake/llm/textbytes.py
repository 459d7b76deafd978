"""Texts of an Arrow column as one array of bytes, and hashes of their words, without a loop per word."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words are separated by blanks and the controls 0x09 to 0x0D.
SEPARATORS = np.zeros(256, bool)
SEPARATORS[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

U = np.uint64
_ODD = U(0x9E3779B97F4A7C15)
_INVERSE = U(pow(int(_ODD), -1, 2**64))
#: A random 64-bit number for each byte, from a fixed seed.
BYTE_VALUES = np.random.default_rng(20).integers(1, 2**64, 256, dtype=np.uint64)
LOWER_VALUES = BYTE_VALUES[LOWER]
#: Others, for a second hash that tells apart what the first one does not.
OTHER_LOWER_VALUES = np.random.default_rng(21).integers(1, 2**64, 256, dtype=np.uint64)[LOWER]
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


@dataclass
class Texts:
    data: np.ndarray  # bytes of all texts
    starts: np.ndarray  # where each begins, and the end of the last

    def __len__(self) -> int:
        return len(self.starts) - 1


def texts_of(column: pa.Array) -> Texts:
    """Null texts are empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    starts = np.frombuffer(column.buffers()[1], np.int64)[column.offset :][: len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return Texts(data[starts[0] : starts[-1]], starts - starts[0])


def word_spans(
    texts: Texts, separators: np.ndarray = SEPARATORS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the place of the first word of each text."""
    inside = ~separators[texts.data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edges = texts.starts[1:-1]
    edges = edges[(edges > 0) & (edges < len(inside))]
    opens[edges] = inside[edges]
    closes[edges - 1] = inside[edges - 1]
    begins = np.flatnonzero(opens)
    return begins, np.flatnonzero(closes) + 1, np.searchsorted(begins, texts.starts)


def mixed(values: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of the value."""
    values = values ^ (values >> U(31))
    values = values * U(0xBF58476D1CE4E5B9)
    values = values ^ (values >> U(29))
    values = values * U(0x94D049BB133111EB)
    return values ^ (values >> U(32))


def prefix_hashes(values: np.ndarray) -> np.ndarray:
    """Running sums for ``span_hashes``: one more than there are values."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values))[0][: len(values)], out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each span of values that depends on nothing but the values in it."""
    apart = (prefix[ends] - prefix[begins]) * powers(len(prefix))[1][begins]
    return mixed(apart + (ends - begins).astype(np.uint64) * U(0xD6E8FEB86659FD93))


def powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64, as many as asked for at least."""
    global _powers
    if len(_powers[0]) < count:
        size = max(count, 1 << 20)
        both = []
        for base in (_ODD, _INVERSE):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            both.append(np.cumprod(steps))
        _powers = tuple(both)
    return _powers


def word_hashes(texts: Texts, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word, A to Z lower-cased, and the place of each text's first word."""
    begins, ends, first = word_spans(texts)
    values = (LOWER_VALUES if lower else BYTE_VALUES)[texts.data]
    return span_hashes(prefix_hashes(values), begins, ends), first


def owners(first: np.ndarray) -> np.ndarray:
    """The text of each item, from the place of each text's first item."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of the items of each text; works for texts without items."""
    total = np.zeros((len(values) + 1, *values.shape[1:]), np.float64)
    np.cumsum(values, axis=0, out=total[1:])
    return total[first[1:]] - total[first[:-1]]
