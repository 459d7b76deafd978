"""Byte-level BPE encoding and decoding with a rank file.

``encode`` cuts a text with the split pattern, writes the bytes of every piece as the characters
that the tokenizers library uses for bytes, and merges them with its BPE model. Random ranks of a
rank file become merges: a token may come from every pair of tokens that it can be cut into, and
all these merges stand at the token's own rank, so the pair with the lowest rank merges first.
``decode`` goes back through the byte table. A character may be split over tokens, so ids decode to
bytes; only whole rows are read as text.

Both are map-only: no shuffle, and a task holds one Arrow batch and a bounded table of pieces.

Defined results: a null or empty text has no ids; null ids decode to no bytes; an id outside the
vocabulary raises; repeated rows, ties and null keys pass through as they are; only the columns in
``keep`` are carried, so further columns of the input may have any name; an empty table gives none.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitlake.llm.arrow import map_batches, pieces

#: Pieces that a task remembers; beyond it the table starts anew. Results don't depend on it.
REMEMBERED_PIECES = 150_000
REMEMBERED_LENGTH = 40
ID = np.dtype("<u4")


def byte_characters() -> dict[int, str]:
    """The character for each byte: printable Latin-1 bytes stand for themselves, the others
    follow from U+0100 in order."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {byte: chr(byte) for byte in printable}
    others = [byte for byte in range(256) if byte not in table]
    return table | {byte: chr(0x100 + place) for place, byte in enumerate(others)}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class PieceIds(dict):
    """Piece of text to its ids, packed as little-endian 32-bit integers."""

    def __init__(self, ranks: dict[bytes, int]):
        from tokenizers import models

        self.to_characters = str.maketrans(byte_characters())
        spelled = {token: self.spell(token) for token in ranks}
        merges = [
            (spelled[token[:cut]], spelled[token[cut:]])
            for token in sorted(ranks, key=ranks.get)
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        ]
        vocabulary = {spelled[token]: rank for token, rank in ranks.items()}
        self.model = models.BPE(
            vocab=vocabulary, merges=merges, ignore_merges=True, cache_capacity=0
        )

    def spell(self, raw: bytes) -> str:
        return raw.decode("latin-1").translate(self.to_characters)

    def __missing__(self, piece: str) -> bytes:
        tokens = self.model.tokenize(self.spell(piece.encode()))
        packed = np.array([token.id for token in tokens], ID).tobytes()
        if len(piece) <= REMEMBERED_LENGTH:
            if len(self) >= REMEMBERED_PIECES:
                self.clear()
            self[piece] = packed
        return packed


def _encoder(path: str, pattern: str):
    """The splitter and the piece table of a task; a worker that is used again does not keep them."""
    import regex

    return regex.compile(pattern).findall, PieceIds(read_ranks(path))


def _token_bytes(path: str) -> tuple[pa.Array, np.ndarray]:
    """Bytes and length of each id; unused ids are null and have length -1."""
    ranks = read_ranks(path)
    tokens: list[bytes | None] = [None] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    lengths = np.array([-1 if token is None else len(token) for token in tokens], np.int64)
    return pa.array(tokens, pa.large_binary()), lengths


def _joined(values: pa.Array) -> bytes:
    """The values one after the other: what their data buffer holds."""
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset :][: len(values) + 1]
    return values.buffers()[2].to_pybytes()[offsets[0] : offsets[-1]] if len(values) else b""


def encode(
    df: DataFrame, text: str, path: str, pattern: str, keep: Sequence[str] = (), offsets: bool = False
) -> DataFrame:
    """The columns in ``keep`` and ``ids``, the packed ids of the text (32-bit little-endian).

    With ``offsets``, also ``starts`` (array of long): the byte of the UTF-8 text at which each
    token starts. ``path`` must be readable on every executor.
    """
    source = df.select(*[F.col(name) for name in keep], F.col(text).cast("string").alias("__text"))
    fields = [*source.schema.fields[:-1], T.StructField("ids", T.BinaryType())]
    if offsets:
        fields.append(T.StructField("starts", T.ArrayType(T.LongType())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, ids_of = _encoder(path, pattern)
        lengths = _token_bytes(path)[1] if offsets else None
        for batch in pieces(batches):
            columns = batch.columns
            packed = [
                b"".join([ids_of[piece] for piece in split(value)]) if value else b""
                for value in columns[-1].to_pylist()
            ]
            out = [*columns[:-1], pa.array(packed, pa.binary())]
            names = [*batch.schema.names[:-1], "ids"]
            if offsets:
                ends = [np.cumsum(lengths[np.frombuffer(ids, ID)]) for ids in packed]
                starts = [np.concatenate(([0], end[:-1])) if len(end) else end for end in ends]
                out.append(pa.array(starts, pa.list_(pa.int64())))
                names.append("starts")
            yield pa.RecordBatch.from_arrays(out, names=names)

    return map_batches(source, run, T.StructType(fields))


def decode(df: DataFrame, ids: str, path: str, keep: Sequence[str] = ()) -> DataFrame:
    """The columns in ``keep`` and ``decoded``, the bytes that the packed ids stand for."""
    source = df.select(*[F.col(name) for name in keep], F.col(ids).alias("__ids"))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, lengths = _token_bytes(path)
        for batch in pieces(batches):
            rows = [value or b"" for value in batch.columns[-1].to_pylist()]
            flat = np.frombuffer(b"".join(rows), ID)
            if len(flat) and (flat.max() >= len(lengths) or lengths[flat].min() < 0):
                raise ValueError("an id is not in the vocabulary")
            data = _joined(tokens.take(pa.array(flat)))
            ends = np.concatenate(([0], np.cumsum(lengths[flat])))
            cuts = ends[np.cumsum([0, *[len(row) // ID.itemsize for row in rows]])]
            decoded = [data[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(decoded, pa.binary())],
                names=[*batch.schema.names[:-1], "decoded"],
            )

    return map_batches(source, run, schema)
