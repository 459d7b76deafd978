"""The coder against the tiktoken library, and its edge cases."""

import base64
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from visitlake.llm import byte_bpe
from visitlake.llm.queries import BPE_RANKS

PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def reference():
    with open(BPE_RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_pieces_equal_reference(reference):
    draw, ids_of = random.Random(4), byte_bpe.PieceIds(byte_bpe.read_ranks(BPE_RANKS))
    split, _ = byte_bpe._encoder(BPE_RANKS, PATTERN)
    alphabets = ["a", "ab", "aA1 ", "!$*", "\n \t", " é́漢字😀", "thers ", "01", "   x", "-=_", "’'s"]
    for _ in range(3000):
        text = "".join(draw.choice(draw.choice(alphabets)) for _ in range(draw.randint(0, 60)))
        packed = b"".join(ids_of[piece] for piece in split(text))
        assert np.frombuffer(packed, byte_bpe.ID).tolist() == reference.encode_ordinary(text)


def test_edge_documents(edge_docs, reference):
    encoded = byte_bpe.encode(edge_docs, "text", BPE_RANKS, PATTERN, ["doc_id", "text"], offsets=True)
    decoded = byte_bpe.decode(encoded, "ids", BPE_RANKS, ["text", "ids", "starts"]).collect()
    assert len(decoded) == edge_docs.count()
    for row in decoded:
        text = row["text"] or ""
        ids = np.frombuffer(row["ids"], byte_bpe.ID).tolist()
        assert ids == reference.encode_ordinary(text)
        assert bytes(row["decoded"]) == text.encode()
        lengths = [len(reference.decode_single_token_bytes(i)) for i in ids]
        assert row["starts"] == np.cumsum([0, *lengths])[:-1].tolist()


def test_split_characters_and_bad_ids(spark):
    ids_of = byte_bpe.PieceIds(byte_bpe.read_ranks(BPE_RANKS))
    halves = [np.array([i], byte_bpe.ID).tobytes() for i in np.frombuffer(ids_of["😀"], byte_bpe.ID)]
    rows = [(0, b"".join(halves)), (1, None), (2, halves[0])]
    table = spark.createDataFrame(rows, "key long, ids binary")
    found = {r["key"]: bytes(r["decoded"]) for r in byte_bpe.decode(table, "ids", BPE_RANKS, ["key"]).collect()}
    assert found[0].decode() == "😀" and found[1] == b""
    assert "😀".encode().startswith(found[2])
    unknown = spark.createDataFrame([(np.array([60000], byte_bpe.ID).tobytes(),)], "ids binary")
    with pytest.raises(Exception, match="not in the vocabulary"):
        byte_bpe.decode(unknown, "ids", BPE_RANKS).collect()


def test_empty_table(no_docs):
    encoded = byte_bpe.encode(no_docs, "text", BPE_RANKS, PATTERN, ["doc_id"])
    assert byte_bpe.decode(encoded, "ids", BPE_RANKS).count() == 0
