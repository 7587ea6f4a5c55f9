"""Byte-level BPE through a sentencepiece model written from a rank table.

The vocabulary file lists byte strings and their ranks. ``model_proto`` writes
a sentencepiece BPE model from it: each byte string becomes a piece in which
every byte stands as one printable character, and the piece's score is its
negative rank, so that the best-scored merge is the lowest-ranked one.
Normalisation is the identity. A text is cut into pre-tokens by a pattern,
each pre-token is mapped byte by byte and encoded alone, and ids are decoded by
the inverse mapping.

Defined results: a null or empty text has no ids and decodes to no bytes; texts
of any length are encoded whole; repeated rows are encoded alike.
"""

from __future__ import annotations

import base64
import struct
from collections import ChainMap
from collections.abc import Iterable, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from millrace.storage import bound_batches

UNKNOWN = "<unk>"
CACHED_PRETOKENS = 30_000  # at most 64 characters and as many ids each: about 10 MB, 30 at worst
CACHED_LENGTH = 64
TEXTS_AT_ONCE = 256
NORMAL_PIECE, UNKNOWN_PIECE = 1, 2
BPE_MODEL = 2


@lru_cache(maxsize=1)
def byte_characters() -> str:
    """256 characters, one per byte: printable Latin-1 stands for itself, the
    other bytes get the characters from U+0100 on, in byte order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return "".join(chr(b) if b in own else chr(next(others)) for b in range(256))


def read_ranks(path: str) -> list[bytes]:
    """The byte strings of a rank file, by rank. Ranks must run from 0 without gaps."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    by_rank = {int(rank): base64.b64decode(text) for text, rank in pairs}
    if sorted(by_rank) != list(range(len(by_rank))):
        raise ValueError(f"{path}: ranks have gaps")
    return [by_rank[rank] for rank in range(len(by_rank))]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _block(field: int, body: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(body)) + body


def model_proto(tokens: Sequence[bytes]) -> bytes:
    """A serialised sentencepiece BPE model in which a piece's id is its rank.

    The unknown piece, which sentencepiece asks for, gets the id after the last.
    Field numbers are those of sentencepiece's public model format.
    """
    to_char = byte_characters()

    def piece(text: str, score: float, kind: int) -> bytes:
        return _block(1, _block(1, text.encode()) + b"\x15" + struct.pack("<f", score) + _number(3, kind))

    pieces = [piece("".join(to_char[b] for b in token), -float(rank), NORMAL_PIECE) for rank, token in enumerate(tokens)]
    pieces.append(piece(UNKNOWN, 0.0, UNKNOWN_PIECE))
    no_id = (1 << 64) - 1  # -1
    trainer = (
        _number(3, BPE_MODEL) + _number(4, len(pieces)) + _number(40, len(tokens))
        + _number(41, no_id) + _number(42, no_id) + _number(43, no_id)
    )
    normalizer = _block(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join(pieces) + _block(2, trainer) + _block(3, normalizer)


class Codec:
    """Encodes texts and decodes ids with a serialised model.

    Ids of short pre-tokens are kept; the store is emptied when it holds more
    than ``CACHED_PRETOKENS``.
    """

    def __init__(self, proto: bytes, pattern: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.cut = regex.compile(pattern).findall
        self.to_char = byte_characters()
        to_byte = {c: b for b, c in enumerate(self.to_char)}
        last = self.model.get_piece_size() - 1
        self.pieces = [bytes(to_byte[c] for c in self.model.id_to_piece(i)) for i in range(last)]
        self.kept: dict[str, list[int]] = {}

    def _encode_new(self, pretokens: Iterable[str]) -> dict[str, list[int]]:
        new = list(pretokens)
        mapped = [t.encode().decode("latin-1").translate(self.to_char) for t in new]
        return dict(zip(new, self.model.encode(mapped, out_type=int, num_threads=1))) if new else {}

    def encode_all(self, texts: Sequence[str | None]) -> list[np.ndarray]:
        """Ids of each text. New pre-tokens of all the texts are encoded in one call."""
        cut = [self.cut(text or "") for text in texts]
        if len(self.kept) > CACHED_PRETOKENS:
            self.kept = {}
        fresh = self._encode_new(set(chain.from_iterable(cut)).difference(self.kept))
        known = ChainMap(fresh, self.kept) if any(len(t) > CACHED_LENGTH for t in fresh) else self.kept
        self.kept.update((t, ids) for t, ids in fresh.items() if len(t) <= CACHED_LENGTH)
        return [np.fromiter(chain.from_iterable(map(known.__getitem__, t)), np.int32) for t in cut]

    def encode(self, text: str | None) -> list[int]:
        return self.encode_all([text])[0].tolist()

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids))


@lru_cache(maxsize=1)
def _codec(proto: bytes, pattern: str) -> Codec:
    return Codec(proto, pattern)


def _encode_column(codec: Codec, texts: pa.Array) -> list[np.ndarray]:
    ids: list[np.ndarray] = []
    for at in range(0, len(texts), TEXTS_AT_ONCE):
        ids += codec.encode_all(texts[at : at + TEXTS_AT_ONCE].to_pylist())
    return ids


def _ids_column(ids: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, ids)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.empty(0, np.int32), *ids])))


class ByteBpe:
    """Column functions over one vocabulary. The model (about 1 MB, fixed by the
    vocabulary) is the only thing that is broadcast."""

    def __init__(self, spark: SparkSession, ranks_path: str, pattern: str):
        bound_batches(spark)
        self.proto: Broadcast = spark.sparkContext.broadcast(model_proto(read_ranks(ranks_path)))
        self.pattern = pattern

    def encode(self, text: Column | str) -> Column:
        """Token ids as ``array<int>``; empty for a null text."""
        proto, pattern = self.proto, self.pattern

        def encode(texts: pa.Array) -> pa.Array:
            return _ids_column(_encode_column(_codec(proto.value, pattern), texts))

        return F.arrow_udf(encode, "array<int>")(text)

    def round_trip(self, text: Column | str) -> Column:
        """``ids`` as from ``encode``, and ``decoded``: the bytes decoded from these ids."""
        proto, pattern = self.proto, self.pattern

        def round_trip(texts: pa.Array) -> pa.Array:
            codec = _codec(proto.value, pattern)
            ids = _encode_column(codec, texts)
            decoded = pa.array([codec.decode(row.tolist()) for row in ids], pa.binary())
            return pa.StructArray.from_arrays([_ids_column(ids), decoded], ["ids", "decoded"])

        return F.arrow_udf(round_trip, "ids array<int>, decoded binary")(text)

    def decode(self, ids: Column | str) -> Column:
        """The bytes that the ids stand for; none for null."""
        proto, pattern = self.proto, self.pattern

        def decode(rows: pa.Array) -> pa.Array:
            codec = _codec(proto.value, pattern)
            return pa.array([codec.decode(row.as_py() or ()) for row in rows], pa.binary())

        return F.arrow_udf(decode, "binary")(ids)
