"""Byte-level BPE: a rank file as a sentencepiece model, encoding of pre-tokens, decoding by inverse mapping.

Every byte is shown as one printable character, so every token of the vocabulary is a piece of text.
The piece of rank r has the score -r; merging the pair with the best score is then merging the pair
of the lowest rank, which is what a rank file means. Normalisation is the identity. The model is
serialised here, byte by byte; nothing is trained.

Text is split by a pattern and each match is encoded by itself. A match that is a token as a whole
is that token. Nulls count as empty texts; empty texts have no ids. Decoding skips nothing: an id
outside the vocabulary raises. All functions work on columns, so other columns of a table, whatever
their names, stay out of it, and repeated rows give the same result each.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType

#: Pre-tokens remembered by a worker, and the longest that is; bounds its memory.
REMEMBERED, LONGEST = 400_000, 48
BPE, NORMAL, UNKNOWN = 2, 1, 2


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file, by rank; ranks have to be 0, 1, 2 and so on."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    if not all(tokens) or len(set(tokens)) != len(tokens):
        raise ValueError(f"{path}: ranks are not 0 to n - 1, or a token occurs twice")
    return tokens


def byte_letters() -> list[str]:
    """A visible character for each byte: printable Latin-1 for itself, the rest from U+0100 on."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


def _varint(n: int) -> bytes:
    out = b""
    while n > 0x7F:
        out, n = out + bytes([n & 0x7F | 0x80]), n >> 7
    return out + bytes([n])


def _field(number: int, value: int | float | bytes) -> bytes:
    """One field of a protobuf message: a number as varint or 32-bit float, bytes with their length."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def model_bytes(tokens: list[bytes]) -> bytes:
    """The sentencepiece model: piece i is token i; one more piece, the last, stands for what is unknown."""
    letters = byte_letters()
    pieces = [("".join(map(letters.__getitem__, t)).encode(), -float(rank), NORMAL) for rank, t in enumerate(tokens)]
    pieces.append((b"<unk>", 0.0, UNKNOWN))
    out = b"".join(_field(1, _field(1, p) + _field(2, s) + _field(3, kind)) for p, s, kind in pieces)
    trainer = _field(3, BPE) + _field(4, len(pieces)) + _field(40, len(tokens))
    identity = _field(1, b"identity") + _field(2, b"") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return out + _field(2, trainer) + _field(3, identity)


class Encoder(dict):
    """The ids of a pre-token; remembers the short ones."""

    def __init__(self, path: str, pattern: str):
        import regex
        import sentencepiece

        super().__init__()
        tokens = read_ranks(path)
        self.split = regex.compile(pattern).findall
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(tokens))
        self.whole = {t: [i] for i, t in enumerate(tokens)}
        self.letters = byte_letters()

    def __missing__(self, pre_token: str) -> list[int]:
        raw = pre_token.encode("utf-8")
        ids = self.whole.get(raw) or self.pieces.encode("".join(map(self.letters.__getitem__, raw)), out_type=int)
        if len(pre_token) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[pre_token] = ids
        return ids

    def ids(self, text: str) -> list[int]:
        out: list[int] = []
        for pre_token in self.split(text):
            out += self[pre_token]
        return out


def encode(text: Column, path: str, pattern: str) -> Column:
    """array<int>: the ids of a text. ``path``: the rank file, readable on every executor."""

    @F.arrow_udf(ArrayType(IntegerType(), False))
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Encoder(path, pattern)
        for texts in batches:
            lists = [pa.array(own.ids(t.as_py() or ""), pa.int32()) for t in texts]
            ends = [0]
            for x in lists:
                ends.append(ends[-1] + len(x))
            values = pa.concat_arrays(lists) if lists else pa.array([], pa.int32())
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)

    return ids(text)


def decode(ids: Column, path: str) -> Column:
    """binary: the bytes of a list of ids; null ids give no bytes."""

    @F.arrow_udf(BinaryType())
    def joined(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = read_ranks(path)
        for lists in batches:
            numbers = (x.values.to_numpy(zero_copy_only=False).tolist() if x.is_valid else () for x in lists)
            yield pa.array((b"".join(map(tokens.__getitem__, n)) for n in numbers), pa.binary())

    return joined(ids)
