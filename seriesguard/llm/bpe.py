"""Byte-level BPE encoding and decoding through a sentencepiece model serialised from the ranks.

The rank file (one ``base64-bytes rank`` pair a line) becomes a sentencepiece BPE ``ModelProto``: every
token's bytes are mapped one by one to printable characters, its score is the negative rank, and the
normaliser is the identity. Merging the best-scored neighbours is then merging the lowest rank first. A
text is cut into pre-tokens by the pattern; each is encoded alone. Decoding maps ids back to bytes.

Rows are independent: one Arrow pass, no shuffle. Memory is one Arrow batch, the vocabulary and a bounded
cache of short pre-tokens in each worker.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name

#: Pre-tokens longer than this many characters aren't cached; beyond this many entries the cache starts anew.
CACHE_CHARS, CACHE_ENTRIES = 40, 300_000


def read_ranks(path: str) -> bytes:
    """The rank file's bytes, read by the driver and shipped to the workers (under 1 MB)."""
    with open(path, "rb") as f:
        return f.read()


def parse_ranks(raw: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in raw.splitlines() if line)}


def byte_characters() -> list[str]:
    """A printable character for each byte: printable Latin-1 stands for itself, the rest from U+0100 on."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in keep else chr(next(rest)) for b in range(256)]


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: int | float | bytes) -> bytes:
    """One protobuf field: varint, 32-bit float or length-delimited, by the value's type."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def model_proto(ranks: dict[bytes, int]) -> bytes:
    """The serialised model: piece i is the token of rank i, the unknown piece comes last."""
    size = max(ranks.values()) + 1
    tokens: list[bytes | None] = [None] * size
    for token, rank in ranks.items():
        tokens[rank] = token
    chars = byte_characters()
    normal, unknown, unused, bpe = 1, 2, 5, 2
    out = []
    for rank, token in enumerate(tokens):
        if token is None:  # a hole in the ranks
            piece, kind = f"<hole{rank}>", unused
        else:
            piece, kind = "".join(chars[b] for b in token), normal
        out.append(_field(1, _field(1, piece.encode()) + _field(2, float(-rank)) + _field(3, kind)))
    out.append(_field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, unknown)))
    trainer = b"".join([_field(3, bpe), _field(4, size + 1), _field(40, size), _field(41, -1), _field(42, -1),
                        _field(43, -1)])
    normalizer = b"".join([_field(1, b"identity"), _field(3, 0), _field(4, 0), _field(5, 0)])
    return b"".join(out) + _field(2, trainer) + _field(3, normalizer)


class Codec(dict):
    """Pre-token -> its ids as little-endian unsigned 32-bit integers, encoded when first met."""

    def __init__(self, raw_ranks: bytes, pattern: str):
        super().__init__()
        self.ranks = parse_ranks(raw_ranks)
        self.pattern = regex.compile(pattern)
        self.pieces = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.pieces[rank] = token
        self.chars = byte_characters()
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_proto(self.ranks))

    def __missing__(self, pre: str) -> bytes:
        raw = pre.encode()
        rank = self.ranks.get(raw)
        if rank is not None:  # a pre-token that is itself a token needs no merges
            ids = struct.pack("<I", rank)
        else:
            mapped = "".join(map(self.chars.__getitem__, raw))
            ids = np.asarray(self.model.encode(mapped), dtype="<u4").tobytes()
        if len(pre) <= CACHE_CHARS:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[pre] = ids
        return ids

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.pattern.findall(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.pieces.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_CODECS: dict[tuple[int, str], Codec] = {}


def _codec(raw: bytes, pattern: str) -> Codec:
    """One codec for each vocabulary and worker process."""
    key = (hash(raw), pattern)
    if key not in _CODECS:
        _CODECS[key] = Codec(raw, pattern)
    return _CODECS[key]


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text",
                  decode: bool = True) -> DataFrame:
    """``docs`` with ``n_tokens`` (long), ``ids_le`` (the ids, 4 little-endian bytes each) and, if asked for,
    ``decoded`` (the bytes that the ids stand for). Columns of these names in ``docs`` are replaced.

    A null text counts as empty: no tokens, empty binaries. Any text is encoded whole, however long;
    equal rows get equal results; an empty table gives an empty one; other columns pass through.
    """
    spark = docs.sparkSession
    shipped = spark.sparkContext.broadcast(read_ranks(ranks_path))
    out_names = ["n_tokens", "ids_le"] + ["decoded"] * decode
    rest = [c for c in docs.columns if c.lower() not in out_names]
    source = docs.select(*rest) if text_col in rest else docs.select(*rest, F.col(text_col).alias(free_name(docs, "_text")))
    read = text_col if text_col in rest else source.columns[-1]
    schema = T.StructType([*(docs.schema[c] for c in rest), T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_le", T.BinaryType()),
                           *([T.StructField("decoded", T.BinaryType())] if decode else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shipped.value, pattern)
        for batch in batches:
            at = batch.schema.names.index(read)
            for start in range(0, batch.num_rows, 1000):  # bounded output batches
                part = batch.slice(start, 1000)
                ids = [codec.encode(t or "") for t in part.column(at).to_pylist()]
                columns = [part.column(i) for i in range(len(rest))]
                columns += [pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
                if decode:
                    columns.append(pa.array([codec.decode(x) for x in ids], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return source.mapInArrow(run, schema)


def to_ids(ids_le) -> np.ndarray:
    """The ids of one packed binary."""
    return np.frombuffer(ids_le, "<u4")
