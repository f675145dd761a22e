"""Byte-level BPE by a sentencepiece model written straight from a vocabulary of ranks.

Each byte is mapped to a character of its own, each token to a piece of such characters with the
score of its negative rank, and the normalizer is the identity; so sentencepiece merges exactly what
has the lowest rank. Texts are cut into pre-tokens by the vocabulary's pattern, each pre-token is
encoded alone, and decoding maps pieces back to bytes.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType

from tidewell.llm.shipping import shipped, tidied

#: Byte b stands as this code point plus b: letters that nothing normalises or splits.
_FIRST = 0x100
#: Distinct pre-tokens a worker remembers; bounds its memory.
CACHE = 100_000

_CHARACTERS = [chr(_FIRST + b) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """A vocabulary file of lines `base64 rank`."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def mapped(data: bytes) -> str:
    return "".join([_CHARACTERS[b] for b in data])


# -- the model file: the few fields of sentencepiece's ModelProto that matter -------


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _bytes(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


# Fixed values of the format: field numbers, and BPE = 2, NORMAL = 1, UNKNOWN = 2.
_PIECES, _TRAINER, _NORMALIZER = 1, 2, 3
_PIECE, _SCORE, _TYPE = 1, 2, 3
_MODEL_TYPE, _VOCAB_SIZE = 3, 4
_NAME, _DUMMY_PREFIX, _EXTRA_WHITESPACE, _ESCAPE_WHITESPACE = 1, 3, 4, 5


def serialised(ranks: dict[bytes, int]) -> bytes:
    """The model; piece 0 is the unknown one, piece n + 1 the token of the n-th lowest rank."""
    pieces = [_bytes(_PIECES, _bytes(_PIECE, b"<unk>") + _number(_TYPE, 2))]
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        score = _varint(_SCORE << 3 | 5) + struct.pack("<f", -rank)
        pieces.append(_bytes(_PIECES, _bytes(_PIECE, mapped(token).encode()) + score + _number(_TYPE, 1)))
    trainer = _number(_MODEL_TYPE, 2) + _number(_VOCAB_SIZE, len(pieces))
    plain = _bytes(_NAME, b"identity")
    for field in (_DUMMY_PREFIX, _EXTRA_WHITESPACE, _ESCAPE_WHITESPACE):
        plain += _number(field, 0)
    return b"".join(pieces) + _bytes(_TRAINER, trainer) + _bytes(_NORMALIZER, plain)


class Codec:
    """Encodes and decodes by a model and the ranks in the order of its pieces."""

    def __init__(self, model: bytes, ranks: list[int], pattern: str) -> None:
        import regex
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.ranks, self.cut = ranks, regex.compile(pattern).findall
        self.seen: dict[str, list[int]] = {}
        self.pieces: dict[int, bytes] = {}

    def encode(self, texts: list[str]) -> list[list[int]]:
        cut = [self.cut(t) for t in texts]
        new = list(set(chain.from_iterable(cut)).difference(self.seen))
        if len(self.seen) + len(new) > CACHE:
            self.seen, new = {}, list(set(chain.from_iterable(cut)))
        coded = self.processor.encode([mapped(p.encode()) for p in new]) if new else []
        for word, ids in zip(new, coded, strict=True):
            self.seen[word] = [self.ranks[i - 1] for i in ids]
        get = self.seen.__getitem__
        return [list(chain.from_iterable(map(get, words))) for words in cut]

    def decode(self, ids: Iterable[int]) -> bytes:
        if not self.pieces:
            for place, rank in enumerate(self.ranks):
                piece = self.processor.id_to_piece(place + 1)
                self.pieces[rank] = bytes([ord(c) - _FIRST for c in piece])
        return b"".join(map(self.pieces.__getitem__, ids))


_CODECS: dict[tuple, Codec] = {}


def _codec(sent, pattern: str) -> Codec:
    """One for each worker process and model."""
    model, ranks = sent.value
    key = (hash(model), pattern)
    if key not in _CODECS:
        _CODECS[key] = Codec(model, ranks, pattern)
    return _CODECS[key]


def _sent(df: DataFrame, path: str):
    """The model to all executors: as large as the vocabulary, whatever the input."""
    ranks = read_ranks(path)
    return df.sparkSession.sparkContext.broadcast((serialised(ranks), sorted(ranks.values())))


def _groups(batch: pa.RecordBatch, rows: int = 100) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """`docs` as the column `document`, with `ids`: the token ids of each whole `text`.

    A null text is encoded as an empty one, which has no ids. Text is encoded as it is, without
    special tokens. Repeated rows, null ids and an empty table need nothing special. `document` is a
    struct of all columns, so that no name clashes.
    """
    sent = _sent(docs, path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(sent, pattern)
        for batch in batches:
            for part in _groups(batch):
                ids = codec.encode([t or "" for t in part.column("document").field("text").to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column("document"), _lists(ids)], names=["document", "ids"]
                )

    rows = shipped(docs).select(F.struct("*").alias("document"))
    return rows.mapInArrow(work, _schema(rows, "document").add("ids", ArrayType(IntegerType())))


def decode(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """`tokens` (document, ids) with `decoded`: the bytes that the ids stand for; null ids have none."""
    sent = _sent(tokens, path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(sent, pattern)
        for batch in batches:
            for part in _groups(batch):
                ids = part.column("ids")
                sizes, flat = ids.value_lengths().fill_null(0).to_pylist(), iter(ids.flatten().to_numpy().tolist())
                data = [codec.decode(islice(flat, n)) for n in sizes]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(data, pa.binary())], names=[*part.schema.names, "decoded"]
                )

    return shipped(tokens).mapInArrow(work, _schema(tokens).add("decoded", "binary"))


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """`encode` and `decode` in one worker: document, ids, and what the ids decode to."""
    sent = _sent(docs, path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(sent, pattern)
        for batch in batches:
            for part in _groups(batch):
                ids = codec.encode([t or "" for t in part.column("document").field("text").to_pylist()])
                data = pa.array([codec.decode(row) for row in ids], pa.binary())
                columns = [part.column("document"), _lists(ids), data]
                yield pa.RecordBatch.from_arrays(columns, names=["document", "ids", "decoded"])
        codec.seen = {}
        tidied()

    rows = shipped(docs).select(F.struct("*").alias("document"))
    return rows.mapInArrow(work, _schema(rows).add("ids", ArrayType(IntegerType())).add("decoded", "binary"))


def _lists(rows: list[list[int]]) -> pa.ListArray:
    """Lists of int as one flat array and its bounds, which is much faster than value by value."""
    bounds = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
    flat = np.fromiter(chain.from_iterable(rows), np.int32, int(bounds[-1]))
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat))


def _schema(df: DataFrame, *names: str):
    return StructType([f for f in df.schema.fields if not names or f.name in names])
