"""Merge-type (BPE) sentencepiece encoding by backtracking, exact, without the library's encoder.

A text is escaped as the model says (a space before it, spaces as U+2581) and cut where no piece can
reach across. Each part is then tokenised from left to right:

1. Aho-Corasick gives, in one pass, the longest piece that starts at each place.
2. The longest piece is taken that is compatible with the token before it: the two, merged again from
   single characters, must give just these two. Else the next shorter prefix that is a piece is tried.
3. Where none is left the last token is given up and its place is marked in a bitfield as failed. The
   tokens up to a place are compatible in pairs, which only the true encoding up to there is; so no
   place need be reached a second time, and the work grows with the text alone.

A character that is no piece is encoded as its bytes.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterable, Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from tidewell.llm.bpe import _groups, _lists, _schema
from tidewell.llm.shipping import shipped, tidied

#: Parts of text (of this length at most), and pairs of tokens, that a worker remembers.
CACHE, LONGEST = 300_000, 64

SPACE = "▁"

# Fixed values of the model format: field numbers, kinds of pieces and of models.
_PIECES, _TRAINER, _NORMALIZER = 1, 2, 3
_PIECE, _SCORE, _KIND = 1, 2, 3
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6
_MODEL_TYPE, _SUFFIX, _BYTE_FALLBACK = 3, 24, 35
_CHARSMAP, _DUMMY_PREFIX, _EXTRA_WHITESPACE, _ESCAPE_WHITESPACE = 2, 3, 4, 5
_BPE = 2


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a message; four-byte values as bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
            continue
        size = varint() if key & 7 == 2 else 4 if key & 7 == 5 else 8
        yield key >> 3, data[at : at + size]
        at += size


class Model:
    """What encoding needs of a model file. Raises if the model has what this encoder does not do."""

    def __init__(self, data: bytes) -> None:
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.bytes: list[int] = [-1] * 256
        trainer: dict[int, int | bytes] = {}
        normalizer: dict[int, int | bytes] = {}
        number = 0
        for field, value in _fields(data):
            if field == _PIECES:
                found = dict(_fields(value))
                piece, kind = found[_PIECE].decode(), found.get(_KIND, _NORMAL)
                if kind == _NORMAL:
                    self.ids[piece] = number
                    self.scores[piece] = struct.unpack("<f", found.get(_SCORE, bytes(4)))[0]
                elif kind == _BYTE:
                    self.bytes[int(piece[3:5], 16)] = number
                elif kind not in (_UNKNOWN, _CONTROL):
                    raise ValueError("a model with user-defined or unused pieces")
                number += 1
            elif field == _TRAINER:
                trainer = dict(_fields(value))
            elif field == _NORMALIZER:
                normalizer = dict(_fields(value))
        if trainer.get(_MODEL_TYPE) != _BPE or trainer.get(_SUFFIX):
            raise ValueError("not a merge-type model with leading spaces")
        if not trainer.get(_BYTE_FALLBACK) or -1 in self.bytes:
            raise ValueError("a model without byte pieces")
        if normalizer.get(_CHARSMAP) or normalizer.get(_EXTRA_WHITESPACE, 1) or not normalizer.get(_ESCAPE_WHITESPACE, 1):
            raise ValueError("a model that normalises text")
        self.prefix = SPACE if normalizer.get(_DUMMY_PREFIX, 1) else ""
        self.cut = _cutter(self.ids)


def _cutter(pieces: Iterable[str]):
    """Cuts a text into parts that no piece reaches across, as far as the vocabulary allows."""
    whole = lambda text: [text] if text else []
    # Number signs that the class of letters would hold; others are in no piece, so they do not matter.
    signs = "".join(sorted({c for p in pieces for c in p if c.isalnum() and not c.isalpha() and not c.isdecimal()}))
    patterns = [
        f"{SPACE}*(?:[^\\W\\d_{signs}]+|(?:(?!{SPACE})[\\W\\d_{signs}])+)|{SPACE}+",  # words, what is between them
        f"{SPACE}*[^{SPACE}]+|{SPACE}+",  # before spaces only
    ]
    for pattern in patterns:
        cut = re.compile(pattern).findall
        if all(len(cut(p)) == 1 for p in pieces):
            return cut
    return whole


class Encoder:
    """Encodes by a model, with what it has seen remembered within bounds."""

    def __init__(self, model: Model) -> None:
        import ahocorasick

        self.model = model
        self.pieces = ahocorasick.Automaton()
        for piece in model.ids:
            self.pieces.add_word(piece, len(piece))
        self.pieces.make_automaton()
        #: The longest piece that each piece starts with; a single character has none.
        self.shorter = {p: next((n for n in range(len(p) - 1, 1, -1) if p[:n] in model.ids), 1) for p in model.ids if len(p) > 1}
        self.seen: dict[str, tuple[int, ...]] = {}
        #: Compatible or not, by the token before and the token.
        self.compatible: dict[str, dict[str, bool]] = {}
        self.pairs = 0

    def merged(self, text: str) -> list[str]:
        """The definition: the neighbours whose joined piece scores most, the leftmost first, are joined."""
        parts, scores = list(text), self.model.scores
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def fits(self, left: str, right: str) -> bool:
        """Whether the two tokens stay as they are when merged again; an empty `left` is the start."""
        if self.pairs >= CACHE:
            self.compatible.clear()
            self.pairs = 0
        fit = self.merged(left + right) == ([left, right] if left else [right])
        self.compatible.setdefault(left, {})[right] = fit
        self.pairs += 1
        return fit

    def tokens(self, text: str) -> list[str]:
        """The tokens of an escaped text."""
        shorter, after, size = self.shorter.get, self.compatible.get, len(text)
        longest = [1] * size + [0]
        for end, length in self.pieces.iter(text):
            start = end - length + 1
            if length > longest[start]:
                longest[start] = length
        failed = bytearray(size // 8 + 1)
        found: list[str] = []
        at, last, length = 0, "", longest[0]
        known = after("") or {}
        while at < size:
            while length:
                token = text[at : at + length]
                fit = known.get(token)
                if fit is None:
                    fit = self.fits(last, token)
                if fit:
                    end = at + length
                    if not failed[end >> 3] >> (end & 7) & 1:
                        found.append(token)
                        at, last, length = end, token, longest[end]
                        break
                length = shorter(token, 0)
            else:
                failed[at >> 3] |= 1 << (at & 7)
                token = found.pop()
                at -= len(token)
                last, length = found[-1] if found else "", shorter(token, 0)
            known = after(last) or {}
        return found

    def _ids(self, part: str) -> list[int]:
        ids, by_byte = self.model.ids, self.model.bytes
        tokens = self.tokens(part)
        try:
            return [ids[t] for t in tokens]
        except KeyError:  # characters that are no pieces
            return list(chain.from_iterable([ids[t]] if t in ids else [by_byte[b] for b in t.encode()] for t in tokens))

    def encode(self, texts: Iterable[str | None]) -> list[list[int]]:
        """The ids of whole texts; a null or empty one has none."""
        prefix, cut, seen = self.model.prefix, self.model.cut, self.seen
        parts = [cut(prefix + t.replace(" ", SPACE)) if t else [] for t in texts]
        new = set(chain.from_iterable(parts)).difference(seen)
        if len(seen) + len(new) > CACHE:
            seen.clear()
            new = set(chain.from_iterable(parts))
        for part in new:
            seen[part] = tuple(self._ids(part))
        get = seen.__getitem__
        out = [list(chain.from_iterable(map(get, p))) for p in parts]
        for part in new:
            if len(part) > LONGEST:
                del seen[part]
        return out


class Codec:
    def __init__(self, data: bytes) -> None:
        import sentencepiece

        self.encoder = Encoder(Model(data))
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=data)

    def decode(self, rows: list[list[int]]) -> list[str]:
        """By the library: pieces joined, bytes put together, spaces restored."""
        return self.processor.decode(rows) if rows else []


_CODECS: dict[int, Codec] = {}


def _codec(sent) -> Codec:
    """One for each worker process and model."""
    data = sent.value
    if hash(data) not in _CODECS:
        _CODECS[hash(data)] = Codec(data)
    return _CODECS[hash(data)]


def _sent(df: DataFrame, path: str):
    """The model file to all executors: as large as the vocabulary, whatever the input."""
    with open(path, "rb") as model:
        data = model.read()
    Model(data)  # raises here rather than in the tasks
    return df.sparkSession.sparkContext.broadcast(data)


def _texts(part: pa.RecordBatch) -> list[str | None]:
    return part.column("document").field("text").to_pylist()


def encode(docs: DataFrame, path: str) -> DataFrame:
    """`docs` as the column `document`, with `ids`: the piece ids of each whole `text`.

    No begin or end ids, no sampling. A null or empty text has no ids; a text of any length is encoded
    whole, in memory of a small multiple of its size. Repeated rows, null ids and an empty table need
    nothing special. `document` is a struct of all columns, so that no name clashes.
    """
    sent = _sent(docs, path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(sent)
        for batch in batches:
            for part in _groups(batch):
                ids = _lists(codec.encoder.encode(_texts(part)))
                yield pa.RecordBatch.from_arrays([part.column("document"), ids], names=["document", "ids"])
        tidied()

    rows = shipped(docs).select(F.struct("*").alias("document"))
    return rows.mapInArrow(work, _schema(rows).add("ids", ArrayType(IntegerType())))


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """`tokens` (with `ids`) and `decoded`: the text that the ids stand for, empty for none or null."""
    sent = _sent(tokens, path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(sent)
        for batch in batches:
            for part in _groups(batch):
                texts = codec.decode([row or [] for row in part.column("ids").to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, "decoded"]
                )

    return shipped(tokens).mapInArrow(work, _schema(tokens).add("decoded", "string"))


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """`encode` and `decode` in one worker: document, ids, and the text that they decode to."""
    sent = _sent(docs, path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(sent)
        for batch in batches:
            for part in _groups(batch):
                ids = codec.encoder.encode(_texts(part))
                columns = [part.column("document"), _lists(ids), pa.array(codec.decode(ids), pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["document", "ids", "decoded"])
        tidied()

    rows = shipped(docs).select(F.struct("*").alias("document"))
    return rows.mapInArrow(work, _schema(rows).add("ids", ArrayType(IntegerType())).add("decoded", "string"))
