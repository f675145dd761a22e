"""Words of many texts at once, as 64-bit hashes in numpy arrays.

Texts are handled as UTF-8 in blocks of a few megabytes, so memory is bounded by one block or, if
that is longer, one text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np

BLOCK_BYTES = 1 << 20

_U = np.uint64
_RANDOM = np.random.default_rng(20240229)


def _odd() -> int:
    return int(_RANDOM.integers(1 << 62, 1 << 63)) * 2 + 1


_BYTE_BASE, _WORD_BASES = _odd(), (_odd(), _odd())
_BYTE_VALUES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64)
_FOLDED_VALUES = _BYTE_VALUES.copy()
_FOLDED_VALUES[65:91] = _BYTE_VALUES[97:123]
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


class _Powers:
    """Powers of an odd number and of its inverse modulo 2^64, extended when needed."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(0, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            for name, factor in (("up", self.base), ("down", self.inverse)):
                row = np.full(n, factor, np.uint64)
                row[0] = 1
                setattr(self, name, np.multiply.accumulate(row))
        return self.up[:n], self.down[:n]


_BYTE_POWERS, _WORD_POWERS = _Powers(_BYTE_BASE), tuple(map(_Powers, _WORD_BASES))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x ^= x >> _U(33)
    x *= _U(0xC4CEB9FE1A85EC53)
    x ^= x >> _U(33)
    return x


@dataclass
class Words:
    """The words of some texts in a row. Text i has words bounds[i] to bounds[i + 1]."""

    hashes: np.ndarray
    bounds: np.ndarray
    starts: np.ndarray  # of each word, in `data`
    ends: np.ndarray
    data: bytes

    def joined(self, keep: np.ndarray, first: int, last: int) -> bytes:
        """Words first to last for which `keep` holds, joined by one space."""
        s, e, data = self.starts[first:last][keep], self.ends[first:last][keep], self.data
        return b" ".join([data[a:b] for a, b in zip(s.tolist(), e.tolist(), strict=True)])


def words_of(texts: Sequence[bytes], fold: bool = False) -> Words:
    """Words are runs without space, tab, line feed, vertical tab, form feed and carriage return.

    `fold` makes A-Z and a-z alike. None is not a text; give b"" for it.
    """
    data = b"\n".join(texts) + b"\n"
    raw = np.frombuffer(data, np.uint8)
    space = _IS_SPACE[raw]
    change = np.flatnonzero(np.diff(space, prepend=True))
    starts, ends = change[::2], change[1::2]
    up, down = _BYTE_POWERS.get(len(raw))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((_FOLDED_VALUES if fold else _BYTE_VALUES)[raw] * up, out=sums[1:])
    hashes = mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    places = np.concatenate(([0], np.cumsum(lengths)))
    return Words(hashes, np.searchsorted(starts, places), starts, ends, data)


def rolling(hashes: np.ndarray, width: int, which: int = 0) -> np.ndarray:
    """A hash of each `width` consecutive words; `which` chooses one of two independent ones."""
    n = len(hashes)
    if n < width:
        return np.zeros(0, np.uint64)
    up, down = _WORD_POWERS[which].get(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * up, out=sums[1:])
    return mixed((sums[width:] - sums[:-width]) * down[: n - width + 1] + _U(width))


def blocks(texts: Sequence[bytes], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of up to `limit` bytes together, or of one longer text."""
    first, total = 0, 0
    for i, text in enumerate(texts):
        if total and total + len(text) > limit:
            yield first, i
            first, total = i, 0
        total += len(text) + 1
    if first < len(texts):
        yield first, len(texts)


def utf8(column) -> list[bytes]:
    """An Arrow string column as bytes; null becomes empty."""
    import pyarrow as pa

    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]
