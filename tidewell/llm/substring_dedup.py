"""Exact repeats of word windows, across and inside documents, by fixed-block anchors.

A repeat of `window` words holds, in each of its places, a whole block of `anchor` = (window + 1) / 2
words that starts at a multiple of `anchor` in its document. So:

1. Index and probe. Every document's non-overlapping blocks are reference blocks; every rolling
   window of `anchor` words probes them. Both go, as hashes packed by bucket, to the task of their
   bucket. Hits are the windows whose hash some block has, and that occur more than once.
2. Extend. Each hit is extended to all windows of `window` words around it, and those that occur
   more than once, by 96 bits of hash, are repeats. Their union is that of all maximal repeats of
   `window` words and more.
3. Cut. The words they cover leave the text.

A hash that a third of all documents hold is sent once for each unit of half a million words: what
occurs twice in a unit is decided there: a bucket takes one entry of a hot passage for each unit. Rows
that are given more than once are set apart first; one of their copies stands for all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm import words as W
from tidewell.llm.copies import once
from tidewell.llm.shipping import shipped
from tidewell.session import materialize

WINDOW = 35
#: Words of a unit, and of a bucket on average; they bound a task's memory.
UNIT, BUCKET = 1 << 19, 4 << 20
LEAST_BUCKETS = 40

_PACKED = (
    "bucket int, keys binary, checks binary, counts binary, places binary, marks binary, more binary,"
    " done boolean"
)
_SPOTS = "k bigint, k2 int, places binary"


def _packed(bucket: int, keys, checks, counts, places, marks, more, done: bool) -> tuple:
    steps = np.diff(places, prepend=0)
    small = steps.astype(np.int16) if len(steps) == 0 or abs(steps).max() < 1 << 15 else steps.astype(np.int32)
    return (
        bucket, keys.tobytes(), checks.tobytes(), counts.astype(np.int32).tobytes(),
        bytes([small.itemsize]) + small.tobytes(), marks.tobytes(), more.tobytes(), done,
    )


def _unpacked(row: dict) -> tuple:
    raw = row["places"]
    places = np.cumsum(np.frombuffer(raw, f"i{raw[0]}", offset=1).astype(np.int64))
    return (
        np.frombuffer(row["keys"], np.int64),
        np.frombuffer(row["checks"], np.int32),
        np.frombuffer(row["counts"], np.int32),
        places,
    )


def _table(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), *[pa.binary()] * 6, pa.bool_()]
    names = ["bucket", "keys", "checks", "counts", "places", "marks", "more", "done"]
    columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
    )


class _Unit:
    """Hashes of windows of some documents, until they are packed by bucket."""

    def __init__(self, buckets: int, two: bool) -> None:
        self.buckets, self.two = buckets, two
        self.clear()

    def clear(self) -> None:
        self.keys: list[tuple[int, int]] = []
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, k: int, k2: int, places: np.ndarray, first: np.ndarray, second: np.ndarray, flags: np.ndarray):
        self.keys.append((k, k2))
        self.parts.append((places, first, second, flags))
        self.size += len(places)

    def rows(self) -> list[tuple]:
        """One row for each bucket; and one, marked as done, with what is known to repeat."""
        if not self.size:
            self.clear()
            return []
        keys = np.array([k for k, _ in self.keys], np.int64)
        checks = np.array([c for _, c in self.keys], np.int32)
        doc = np.repeat(np.arange(len(keys)), [len(p[0]) for p in self.parts])
        places, first, second, flags = (np.concatenate([p[i] for p in self.parts]) for i in range(4))
        self.clear()
        order = np.lexsort((second, first)) if self.two else np.argsort(first, kind="stable")
        a, b = first[order], second[order]
        new = np.ones(len(order), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        heads = np.flatnonzero(new)
        sizes = np.diff(np.append(heads, len(order)))
        repeated = np.sort(order[np.repeat(sizes > 1, sizes)])
        sent = order[heads]
        marked = np.maximum.reduceat(flags[order], heads)
        # In the order of documents and places, by bucket.
        back = np.argsort(sent, kind="stable")
        sent, marked = sent[back], marked[back]
        bucket = ((first[sent] >> np.uint64(32)) % np.uint64(self.buckets)).astype(np.int64)
        by = np.argsort(bucket, kind="stable")
        sent, marked, bucket = sent[by], marked[by], bucket[by]
        cuts = np.searchsorted(bucket, np.arange(self.buckets + 1))
        low = (first & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        out = []
        for n in range(self.buckets):
            mine = sent[cuts[n] : cuts[n + 1]]
            if not len(mine):
                continue
            docs, counts = np.unique(doc[mine], return_counts=True)
            if self.two:
                marks, more = first[mine], second[mine].astype(np.uint32)
            else:
                # The lowest bit says whether it is a reference block.
                marks, more = low[mine] & np.uint32(0xFFFFFFFE) | marked[cuts[n] : cuts[n + 1]].astype(np.uint32), low[:0]
            own = checks[docs] if self.two else checks[:0]
            out.append(_packed(n, keys[docs], own, counts, places[mine], marks, more, False))
        if len(repeated):
            docs, counts = np.unique(doc[repeated], return_counts=True)
            where = int(keys[0] % self.buckets)
            out.append(_packed(where, keys[docs], checks[docs] if self.two else checks[:0], counts, places[repeated], low[:0], low[:0], True))
        return out


def _prober(window: int, anchor: int, buckets: int):
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit = _Unit(buckets, two=False)
        for batch in batches:
            texts, keys = W.utf8(batch.column("text")), batch.column("k").to_pylist()
            for first, last in W.blocks(texts):
                words = W.words_of(texts[first:last])
                grams = W.rolling(words.hashes, anchor)
                bounds = words.bounds.tolist()
                for i in range(last - first):
                    a, b = bounds[i], bounds[i + 1]
                    if b - a < window:
                        continue
                    places = np.arange(b - a - anchor + 1)
                    own = grams[a : a + len(places)]
                    unit.add(keys[first + i], 0, places, own, own, places % anchor == 0)
                    if unit.size >= UNIT:
                        yield _table(unit.rows())
        yield _table(unit.rows())

    return probe


def _extender(window: int, anchor: int, buckets: int):
    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit = _Unit(buckets, two=True)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                texts = W.utf8(part.column("document").field("text"))
                keys, checks = part.column("k").to_pylist(), part.column("k2").to_pylist()
                hits = part.column("hits").to_pylist()
                for first, last in W.blocks(texts):
                    words = W.words_of(texts[first:last])
                    one, two = W.rolling(words.hashes, window), W.rolling(words.hashes, window, 1)
                    bounds = words.bounds.tolist()
                    for i in range(last - first):
                        n = bounds[i + 1] - bounds[i] - window + 1
                        if n < 1:
                            continue
                        spots = np.concatenate([np.frombuffer(h, np.int32) for h in hits[first + i]])
                        near = np.zeros(n + anchor + 1, np.int32)
                        spots = spots[spots < n + anchor]
                        np.add.at(near, np.maximum(spots - anchor + 1, 0), 1)
                        np.add.at(near, np.minimum(spots + 1, n + anchor), -1)
                        places = np.flatnonzero(np.cumsum(near)[:n] > 0)
                        at_word = places + bounds[i]
                        second = two[at_word] >> np.uint64(32)
                        unit.add(keys[first + i], checks[first + i], places, one[at_word], second, np.zeros(len(places), bool))
                        if unit.size >= UNIT:
                            yield _table(unit.rows())
        yield _table(unit.rows())

    return extend


def _finder(two: bool):
    """A bucket's rows to the places, by document, of what occurs more than once in it."""

    def find(key: tuple, group: pa.Table) -> pa.Table:
        keys, checks, places, marks, more = [], [], [], [], []
        ready: list[tuple[np.ndarray, ...]] = []
        for row in group.to_pylist():
            own, check, counts, at = _unpacked(row)
            owner = np.repeat(own, counts)
            second = np.repeat(check, counts) if two else np.zeros(len(owner), np.int32)
            if row["done"]:
                ready.append((owner, second, at))
                continue
            keys.append(owner)
            checks.append(second)
            places.append(at)
            marks.append(np.frombuffer(row["marks"], np.uint64 if two else np.uint32))
            more.append(np.frombuffer(row["more"], np.uint32))
        if keys:
            mark = np.concatenate(marks)
            plain = mark if two else mark & np.uint32(0xFFFFFFFE)
            rest = np.concatenate(more) if two else plain[:0]
            order = np.lexsort((rest, plain)) if two else np.argsort(plain, kind="stable")
            s = plain[order]
            new = np.ones(len(order), bool)
            new[1:] = s[1:] != s[:-1]
            if two:
                r = rest[order]
                new[1:] |= r[1:] != r[:-1]
            heads = np.flatnonzero(new)
            sizes = np.diff(np.append(heads, len(order)))
            good = sizes > 1
            if not two and len(heads):
                good &= np.bitwise_or.reduceat(mark[order] & np.uint32(1), heads) > 0
            hit = order[np.repeat(good, sizes)]
            if len(hit):
                ready.append(tuple(np.concatenate(x)[hit] for x in (keys, checks, places)))
        out: list[list] = [[], [], []]
        if ready:
            k, k2, at = (np.concatenate([x[i] for x in ready]) for i in range(3))
            order = np.lexsort((at, k2, k))
            k, k2, at = k[order], k2[order], at[order].astype(np.int32)
            heads = np.flatnonzero(np.append(True, (k[1:] != k[:-1]) | (k2[1:] != k2[:-1])))
            out = [k[heads].tolist(), k2[heads].tolist(), [x.tobytes() for x in np.split(at, heads[1:])]]
        return pa.table(
            [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.binary()), strict=True)],
            names=["k", "k2", "places"],
        )

    return find


def _cutter(window: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                texts, checks = W.utf8(part.column("document").field("text")), part.column("k2").to_pylist()
                found = part.column("repeats").to_pylist()
                n_words, n_removed, kept = [], [], []
                for first, last in W.blocks(texts):
                    words = W.words_of(texts[first:last])
                    bounds = words.bounds.tolist()
                    for i in range(last - first):
                        a, b = bounds[i], bounds[i + 1]
                        cover = np.zeros(b - a + 1, np.int64)
                        for spot in found[first + i] or ():
                            if spot["k2"] == checks[first + i]:
                                starts = np.frombuffer(spot["places"], np.int32)
                                np.add.at(cover, starts, 1)
                                np.add.at(cover, starts + window, -1)
                        keep = np.cumsum(cover)[: b - a] == 0
                        n_words.append(b - a)
                        n_removed.append(int(b - a - keep.sum()))
                        kept.append(words.joined(keep, a, b))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("document"),
                        pa.array(n_words, pa.int64()),
                        pa.array(n_removed, pa.int64()),
                        pa.array(kept, pa.binary()).cast(pa.string()),
                    ],
                    names=["document", "n_words", "n_removed", "kept_text"],
                )

    return cut


def _clearer(window: int):
    """Rows that are given more than once: all of their windows repeat, and cover all of their words."""

    def clear(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                texts = W.utf8(part.column("document").field("text"))
                n_words, kept = [], []
                for first, last in W.blocks(texts):
                    words = W.words_of(texts[first:last])
                    for a, b in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist(), strict=True):
                        n_words.append(b - a)
                        kept.append(words.joined(np.full(b - a, b - a < window), a, b))
                removed = [n if n >= window else 0 for n in n_words]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("document"),
                        pa.array(n_words, pa.int64()),
                        pa.array(removed, pa.int64()),
                        pa.array(kept, pa.binary()).cast(pa.string()),
                    ],
                    names=["document", "n_words", "n_removed", "kept_text"],
                )

    return clear


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """`docs` as the column `document`, with n_words, n_removed and kept_text.

    Words are runs without ASCII white space. A word goes if a window of `window` words that covers
    it also starts anywhere else; what is kept is joined by one space.

    A null text has no words, and kept_text is then empty; a text of fewer words than a window keeps
    all. Repeated rows repeat each other, so they lose their windows. A null doc_id, or one given to
    several texts, is no matter: documents are told apart by id and text. An empty table gives an
    empty table. Other columns are handed on inside `document`.
    """
    if window < 3 or window % 2 == 0:
        raise ValueError("a window has an odd number of words, three at least")
    anchor = (window + 1) // 2
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, size // (6 * BUCKET))
    rows = shipped(docs).select(
        F.struct("*").alias("document"),
        F.xxhash64("doc_id", "text").alias("k"),
        F.hash("text").alias("k2"),
    )
    # A row that is given again repeats itself from end to end; of its copies one is compared with others.
    keyed, again = once(rows, ["k", "k2"])
    texts = docs.select(F.xxhash64("doc_id", "text").alias("k"), F.col("text").alias("text"))
    if again is not None:
        texts = keyed.select("k", F.col("document.text").alias("text"))
        copied = again.groupBy("k", "k2").agg(F.count("*").alias("n")).filter("n > 1").select("k", "k2")
        copied = materialize(copied, "copied")
        whole = rows.join(copied, ["k", "k2"], "left_semi")
        rows = rows.join(copied, ["k", "k2"], "left_anti")
    probed = texts.mapInArrow(_prober(window, anchor, buckets), _PACKED)
    hits = probed.groupBy("bucket").applyInArrow(_finder(two=False), _SPOTS)
    by_document = hits.groupBy("k").agg(F.collect_list("places").alias("hits"))
    extended = (
        keyed.join(by_document, "k")
        .select("document", "k", "k2", "hits")
        .mapInArrow(_extender(window, anchor, buckets), _PACKED)
    )
    repeats = extended.groupBy("bucket").applyInArrow(_finder(two=True), _SPOTS)
    marks = repeats.groupBy("k").agg(F.collect_list(F.struct("k2", "places")).alias("repeats"))
    marked = rows.join(marks, "k", "left").select("document", "k", "k2", "repeats")
    schema = rows.select("document").schema
    for name, kind in (("n_words", "long"), ("n_removed", "long"), ("kept_text", "string")):
        schema = schema.add(name, kind)
    found = marked.mapInArrow(_cutter(window), schema)
    if again is None:
        return found
    return found.unionByName(whole.mapInArrow(_clearer(window), schema))
