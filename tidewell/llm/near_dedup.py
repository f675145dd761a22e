"""Near duplicates by MinHash: many universal hash minima, banding, verification, components.

1. Each text's set of word shingles is hashed; equal sets become one class.
2. 160 minima per class in 32 bands of 5. Of two sets with a similarity of 0.8, three in a million
   miss every band (0.6723^32); of 0.85, seven in a thousand million.
3. In each bucket of a band the classes are compared with the bucket's least class (linear in the
   bucket), first by signature, then on full sets. Buckets with the same classes are compared once.
4. Buckets that hold more than one component after that are searched in full: a class is compared
   with every class of another component, by an index over the bucket's shingles. Buckets of more
   than `chunk` classes are cut in chunks, and each two chunks are a task of their own; so no task
   grows with a bucket, no pair is emitted but the links that join components, and no link that
   would join two components is missed.
5. Components by alternating large-star and small-star over classes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm import words as W
from tidewell.llm.components import connected
from tidewell.llm.copies import once
from tidewell.llm.shipping import shipped
from tidewell.session import materialize

BANDS, ROWS = 32, 5
#: Classes compared in one task; bounds its memory.
CHUNK = 1024
#: A signature estimate this far below the threshold is over six standard deviations off.
SIGNATURE_SLACK = 25

_SEEDS = np.random.default_rng(7)
_FACTORS = _SEEDS.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADDENDS = _SEEDS.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
_BAND_FACTORS = _SEEDS.integers(1, 1 << 63, (BANDS, ROWS), dtype=np.uint64)


@dataclass(frozen=True)
class Rule:
    """What makes two documents near duplicates: `percent` of the union of `shingle`-word shingles."""

    shingle: int = 5
    percent: int = 80


def shingle_sets(texts: list[bytes], shingle: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a text with fewer words is one shingle."""
    out: list[np.ndarray] = []
    for first, last in W.blocks(texts):
        words = W.words_of(texts[first:last], fold=True)
        grams = W.rolling(words.hashes, shingle)
        for a, b in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist(), strict=True):
            if b - a >= shingle:
                out.append(np.unique(grams[a : b - shingle + 1]))
            else:
                out.append(W.rolling(words.hashes[a:b], b - a) if b > a else np.zeros(0, np.uint64))
    return out


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """Signatures of sets that are not empty: a row each, of multiply-shift hash minima."""
    out = np.empty((BANDS * ROWS, len(sets)), np.uint32)
    first = 0
    while first < len(sets):
        last, total = first, 0
        while last < len(sets) and (total == 0 or total + len(sets[last]) <= 1 << 16):
            total += len(sets[last])
            last += 1
        flat = np.concatenate(sets[first:last]) >> np.uint64(32)
        ends = np.cumsum([len(s) for s in sets[first:last]])
        starts = np.concatenate(([0], ends[:-1]))
        for i in range(BANDS * ROWS):
            hashed = flat * _FACTORS[i]
            hashed += _ADDENDS[i]
            out[i, first:last] = np.minimum.reduceat(hashed, starts) >> np.uint64(32)
        first = last
    return out.T


def _band_keys(signatures: np.ndarray) -> np.ndarray:
    cut = signatures.astype(np.uint64).reshape(-1, BANDS, ROWS)
    salted = (cut + np.uint64(1)) * _BAND_FACTORS
    keys = W.mixed(salted[:, :, 0])
    for r in range(1, ROWS):
        keys = W.mixed(keys * np.uint64(3) + salted[:, :, r])
    return keys.view(np.int64)


def _tagger(shingle: int):
    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 300):
                part = batch.slice(at, 300)
                sets = shingle_sets(W.utf8(part.column("text")), shingle)
                full = [i for i, s in enumerate(sets) if len(s)]
                bands: list = [None] * len(sets)
                if full:
                    keys = _band_keys(minima([sets[i] for i in full]))
                    for i, row in zip(full, keys, strict=True):
                        bands[i] = row
                prints = [hashlib.blake2b(s, digest_size=16).digest() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("h"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(prints, pa.binary()),
                        pa.array(bands, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "h", "n_shingles", "fp", "bands"],
                )

    return tag


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    small, large = sorted((len(a), len(b)))
    if 100 * small < percent * large:
        return False
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def _verifier(rule: Rule):
    """Rows (a, b, text_a, text_b) to the links among them; rows of one `a` usually follow each other."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ours, own = None, None, None
        for batch in batches:
            found: list[tuple[bytes, bytes]] = []
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                sets = shingle_sets(W.utf8(part.column("text_b")), rule.shingle)
                signs = minima(sets)
                firsts = part.column("a").to_pylist()
                for i, (a, b) in enumerate(zip(firsts, part.column("b").to_pylist(), strict=True)):
                    if a != key:
                        text = [part.column("text_a")[i].as_py().encode()]
                        key, (ours,) = a, shingle_sets(text, rule.shingle)
                        own = minima([ours])[0]
                    near = 100 * np.count_nonzero(own == signs[i])
                    if near < (rule.percent - SIGNATURE_SLACK) * len(own):
                        continue
                    if _linked(ours, sets[i], rule.percent):
                        found.append((a, b))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in found], pa.binary()) for k in (0, 1)], names=["a", "b"]
            )

    return verify


def _joins(prints: list[bytes], labels: list[bytes], sets: list[np.ndarray], percent: int):
    """Links that join what is not yet joined, of all links among these sets."""
    n = len(prints)
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(n), sizes)
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(flat, kind="stable")
    posting = owner[order]  # members by shingle
    heads = np.concatenate(([0], np.cumsum(np.bincount(flat))))
    mine = np.concatenate(([0], np.cumsum(sizes)))
    _, comp = np.unique(np.array(labels, dtype=object).astype("S32"), return_inverse=True)
    comp = comp.copy()
    for i in range(n):
        other = comp != comp[i]
        if not other.any():
            continue
        shared = np.zeros(n, np.int64)
        for s in flat[mine[i] : mine[i + 1]].tolist():
            shared[posting[heads[s] : heads[s + 1]]] += 1
        linked = np.flatnonzero(other & (100 * shared >= percent * (sizes + sizes[i] - shared)))
        for j in linked.tolist():
            if comp[j] != comp[i]:
                comp[comp == comp[j]] = comp[i]
                yield prints[i], prints[j]


def _searcher(rule: Rule):
    def search(key: tuple, group: pa.Table) -> pa.Table:
        # A document given twice has its text here twice.
        once = {fp: i for i, fp in enumerate(group.column("fp").to_pylist())}
        group = group.take(pa.array(sorted(once.values()), pa.int64()))
        sets = shingle_sets(W.utf8(group.column("text").combine_chunks()), rule.shingle)
        prints = group.column("fp").to_pylist()
        labels = [x.hex() for x in group.column("label").to_pylist()]
        found = list(_joins(prints, labels, sets, rule.percent)) if len(sets) > 1 else []
        return pa.table([pa.array([x[k] for x in found], pa.binary()) for k in (0, 1)], names=["a", "b"])

    return search


def _row_keys(docs: DataFrame) -> DataFrame:
    """doc_id, a hash of the text, and the text: what tells rows apart. A null id is no id."""
    return docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("h"), "text")


def near_duplicates(docs: DataFrame, rule: Rule = Rule(), chunk: int = CHUNK) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, h, n_shingles, component_id, fp, label.

    Words are runs without ASCII white space, A-Z lower-cased. h is xxhash64 of the text; fp stands
    for the shingle set, label for the component (the least fp in it).

    * A null text, or one without words, has no shingles: n_shingles 0, fp and label null,
      component_id its own doc_id.
    * A text with fewer words than a shingle has one shingle, the whole.
    * Repeated rows, and texts with equal sets, are linked. Ids given to several texts link nothing.
    * A null doc_id takes part, but is never the smallest; component_id is null where all are null.
    * An empty table gives an empty table. Other columns are not read.
    """
    rows = materialize(
        shipped(_row_keys(docs)).mapInArrow(
            _tagger(rule.shingle),
            "doc_id bigint, h bigint, n_shingles bigint, fp binary, bands array<bigint>",
        ),
        "shingled",
    )
    classes = materialize(
        rows.filter("fp IS NOT NULL")
        .groupBy("fp")
        .agg(
            F.min("doc_id").alias("least"),
            F.min(F.struct(F.coalesce("doc_id", F.lit(-(2**63))).alias("k"), "h")).alias("rep"),
            F.first("bands").alias("bands"),
        ),
        "classes",
    )
    labels = _labels(docs, classes, rule, chunk)
    # Each class with its component's least id; then each row with its class.
    joined = classes.select("fp", "least").join(labels, "fp", "left")
    joined = materialize(joined.withColumn("label", F.coalesce("label", "fp")), "class-labels")
    least = materialize(
        joined.groupBy("label").agg(F.min("least").alias("component_id")), "component-ids"
    )
    named = materialize(joined.join(least, "label").select("fp", "label", "component_id"), "named")
    found = rows.filter("fp IS NOT NULL").drop("bands").join(named, "fp")
    empty = rows.filter("fp IS NULL").drop("bands")
    empty = empty.withColumn("label", F.lit(None).cast("binary"))
    return found.unionByName(empty.withColumn("component_id", F.col("doc_id")))


def _labels(docs: DataFrame, classes: DataFrame, rule: Rule, chunk: int) -> DataFrame:
    """(fp, label) of the classes that are linked with another."""
    banded = classes.select(
        "fp", F.posexplode("bands").alias("band", "value")
    ).select("fp", F.xxhash64("band", "value").alias("bucket"))
    buckets = (
        banded.groupBy("bucket")
        .agg(
            F.count("*").alias("n"),
            F.min("fp").alias("pivot"),
            F.sum(F.xxhash64("fp").cast("decimal(20,0)")).alias("members"),
        )
        .filter("n > 1")
        .groupBy("n", "pivot", "members")  # one of the buckets with the same classes
        .agg(F.min("bucket").alias("bucket"))
        .select("bucket", "n", "pivot")
    )
    buckets = materialize(buckets, "buckets")
    members = materialize(banded.join(buckets, "bucket"), "members")

    wanted = materialize(members.select("fp").distinct(), "candidates")
    reps = wanted.join(classes.select("fp", "rep"), "fp").select("fp", "rep.k", "rep.h")
    reps = materialize(reps, "representatives")
    keyed = _row_keys(docs).select(
        F.coalesce("doc_id", F.lit(-(2**63))).alias("k"), "h", "text"
    )
    keyed = once(keyed, ["k", "h"])[0]
    # What is joined with texts grows with the corpus: it is merged at every size, never broadcast.
    texts = keyed.join(reps.hint("merge"), ["k", "h"]).select("fp", "text")
    texts = materialize(texts, "candidate-texts").hint("merge")

    pairs = members.filter("fp <> pivot").select(F.col("pivot").alias("a"), F.col("fp").alias("b"))
    pairs = materialize(pairs.distinct(), "pairs")
    theirs = pairs.join(texts.select(F.col("fp").alias("b"), F.col("text").alias("text_b")), "b")
    both = theirs.join(texts.select(F.col("fp").alias("a"), F.col("text").alias("text_a")), "a")
    links = materialize(both.mapInArrow(_verifier(rule), "a binary, b binary"), "links")
    labels = materialize(connected(links), "labels")

    # What is left: buckets of three and more whose classes are not all in one component.
    placed = materialize(
        members.filter("n > 2")
        .join(labels.withColumnRenamed("node", "fp"), "fp", "left")
        .select("bucket", "n", "fp", F.coalesce("label", "fp").alias("label")),
        "placed",
    )
    mixed = placed.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    mixed = materialize(mixed.filter("lo <> hi").select("bucket"), "mixed")
    chunks = F.ceil(F.col("n") / F.lit(chunk)).cast("int")
    spread = (
        placed.join(mixed, "bucket")
        .withColumn("own", F.pmod(F.xxhash64("fp"), chunks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
        .select(
            "fp",
            "label",
            "bucket",
            F.least("own", "other").alias("i"),
            F.greatest("own", "other").alias("j"),
        )
    )
    more = (
        spread.join(texts, "fp")
        .groupBy("bucket", "i", "j")
        .applyInArrow(_searcher(rule), "a binary, b binary")
    )
    every = links.unionByName(materialize(more, "more-links"))
    return connected(every).withColumnRenamed("node", "fp")


def one_of_each(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """`docs` with one row of each component: the least doc_id (null last), then text order.

    Rows without words are linked with nothing and stay. Columns are those of `docs`.
    """
    found = near_duplicates(docs, rule)
    best = (
        found.filter("label IS NOT NULL")
        .groupBy("label")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")).alias("best"))
        .select("best.doc_id", "best.h")
    )
    best = materialize(best, "kept-documents").select(
        F.coalesce("doc_id", F.lit(-(2**63))).alias("_k"), F.col("h").alias("_h")
    )
    rows = docs.select(F.struct("*").alias("_row")).select(
        "_row",
        F.coalesce(F.col("_row.doc_id").cast("bigint"), F.lit(-(2**63))).alias("_k"),
        F.xxhash64("_row.text").alias("_h"),
    )
    has_word = F.coalesce(F.col("_row.text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    # The same row may be given more than once: one stays. It is where the join has put it.
    kept = rows.filter(has_word).join(best, ["_k", "_h"]).dropDuplicates(["_k", "_h"])
    return kept.select("_row.*").unionByName(rows.filter(~has_word).select("_row.*"))
