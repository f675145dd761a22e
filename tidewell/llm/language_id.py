"""Language of texts by a linear-chain conditional random field over their words.

A word's features are affixes, character n-grams and what a lexicon says of it; labels are the
languages, with learned transitions. Forward-backward gives each word's marginals; a text's language
is the one with the largest sum of them.

The field is fitted on a bounded sample of labelled rows. Its sequences join stretches of words from
different rows, so that transitions learn that languages switch inside a text.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain, count, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from tidewell.llm.shipping import shipped, tidied

#: Labelled rows of each language that the field is fitted on, and characters of all rows times
#: languages, which is what fitting holds; but one row of every language.
SAMPLE_ROWS, SAMPLE_CELLS = 120, 1 << 26
#: Hashed features, rounds of fitting.
FEATURES, ROUNDS = 1 << 16, 40
#: Words a worker remembers the scores of, and numbers it holds of the words at hand; bound its memory.
CACHE, CELLS = 150_000, 1 << 22
UNKNOWN = "und"


def _class(kind: str, points: Iterable[int]) -> str:
    """The characters of a Unicode category, as ranges for a regular expression."""
    found = [c for c in points if unicodedata.category(chr(c))[0] == kind]
    runs = [list(run) for _, run in groupby(found, key=lambda c, n=count(): c - next(n))]
    return "".join(f"\\U{run[0]:08x}-\\U{run[-1]:08x}" for run in runs)


#: A longer run of letters is consecutive words of so many, so that all of it is read.
LONGEST = 40


def _pattern(*points: range) -> re.Pattern[str]:
    letters, marks = (_class(kind, chain(*points)) for kind in "LM")
    return re.compile(f"[{letters}][{letters}{marks}]{{0,{LONGEST - 1}}}")


class _Words:
    """Letters, and marks after them; number signs such as a superscript two are no letters."""

    # Classes of the first 65,536 characters alone are far faster; most texts need no others.
    beyond = re.compile("[\U00010000-\U0010ffff]")
    few = _pattern(range(0x10000))
    # There are no letters or marks after these.
    every = _pattern(range(0x33000), range(0xE0000, 0xE1000))

    def findall(self, text: str) -> list[str]:
        return (self.every if self.beyond.search(text) else self.few).findall(text)

    def pieces(self, text: str, size: int) -> Iterator[str]:
        """`text` in pieces of at most `size` characters (more than LONGEST) that cut no word."""
        at = 0
        while len(text) - at > size:
            piece = text[at : at + size]
            last = None
            for last in (self.every if self.beyond.search(piece) else self.few).finditer(piece):
                pass
            # A word that touches the cut may go on behind it.
            end = last.start() if last and last.end() == size else size
            yield piece[:end]
            at += end
        yield text[at:]


WORDS = _Words()
_BLOCK = 32


def features(word: str, lexicon: dict[str, str]) -> list[int]:
    """Hashed features of one word as it is written."""
    low = word.lower()
    plain = low.isascii()  # cuts of its bytes are those of its characters: one encoding does
    text, p, s, edged = (low.encode(), b"p", b"s", f"<{low}>".encode()) if plain else (low, "p", "s", f"<{low}>")
    names = [p + text[:k] for k in (1, 2, 3)] + [s + text[-k:] for k in (1, 2, 3, 4)]
    names += [edged[i : i + k] for k in (2, 3) for i in range(len(edged) - k + 1)]
    if not plain:
        names = [n.encode() for n in names]
    if low in lexicon:
        names.append(f"l{lexicon[low]}".encode())
    names.append(b"bias")
    return [zlib.crc32(n) % FEATURES for n in names]


@dataclass
class Field:
    """A fitted field: languages in order, feature weights, transition scores, and the lexicon."""

    languages: list[str]
    weights: np.ndarray
    transitions: np.ndarray
    lexicon: dict[str, str]


# -- forward and backward -------------------------------------------------------


def _marginals(scores: np.ndarray, mask: np.ndarray, step: np.ndarray, start: np.ndarray, stop: np.ndarray):
    """Forward and backward values of rows of words, each row between a start and a stop vector.

    scores: (rows, words, labels), positive. Each vector is scaled to a sum of one.
    """
    n, length, k = scores.shape
    ahead, back = np.empty((length + 1, n, k)), np.empty((length + 1, n, k))
    ahead[0], back[length] = start, stop
    for t in range(length):
        new = (ahead[t] @ step) * scores[:, t]
        new /= new.sum(1, keepdims=True)
        ahead[t + 1] = np.where(mask[:, t, None], new, ahead[t])
    for t in range(length - 1, -1, -1):
        new = (back[t + 1] * scores[:, t]) @ step.T
        new /= new.sum(1, keepdims=True)
        back[t] = np.where(mask[:, t, None], new, back[t + 1])
    both = ahead[1:] * back[1:]
    both /= both.sum(2, keepdims=True)
    return ahead, back, both.transpose(1, 0, 2)


@dataclass
class _Chains:
    """Texts cut into blocks of words, each with the transfer matrix that carries messages over it.

    Only blocks, not words, follow one another in a text; the result is that of the whole chain.
    Text i has the rows bounds[i] to bounds[i + 1] of `scores`; a single block needs no matrix.
    """

    scores: np.ndarray
    bounds: np.ndarray
    step: np.ndarray

    def __post_init__(self) -> None:
        k = self.scores.shape[1]
        sizes = np.diff(self.bounds)
        self.counts = -(-sizes // _BLOCK)
        self.first = np.concatenate(([0], np.cumsum(self.counts)))
        total = int(self.first[-1])
        self.owner = np.repeat(np.arange(len(sizes)), self.counts)
        begins = self.bounds[self.owner] + (np.arange(total) - self.first[self.owner]) * _BLOCK
        places = begins[:, None] + np.arange(_BLOCK)
        self.mask = places < self.bounds[self.owner + 1][:, None]
        self.cut = self.scores[np.minimum(places, max(len(self.scores) - 1, 0))] if total else np.zeros((0, _BLOCK, k))
        carry = np.broadcast_to(np.eye(k), (total, k, k)).copy()
        for t in range(_BLOCK if total else 0):
            new = (carry.reshape(-1, k) @ self.step).reshape(total, k, k)
            new *= self.cut[:, t][:, None, :]
            if t % 4 == 3:  # often enough: each word's largest score is one
                new /= new.sum((1, 2), keepdims=True)
            np.copyto(carry, new, where=self.mask[:, t, None, None])
        self.carry = carry

    def over(self, before: np.ndarray) -> np.ndarray:
        """The message behind the only text, from that before it."""
        for matrix in self.carry:
            before = before @ matrix
            before = before / before.sum()
        return before

    def back_over(self, after: np.ndarray) -> np.ndarray:
        """The message before the only text, from that behind it."""
        for matrix in self.carry[::-1]:
            after = matrix @ after
            after = after / after.sum()
        return after

    def marginals(self, before: np.ndarray, after: np.ndarray, with_best: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Sums of the words' marginals, and, `with_best`, of each word's largest, for each text."""
        total, k = self.carry.shape[:2]
        out, best = np.zeros((len(self.counts), k)), np.zeros(len(self.counts))
        if not total:
            return out, best
        start, stop = np.tile(before, (total, 1)), np.tile(after, (total, 1))
        order = np.argsort(-self.counts, kind="stable")
        left = self.counts[order]
        for j in range(1, int(self.counts.max())):
            now = order[: np.searchsorted(-left, -j, side="left")]  # texts with more than j blocks
            at = self.first[now] + j
            vector = np.einsum("ni,nij->nj", start[at - 1], self.carry[at - 1])
            start[at] = vector / vector.sum(1, keepdims=True)
            at = self.first[now] + self.counts[now] - 1 - j
            vector = np.einsum("nij,nj->ni", self.carry[at + 1], stop[at + 1])
            stop[at] = vector / vector.sum(1, keepdims=True)
        _, _, found = _marginals(self.cut, self.mask, self.step, start, stop)
        found = np.where(self.mask[:, :, None], found, 0)
        if with_best:
            np.add.at(best, self.owner, found.max(2).sum(1))
        np.add.at(out, self.owner, found.sum(1))
        return out, best


def text_marginals(scores: np.ndarray, bounds: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Sums of marginals of each text. Text i has the rows bounds[i] to bounds[i + 1] of `scores`."""
    even = np.full(scores.shape[1], 1 / scores.shape[1])
    return _Chains(scores, bounds, step).marginals(even, even)[0]


# -- fitting --------------------------------------------------------------------------


def fit(rows: list[tuple[str, str]]) -> Field | None:
    """Maximum likelihood on (language, text) rows; None where there is no word to learn from."""
    languages = sorted({lang for lang, _ in rows})
    place = {lang: i for i, lang in enumerate(languages)}
    said = [(place[lang], WORDS.findall(text)) for lang, text in rows]
    counts: dict[str, Counter] = defaultdict(Counter)
    for label, words in said:
        for word in words:
            counts[word.lower()][label] += 1
    if not counts:
        return None
    lexicon = {}
    for word in counts:
        n = sum(counts[word].values())
        if n > 2:
            best, k = max(sorted(counts[word].items()), key=lambda x: x[1])
            lexicon[word] = f"{best}:{int(4 * k / n)}"

    random = np.random.default_rng(1)
    types: dict[str, int] = {}
    stretches = []
    for label, words in said:
        ids = [types.setdefault(w, len(types)) for w in words]
        at = 0
        while at < len(ids):
            n = int(random.integers(3, 16))
            stretches.append((label, ids[at : at + n]))
            at += n
    order = random.permutation(len(stretches))
    sequences = [order[i : i + 3] for i in range(0, len(order), 3)]
    length = 45
    words = np.zeros((len(sequences), length), np.int64)
    truth = np.full((len(sequences), length), -1)
    for row, parts in enumerate(sequences):
        at = 0
        for p in parts:
            label, ids = stretches[p]
            words[row, at : at + len(ids)] = ids
            truth[row, at : at + len(ids)] = label
            at += len(ids)
    mask = truth >= 0

    listed = [features(w, lexicon) for w in types]
    owner = np.repeat(np.arange(len(listed)), [len(x) for x in listed])
    flat = np.fromiter((f for x in listed for f in x), np.int64, len(owner))
    heads = np.concatenate(([0], np.cumsum([len(x) for x in listed])))[:-1]
    used, flat = np.unique(flat, return_inverse=True)

    k = len(languages)
    weights, transitions = np.zeros((len(used), k)), np.zeros((k, k))
    known = words[mask]
    aim = np.zeros((len(types), k))
    np.add.at(aim, (known, truth[mask]), 1)
    pairs = mask[:, 1:]
    seen = np.zeros((k, k))
    np.add.at(seen, (truth[:, :-1][pairs], truth[:, 1:][pairs]), 1)
    state = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(transitions), np.zeros_like(transitions)]
    for turn in range(1, ROUNDS + 1):
        scored = np.add.reduceat(weights[flat], heads)
        scored = np.exp(scored - scored.max(1, keepdims=True))[words]
        step = np.exp(transitions - transitions.max())
        even = np.full((len(sequences), k), 1 / k)
        ahead, back, found = _marginals(scored, mask, step, even, even)
        expected = np.zeros((len(types), k))
        for label in range(k):
            expected[:, label] = np.bincount(known, found[:, :, label][mask], len(types))
        per_type = aim - expected
        grown = np.empty_like(weights)
        for label in range(k):
            grown[:, label] = np.bincount(flat, per_type[owner, label], len(used))
        moves = np.zeros((k, k))
        for t in range(1, length):
            on = mask[:, t]
            a, b = ahead[t][on], (scored[:, t] * back[t + 1])[on]
            both = a[:, :, None] * step * b[:, None, :]
            moves += (both / both.sum((1, 2), keepdims=True)).sum(0)
        size = mask.sum()
        steps = (grown / size - 1e-6 * weights, (seen - moves) / size - 1e-6 * transitions)
        for i, (value, slope) in enumerate(zip((weights, transitions), steps, strict=True)):
            state[2 * i] = 0.9 * state[2 * i] + 0.1 * slope
            state[2 * i + 1] = 0.99 * state[2 * i + 1] + 0.01 * slope**2
            mean, spread = state[2 * i] / (1 - 0.9**turn), state[2 * i + 1] / (1 - 0.99**turn)
            value += 0.15 * mean / (np.sqrt(spread) + 1e-8)
    full = np.zeros((FEATURES, k), np.float32)
    full[used] = weights
    return Field(languages, full, transitions, lexicon)


def held_out(doc_id: Column) -> Column:
    """Rows kept for testing; a row without an id is not one of them."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def training_sample(labelled: DataFrame, rows: int = SAMPLE_ROWS) -> list[tuple[str, str]]:
    """At most `rows` whole texts of each language, fewer where SAMPLE_CELLS asks for it, at least one.

    Rows are chosen by a hash, but those longer than an eighth of their language's share of
    characters come last, the shortest of them first. Counts tell what share of each language's rows
    will do, so that only a few times as many rows as wanted are ranked.
    """
    labelled = labelled.filter("lang IS NOT NULL AND text IS NOT NULL")
    counted = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not counted:
        return []
    room = SAMPLE_CELLS // len(counted) ** 2
    share = F.create_map(*[F.lit(x) for lang, n in counted.items() for x in (lang, min(1.0, 8 * rows / n))])
    chance = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = labelled.withColumn("at", chance).filter(F.col("at") < share[F.col("lang")])
    drawn = drawn.withColumn("long", F.greatest(F.length("text"), F.lit(room // 8)))
    order = Window.partitionBy("lang").orderBy("long", "at", "doc_id")
    first = drawn.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= rows)
    read = F.sum(F.length("text")).over(Window.partitionBy("lang").orderBy("r"))
    chosen = first.withColumn("read", read).filter((F.col("r") == 1) | (F.col("read") <= room)).orderBy("lang", "r")
    return [(r["lang"], r["text"]) for r in chosen.select("lang", "text").collect()]


# -- prediction -----------------------------------------------------------------------


class Predictor:
    """Predicts with memory that depends on the number of languages alone, besides the texts given."""

    def __init__(self, field: Field) -> None:
        self.field = field
        self.step = np.exp(field.transitions - field.transitions.max())
        self.known: dict[str, int] = {}
        k = len(field.languages)
        self.scores = np.zeros((0, k), np.float32)
        self.even = np.full(k, 1 / k)
        #: Characters read at once: a block of words holds its scores and a matrix, a word two characters.
        self.piece = max(2 * LONGEST, 2 * _BLOCK * (CELLS // (k * max(k, _BLOCK))))
        self.cache = min(CACHE, 4 * CELLS // k)

    def _learn(self, new: list[str]) -> None:
        found = [self.scores]
        for at in range(0, len(new), 20_000):
            listed = [features(w, self.field.lexicon) for w in new[at : at + 20_000]]
            sizes = np.array([len(x) for x in listed])
            flat = np.fromiter((f for x in listed for f in x), np.int64, int(sizes.sum()))
            scored = np.empty((len(listed), self.scores.shape[1]), np.float32)
            heads = np.concatenate(([0], np.cumsum(sizes)))
            for i in range(0, len(listed), 4000):
                j = min(i + 4000, len(listed))
                part = self.field.weights[flat[heads[i] : heads[j]]]
                scored[i:j] = np.add.reduceat(part, heads[i:j] - heads[i])
            found.append(np.exp(scored - scored.max(1, keepdims=True)))
        for word in new:
            self.known[word] = len(self.known)
        self.scores = np.concatenate(found)

    def _chains(self, texts: list[str]) -> _Chains:
        said = [WORDS.findall(t) for t in texts]
        every = [w for words in said for w in words]
        new = list(set(every).difference(self.known))
        if len(self.known) + len(new) > self.cache:
            self.known, self.scores = {}, self.scores[:0]
            new = list(set(every))
        if new:
            self._learn(new)
        ids = np.fromiter(map(self.known.__getitem__, every), np.int64, len(every))
        bounds = np.concatenate(([0], np.cumsum([len(w) for w in said], dtype=np.int64)))
        return _Chains(self.scores[ids].astype(np.float64), bounds, self.step)

    def _long(self, text: str, sure: bool) -> tuple[np.ndarray, float, int]:
        """Sums of one text that is read in pieces: messages forward first, then piece by piece back."""
        ends, before = [], [self.even]
        for piece in WORDS.pieces(text, self.piece):
            ends.append(len(piece))
            before.append(self._chains([piece]).over(before[-1]))
        sums, best, n, after, end = np.zeros(len(self.even)), 0.0, 0, self.even, len(text)
        for length, start in zip(ends[::-1], before[-2::-1], strict=True):
            chains = self._chains([text[end - length : end]])
            found = chains.marginals(start, after, sure)
            sums, best, n = sums + found[0][0], best + float(found[1][0]), n + int(chains.bounds[-1])
            after, end = chains.back_over(after), end - length
        return sums, best, n

    def evidence(self, texts: list[str], sure: bool = True) -> list[tuple[str, float, float]]:
        """Language and score of each text, and, where `sure` is asked for, how far the words' best
        marginals are, on average, from uniform (0) to certain (1)."""
        out, at, k = [], 0, len(self.even)
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and size + len(texts[end]) <= self.piece:
                size += len(texts[end])
                end += 1
            if end == at:
                rows, end = [self._long(texts[at], sure)], at + 1
            else:
                chains = self._chains(texts[at:end])
                rows = zip(*chains.marginals(self.even, self.even, sure), np.diff(chains.bounds).tolist(), strict=True)
            for sums, best, n in rows:
                top = int(sums.argmax())
                far = (best / n - 1 / k) / (1 - 1 / k) if n and k > 1 else float(n > 0)
                score = min(1.0, float(sums[top] / n)) if n else 0.0
                out.append((self.field.languages[top] if n else UNKNOWN, score, far))
            at = end
        return out

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        """Language and score of each text."""
        return [found[:2] for found in self.evidence(texts, sure=False)]


def predict(docs: DataFrame, field: Field | None, evidence: bool = False) -> DataFrame:
    """`docs` as the column `document`, with lang_pred and score; only `text` is looked at.

    With `evidence` also `sure`, which tells a text in several clear languages from one in none.

    The language is `und` and the score 0 where the text is null or has no letter, and where nothing
    could be learned. Of equal languages the first in order wins. Empty tables, repeated rows and
    nulls in other columns need nothing special.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(field)  # as large as the features, whatever the input

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predictor = Predictor(sent.value) if sent.value else None
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                part = batch.slice(at, 100)
                texts = [t or "" for t in part.column("document").field("text").to_pylist()]
                found = [(UNKNOWN, 0.0, 0.0)] * len(texts)
                if predictor:
                    found = predictor.evidence(texts, evidence)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("document"),
                        pa.array([f[0] for f in found], pa.string()),
                        pa.array([f[1] for f in found], pa.float64()),
                        *([pa.array([f[2] for f in found], pa.float64())] if evidence else []),
                    ],
                    names=["document", "lang_pred", "score", *(["sure"] if evidence else [])],
                )
        predictor = None
        tidied()

    rows = shipped(docs).select(F.struct("*").alias("document"))
    schema = StructType([rows.schema["document"]]).add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(work, schema.add("sure", "double") if evidence else schema)


def learn(docs: DataFrame) -> Field | None:
    """Fits a field on `docs` (doc_id, text, lang) but the held-out rows."""
    return fit(training_sample(docs.select("doc_id", "text", "lang").filter(~held_out(F.col("doc_id")))))
