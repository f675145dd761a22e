"""Fill-in-middle: texts cut in prefix, middle and suffix, which are put in the order a model learns from.

Texts are cut as UTF-8. Of each block of texts a sparse index holds the characters of several bytes
alone: where each lies and how many bytes over one it and those before it have. A search in it turns
byte cuts into code points and back; between two of its entries a span is ASCII, where both differ by
a constant. So nothing is kept, or scanned again, for each character.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm import words as W
from tidewell.llm.shipping import shipped

#: Marks that stand before each part.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of a hundred texts, how many are rearranged, and how many of these with the suffix first.
RATE, SUFFIX_FIRST = 50, 80
SEED = 42
PLAIN, PSM, SPM = "plain", "psm", "spm"
TOKENS, CHARACTERS = "tokens", "characters"


@dataclass
class Exceptions:
    """The characters of several bytes in some UTF-8 data, in order."""

    at: np.ndarray  # byte where each starts
    excess: np.ndarray  # bytes over one of all before it, and of all at the end

    @classmethod
    def of(cls, raw: np.ndarray) -> Exceptions:
        at = np.flatnonzero(raw >= 0xC0)
        lead = raw[at]
        sizes = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        return cls(at, np.concatenate(([0], np.cumsum(sizes))))

    def characters(self, cuts: np.ndarray) -> np.ndarray:
        """Code points before each byte cut; a cut lies between characters."""
        return cuts - self.excess[np.searchsorted(self.at, cuts)]

    def bytes(self, cuts: np.ndarray) -> np.ndarray:
        """Bytes before each cut that counts code points."""
        return cuts + self.excess[np.searchsorted(self.at - self.excess[:-1], cuts)]


def _token_ends(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the tokens of all texts, and how many there are before each text (and in all).

    Each text is followed by one byte, which is no part of it. A token is a word with the white
    space before it, or the white space at the end of a text.
    """
    space = W._IS_SPACE[raw]
    after = space.copy()
    after[:-1] = space[1:]
    last = bounds[1:] - 2  # of each text; of an empty one, the byte before it
    ends = ~space & after
    full = last >= bounds[:-1]
    ends[last[full]] = True
    ends = np.flatnonzero(ends) + 1
    return ends, np.searchsorted(ends, bounds, side="right")


def cut_places(texts: Sequence[bytes], draws: np.ndarray, unit: str = TOKENS):
    """Of each text: how many units, the bytes of prefix, and of prefix and middle, and the code points of both.

    `draws` holds two whole numbers for each text; each chooses one of the n + 1 places between units.
    """
    data = b"\n".join(texts) + b"\n"
    raw = np.frombuffer(data, np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    bounds = np.concatenate(([0], np.cumsum(sizes + 1)))
    starts, index = bounds[:-1], Exceptions.of(raw)
    first = index.characters(starts)
    if unit == TOKENS:
        ends, counts = _token_ends(raw, bounds)
        # A text's tokens end after its start and at its end at the latest.
        n = np.diff(counts)
    else:
        n = index.characters(starts + sizes) - first
    units = np.sort(draws % (n[:, None] + 1), axis=1)
    if unit == TOKENS:
        nth = np.append(ends, 0)[counts[:-1, None] + units - 1] if len(ends) else np.zeros_like(units)
        cuts = np.where(units > 0, nth, starts[:, None])
    else:
        cuts = index.bytes(first[:, None] + units)
    return n, cuts - starts[:, None], index.characters(cuts) - first[:, None]


def _drawn(key: str, seed: int, nth: int) -> Column:
    """The nth draw of a row: 32 bits of a hash of the seed and the key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * nth + 1, 8), 16, 10).cast("bigint")


def _form(rate: int, suffix_first: int) -> Column:
    text = F.coalesce(F.col("document.text"), F.lit(""))
    marked = text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE)
    plain = (F.length(text) == 0) | marked | (F.col("h3") % 100 >= rate)
    return F.when(plain, PLAIN).when(F.col("h4") % 100 < suffix_first, SPM).otherwise(PSM)


def _arranger(unit: str):
    mark = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]

    def arranged(text: bytes, form: str, a: int, b: int) -> bytes:
        if form == PLAIN:
            return text
        if form == PSM:
            return b"".join([mark[0], text[:a], mark[1], text[b:], mark[2], text[a:b]])
        return b"".join([mark[1], text[b:], mark[0], text[:a], mark[2], text[a:b]])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, forms = W.utf8(batch.column("document").field("text")), batch.column("form").to_pylist()
            draws = np.stack([batch.column(h).to_numpy() for h in ("h1", "h2")], axis=1)
            for first, last in W.blocks(texts):
                n, cuts, characters = cut_places(texts[first:last], draws[first:last], unit)
                form = forms[first:last]
                out = [arranged(*x) for x in zip(texts[first:last], form, *cuts.T.tolist(), strict=True)]
                plain = np.array([f == PLAIN for f in form])
                middle = characters[:, 1] - characters[:, 0]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("document").slice(first, last - first),
                        pa.array(n, pa.int64()),
                        pa.array(form, pa.string()),
                        pa.array(characters[:, 0], pa.int64(), mask=plain),
                        pa.array(middle, pa.int64(), mask=plain),
                        pa.array(out, pa.binary()).cast(pa.string()),
                    ],
                    names=["document", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    return work


def transform(
    docs: DataFrame,
    key: str = "doc_id",
    unit: str = TOKENS,
    rate: int = RATE,
    suffix_first: int = SUFFIX_FIRST,
    seed: int = SEED,
) -> DataFrame:
    """`docs` as the column `document`, with n, form, prefix_chars, middle_chars and output.

    A text is cut in two places between its n `unit`s (words with the white space before them, or
    code points), both drawn by a hash of `seed` and `key`. Form `psm` is prefix, suffix, middle, each
    after its mark; `spm` has the suffix first; `plain` is the text itself, for `100 - rate` of a
    hundred, for an empty one, and for one that holds a mark. For plain ones the counts of code points
    are null.

    A null text is an empty one; a null key draws as an empty text would, so rows with equal keys are
    cut alike. Texts of any length are cut whole. An empty table gives an empty table. Other columns
    are handed on inside `document`.
    """
    if unit not in (TOKENS, CHARACTERS):
        raise ValueError(f"no unit {unit}")
    rows = shipped(docs).select(
        F.struct("*").alias("document"),
        *[_drawn(key, seed, i).alias(f"h{i + 1}") for i in range(4)],
    )
    rows = rows.select("document", "h1", "h2", _form(rate, suffix_first).alias("form"))
    schema = rows.select("document").schema
    for name, kind in (
        ("n", "long"), ("form", "string"), ("prefix_chars", "long"), ("middle_chars", "long"), ("output", "string"),
    ):
        schema = schema.add(name, kind)
    return rows.mapInArrow(_arranger(unit), schema)


def restored(output: Column, form: Column) -> Column:
    """The text that was cut, from `output` and `form` alone.

    The marks of a rearranged text are the only ones in it, so each stands where it is first found.
    """

    def between(first: str, second: str) -> Column:
        from_mark = F.instr(output, F.lit(first)) + len(first)
        return F.substr(output, from_mark, F.instr(output, F.lit(second)) - from_mark)

    middle = F.substr(output, F.instr(output, F.lit(MIDDLE)) + len(MIDDLE))
    psm = F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), middle, between(SUFFIX, PREFIX))
    return F.when(form == PSM, psm).when(form == SPM, spm).otherwise(output)
