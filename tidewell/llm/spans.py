"""Regular-expression findings in texts, with their places, in built-in functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What a list of findings holds; places are code points, the end is exclusive.
SPANS = "array<struct<start: int, end: int, body: string>>"


def found(
    text: Column, pattern: str, holds: Callable[[Column], Column] | None = None, quick: Column | None = None
) -> Column:
    """The leftmost non-overlapping matches of `pattern` for which `holds`, as SPANS.

    A match that does not hold is dropped and what it covers is not searched again. `pattern` has no
    capturing groups and, as Java runs it, must not recurse: possessive where it repeats a group.
    `quick` is a cheap test that every text with a match passes.

    Each match is taken with the text before it, and the tail as a last piece; so places are running
    sums of lengths, and one pass goes over the text.
    """
    whole = F.lit(rf"(?s)(.*?)(?:({pattern})|\z)")
    pieces = F.arrays_zip(
        F.regexp_extract_all(text, whole, F.lit(1)), F.regexp_extract_all(text, whole, F.lit(2))
    )
    none = F.array().cast(SPANS)

    def step(seen: Column, piece: Column) -> Column:
        gap, body = piece["0"], piece["1"]
        start = seen["at"] + F.length(gap)
        end = start + F.length(body)
        good = (body != "") if holds is None else (body != "") & holds(body)
        more = F.concat(
            seen["spans"], F.array(F.struct(start.alias("start"), end.alias("end"), body.alias("body"))).cast(SPANS)
        )
        return F.struct(end.alias("at"), F.when(good, more).otherwise(seen["spans"]).alias("spans"))

    begin = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    listed = F.aggregate(pieces, begin, step, lambda seen: seen["spans"])
    first = text.rlike(pattern) if quick is None else quick & text.rlike(pattern)
    return F.when(first, listed).otherwise(none)


def kind_of(spans: Column | str, rank: int, kind: str) -> Column:
    """(start, rank, end, kind, body) of findings."""
    return F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"),
            F.lit(rank).alias("rank"),
            s["end"].alias("end"),
            F.lit(kind).alias("kind"),
            s["body"].alias("body"),
        ),
    )


def of_kinds(kinds: dict[str, Column]) -> Column:
    """One list of (start, rank, end, kind, body) by start, then by the order of `kinds`."""
    lists = [kind_of(spans, rank, kind) for rank, (kind, spans) in enumerate(kinds.items())]
    return F.array_sort(F.concat(*lists))


def written(spans: Column) -> Column:
    """kind:start:end of each, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )
