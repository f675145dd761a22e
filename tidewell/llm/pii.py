"""Personal data by weak supervision: labelers vote, EM weighs them, a span classifier decides.

Candidates come from patterns, strict and loose. Labelers of three sorts, patterns with check sums,
gazetteers, and context, each vote yes, no or nothing. Expectation-maximisation over the counts of
vote patterns estimates how reliable each labeler is and how likely each pattern is personal data.
A naive Bayes span classifier is then fitted on all candidates' features with these likelihoods as
soft labels, and decides what is added to the strict findings. Built-in functions only; what comes
to the driver are counts of vote patterns and feature values, bounded by their number of kinds.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm import spans
from tidewell.session import materialize

# Fixed values of the contract: the kinds in order, and their patterns. Repeats of groups are
# possessive and quantifiers start at the least length that counts; what matches is the same.
_LOCAL = r"[A-Za-z0-9._%+-]"
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]+\.[0-9]+\.[0-9]+"
CARD = r"[0-9](?:[\x20-]?[0-9]){13,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

#: The method's own kinds: numbers as they are written down without the strict forms' marks.
LOOSE = {
    "local_phone": r"(?<![0-9A-Za-z+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z])",
    "national_id": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "account": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
}

# Gazetteers: words that stand before personal data, and before numbers that are none.
_CUES = "phone|telephone|tel|call|mobile|cell|fax|contact|mail|email|ssn|social|security|iban|account|card|visa|ip|address"
_OTHERS = "version|isbn|issn|build|release|revision|order|invoice|serial|model|part|patent|figure|table|page|chapter"
_COUNTRIES = "AT|BE|CH|CZ|DE|DK|ES|FI|FR|GB|IE|IT|LU|NL|NO|PL|PT|SE"

LABELERS = ("form", "shape", "cue", "other", "place", "spread")
#: Rounds of expectation-maximisation; candidates at least this likely are added.
ROUNDS, LIKELY = 50, 0.5
#: Code points before and after a span that count as its context.
NEAR = 24


def _digits(body: Column) -> Column:
    return F.regexp_replace(body, "[^0-9]", "")


def passes_luhn(body: Column) -> Column:
    """The check sum of card numbers over the digits of `body`: from the right, every second doubled."""
    digits = F.transform(F.split(F.reverse(_digits(body)), ""), lambda d: F.try_to_number(d, F.lit("9")).cast("int"))
    total = F.aggregate(
        F.transform(
            digits,
            lambda d, i: F.when(i % 2 == 0, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d)),
        ),
        F.lit(0),
        lambda a, d: a + F.coalesce(d, F.lit(0)),
    )
    return total % 10 == 0


def _is_address(body: Column) -> Column:
    parts = F.split(body, r"\.")
    return F.forall(parts, lambda p: F.regexp_replace(p, "^0+(?=.)", "").rlike("^([0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$"))


def _between(n: Column, low: int, high: int) -> Column:
    return (n >= low) & (n <= high)


def base_kinds(text: Column) -> dict[str, Column]:
    """The strict findings of each kind, places in code points."""
    return {
        "email": spans.found(text, EMAIL, None, F.contains(text, F.lit("@"))),
        "ip": spans.found(text, IP, _is_address),
        "card": spans.found(text, CARD, lambda b: _between(F.length(_digits(b)), 14, 19) & passes_luhn(b)),
        "phone": spans.found(
            text, PHONE, lambda b: _between(F.length(_digits(b)), 10, 15), F.contains(text, F.lit("+"))
        ),
    }


def _candidates(docs: DataFrame) -> DataFrame:
    """row, doc_id, `base`, and every candidate with its context; no text is kept."""
    text = F.coalesce("text", F.lit(""))
    kinds = base_kinds(text)
    loose = {kind: spans.found(text, pattern) for kind, pattern in LOOSE.items()}
    # The strict patterns without their conditions: what fails them may still be personal data.
    loose["failed_card"] = spans.found(text, CARD, lambda b: ~passes_luhn(b))
    read = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        text.alias("text"),
        spans.of_kinds(kinds).alias("base"),
        spans.of_kinds(loose).alias("loose"),
        # Keeps what stands above from being pushed below, where searches would be made twice.
        F.monotonically_increasing_id().alias("row"),
    )
    apart = F.filter(
        "loose",
        lambda o: ~F.exists("base", lambda b: (b["start"] < o["end"]) & (b["end"] > o["start"])),
    )
    shown = F.transform(
        F.concat("base", apart),
        lambda s: F.struct(
            s["start"].alias("start"),
            (s["rank"] + F.when(s["kind"].isin(*kinds), 0).otherwise(len(kinds))).alias("rank"),
            s["end"].alias("end"),
            s["kind"].alias("kind"),
            s["body"].alias("body"),
            F.lower(F.substring(F.col("text"), F.greatest(s["start"] - NEAR, F.lit(0)) + 1, F.least(s["start"], F.lit(NEAR)))).alias("before"),
            F.lower(F.substring(F.col("text"), s["end"] + 1, F.lit(NEAR))).alias("after"),
        ),
    )
    return read.select("row", "doc_id", "base", F.when(F.size(F.concat("base", apart)) > 0, shown).alias("spans"))


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _votes(span: Column) -> dict[str, Column]:
    body, before, kind = span["body"], span["before"], span["kind"]
    n = F.length(_digits(body))
    cue = before.rlike(rf"\b({_CUES})\b[^a-z]*$")
    other = before.rlike(rf"\b({_OTHERS})\b[^a-z]*$")
    strict = kind.isin("email", "ip", "card", "phone")
    country = F.substring(body, 1, 2).rlike(f"^({_COUNTRIES})$")
    distinct = F.size(F.array_distinct(F.split(_digits(body), "")))
    return {
        "form": _vote(strict, kind == "failed_card"),  # the strict pattern and its check sum
        "shape": _vote(kind.isin("email", "ip") | _between(n, 9, 19), n > 19),
        "cue": _vote(cue, F.lit(False)),
        "other": _vote(F.lit(False), other),
        "place": _vote((kind == "account") & country, (kind == "account") & ~country),
        "spread": _vote((kind != "email") & (distinct > 4), (kind != "email") & (distinct < 3)),
    }


def _features(span: Column) -> list[Column]:
    """Names of feature values; one of each sort for each span."""
    last = F.regexp_extract(span["before"], r"([a-z]+)[^a-z]*$", 1)
    group = F.when(last.rlike(f"^({_CUES})$"), "cue").when(last.rlike(f"^({_OTHERS})$"), "other")
    edge = lambda c: F.when(c == "", "edge").when(c == " ", "space").when(c.rlike("[a-z]"), "letter").otherwise("mark")
    return [
        F.concat(F.lit("kind:"), span["kind"]),
        F.concat(F.lit("digits:"), F.least(F.length(_digits(span["body"])), F.lit(20)).cast("string")),
        F.concat(F.lit("word:"), group.otherwise("none")),
        F.concat(F.lit("before:"), edge(F.substring(span["before"], -1, 1))),
        F.concat(F.lit("after:"), edge(F.substring(span["after"], 1, 1))),
    ]


def reliabilities(counts: dict[tuple[int, ...], int]) -> tuple[dict[tuple[int, ...], float], list[dict[int, tuple[float, float]]]]:
    """EM over counts of vote patterns: how likely each is personal data, and each labeler's rates.

    A labeler's rates are, for each vote, how often it is given to personal data and to other spans.
    It starts from the majority of votes. With no candidates both are empty.
    """
    if not counts:
        return {}, []
    likely = {p: min(0.95, max(0.05, 0.5 + sum(p) / (2 * len(p)))) for p in counts}
    n = len(next(iter(counts)))
    rates: list[dict[int, tuple[float, float]]] = []
    for _ in range(ROUNDS):
        share = sum(likely[p] * c for p, c in counts.items())
        total = sum(counts.values())
        prior = min(0.98, max(0.02, share / total))
        rates = []
        for j in range(n):
            seen = {v: [1.0, 1.0] for v in (-1, 0, 1)}
            for p, c in counts.items():
                seen[p[j]][0] += likely[p] * c
                seen[p[j]][1] += (1 - likely[p]) * c
            sums = [sum(s[i] for s in seen.values()) for i in (0, 1)]
            rates.append({v: (s[0] / sums[0], s[1] / sums[1]) for v, s in seen.items()})
        for p in counts:
            odds = math.log(prior / (1 - prior)) + sum(math.log(rates[j][v][0] / rates[j][v][1]) for j, v in enumerate(p))
            likely[p] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return likely, rates


def _span_odds(each: DataFrame, likely: dict[tuple[int, ...], float]) -> tuple[float, dict[str, float]]:
    """Naive Bayes over feature values with soft labels: prior odds, and log odds of each value."""
    counted = each.select("votes", F.explode("features").alias("feature")).groupBy("votes", "feature").count().collect()
    yes: dict[str, float] = {}
    no: dict[str, float] = {}
    for r in counted:
        p = likely[tuple(r["votes"])]
        yes[r["feature"]] = yes.get(r["feature"], 0.5) + p * r["count"]
        no[r["feature"]] = no.get(r["feature"], 0.5) + (1 - p) * r["count"]
    sorts = {f.split(":")[0] for f in yes}
    all_yes = {s: sum(v for f, v in yes.items() if f.startswith(s + ":")) for s in sorts}
    all_no = {s: sum(v for f, v in no.items() if f.startswith(s + ":")) for s in sorts}
    odds = {f: math.log(yes[f] / all_yes[f.split(":")[0]]) - math.log(no[f] / all_no[f.split(":")[0]]) for f in yes}
    kinds = sum(v for f, v in yes.items() if f.startswith("kind:")), sum(v for f, v in no.items() if f.startswith("kind:"))
    return (math.log(kinds[0] / kinds[1]) if min(kinds) > 0 else 0.0), odds


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, base, all_spans.

    `base` are the strict findings; `all_spans` those and the candidates that the classifier takes
    for personal data, as lists of (start, rank, end, kind, body), by start. Added spans do not
    overlap strict ones; added spans of different kinds may overlap one another, and each is given.

    A null text is empty; a null doc_id is kept; repeated rows give repeated rows; an empty table
    gives an empty table. Other columns are not read.
    """
    read = materialize(_candidates(docs), "candidates")
    each = read.select("row", F.explode("spans").alias("span")).select(
        "row",
        "span",
        F.array(*_votes(F.col("span")).values()).alias("votes"),
        F.array(*_features(F.col("span"))).alias("features"),
    )
    each = materialize(each, "votes")
    counts = {tuple(r["votes"]): r["count"] for r in each.groupBy("votes").count().collect()}
    likely, _ = reliabilities(counts)
    prior, odds = _span_odds(each, likely)
    score = F.lit(prior)
    if odds:
        table = F.create_map(*[F.lit(x) for f, o in sorted(odds.items()) for x in (f, o)])
        score = score + F.aggregate("features", F.lit(0.0), lambda a, f: a + F.coalesce(table[f], F.lit(0.0)))
    strict = F.col("span.kind").isin("email", "ip", "card", "phone")
    taken = each.filter(strict | (score > math.log(LIKELY / (1 - LIKELY))))
    plain = F.struct(*[F.col(f"span.{c}").alias(c) for c in ("start", "rank", "end", "kind", "body")])
    by_row = taken.groupBy("row").agg(F.array_sort(F.collect_list(plain)).alias("all_spans"))
    none = F.expr("cast(array() AS array<struct<start: int, rank: int, end: int, kind: string, body: string>>)")
    return read.select("row", "doc_id", "base").join(by_row, "row", "left").select(
        "doc_id", "base", F.coalesce("all_spans", none).alias("all_spans")
    )
