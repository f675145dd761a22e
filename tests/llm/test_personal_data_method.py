"""What op5 adds to the strict findings: reliabilities, odds and decisions against plain Python."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.llm import pii

STRICT = ("email", "ip", "card", "phone")


def test_reliabilities_are_recovered():
    """Votes drawn with known rates: EM finds these rates and who is personal data, unlabelled."""
    rng = np.random.default_rng(11)
    rates = {1: [(0.7, 0.1, 0.2), (0.6, 0.3, 0.1), (0.8, 0.1, 0.1)], 0: [(0.1, 0.2, 0.7), (0.1, 0.4, 0.5), (0.15, 0.15, 0.7)]}
    truth = (rng.random(20_000) < 0.4).astype(int)
    votes = [tuple(int(rng.choice((1, 0, -1), p=p)) for p in rates[t]) for t in truth.tolist()]
    counts: dict = {}
    for v in votes:
        counts[v] = counts.get(v, 0) + 1
    likely, found = pii.reliabilities(counts)
    for j in range(3):
        for vote, place in ((1, 0), (0, 1), (-1, 2)):
            assert found[j][vote][0] == pytest.approx(rates[1][j][place], abs=0.05)
            assert found[j][vote][1] == pytest.approx(rates[0][j][place], abs=0.05)
    best = {t: [math.prod(rates[t][j][(1, 0, -1).index(x)] for j, x in enumerate(v)) for v in counts] for t in (0, 1)}
    for v, yes, no in zip(counts, best[1], best[0], strict=True):
        assert likely[v] == pytest.approx(0.4 * yes / (0.4 * yes + 0.6 * no), abs=0.12)


def test_nothing_to_learn_from():
    assert pii.reliabilities({}) == ({}, [])


def _votes(s) -> tuple:
    n, digits = len(re.findall("[0-9]", s.body)), set(re.findall("[0-9]", s.body))
    account = s.kind == "account"
    country = s.body[:2] in pii._COUNTRIES.split("|")
    return (
        1 if s.kind in STRICT else -1 if s.kind == "failed_card" else 0,
        1 if s.kind in ("email", "ip") or 9 <= n <= 19 else -1 if n > 19 else 0,
        1 if re.search(rf"\b({pii._CUES})\b[^a-z]*$", s.before) else 0,
        -1 if re.search(rf"\b({pii._OTHERS})\b[^a-z]*$", s.before) else 0,
        (1 if country else -1) if account else 0,
        0 if s.kind == "email" else 1 if len(digits) > 4 else -1 if len(digits) < 3 else 0,
    )


def _features(s) -> list:
    last = re.search(r"([a-z]+)[^a-z]*$", s.before)
    last = last[1] if last else ""
    word = "cue" if last in pii._CUES.split("|") else "other" if last in pii._OTHERS.split("|") else "none"
    edge = lambda c: "edge" if not c else "space" if c == " " else "letter" if "a" <= c <= "z" else "mark"
    n = min(20, len(re.findall("[0-9]", s.body)))
    return [("kind", s.kind), ("digits", n), ("word", word), ("before", edge(s.before[-1:])), ("after", edge(s.after[:1]))]


def _estimated(votes: list) -> list:
    """EM on the candidates themselves, not on counts of patterns."""
    p = np.array(votes)
    q = np.clip(0.5 + p.sum(1) / (2 * p.shape[1]), 0.05, 0.95)
    for _ in range(pii.ROUNDS):
        prior = min(0.98, max(0.02, float(q.mean())))
        odds = np.full(len(p), math.log(prior / (1 - prior)))
        for j in range(p.shape[1]):
            yes = np.array([1 + q[p[:, j] == v].sum() for v in (-1, 0, 1)])
            no = np.array([1 + (1 - q[p[:, j] == v]).sum() for v in (-1, 0, 1)])
            odds += np.log(yes / yes.sum() / (no / no.sum()))[p[:, j] + 1]
        q = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return q.tolist()


def _decided(candidates: list) -> list:
    """Whether each candidate is taken, by naive Bayes on soft labels."""
    likely = _estimated([_votes(s) for s in candidates])
    named = [_features(s) for s in candidates]
    weight = [{}, {}]
    for q, each in zip(likely, named, strict=True):
        for f in each:
            for side, w in zip(weight, (q, 1 - q), strict=True):
                side[f] = side.get(f, 0.5) + w
    share = lambda side, f: side[f] / sum(v for g, v in side.items() if g[0] == f[0])
    total = [sum(v for f, v in side.items() if f[0] == "kind") for side in weight]
    out = []
    for s, each in zip(candidates, named, strict=True):
        odds = math.log(total[0] / total[1]) + sum(math.log(share(weight[0], f) / share(weight[1], f)) for f in each)
        out.append(s.kind in STRICT or odds > math.log(pii.LIKELY / (1 - pii.LIKELY)))
    return out


def _texts() -> list[str]:
    rng = random.Random(12)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    local = lambda: f"{digits(3)}-{digits(3)}-{digits(4)}"
    kinds = [
        lambda: f"please call {local()} soon",
        lambda: f"mail a{digits(2)}@example.org or phone +49 {digits(10)}.",
        lambda: f"my ssn {digits(3)}-{digits(2)}-{digits(4)}",
        lambda: f"iban DE{digits(2)} {digits(4)} {digits(4)} {digits(4)}",
        lambda: f"serial 111-111-{digits(1) * 4}",
        lambda: f"see patent 1{'0' * 23}, figure",
        lambda: f"order ZZ{digits(2)} 0000 0000 0000",
        lambda: f"host 10.{int(digits(2))}.0.1 is up",
        lambda: "nothing here",
    ]
    return [" ".join(rng.choice(kinds)() for _ in range(rng.randint(0, 3))) for _ in range(400)]


def test_added_spans_are_those_of_plain_python(spark):
    rows = [*enumerate(_texts()), (None, "call 212-555-0187"), (900, None), (901, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    read = pii._candidates(docs).select("row", F.explode("spans").alias("s")).select("row", "s.*").collect()
    taken = _decided(read)
    want: dict = {}
    for s, yes in zip(read, taken, strict=True):
        if yes:
            want.setdefault(s.row, []).append((s.start, s.end, s.kind))
    texts = {r.row: r for r in pii._candidates(docs).select("row", "doc_id").collect()}
    expected = sorted((str(r.doc_id), sorted(want.get(row, []))) for row, r in texts.items())
    found = pii.personal_data(docs).collect()
    got = sorted((str(r.doc_id), sorted((s.start, s.end, s.kind) for s in r.all_spans)) for r in found)
    assert got == expected
    added = [s.kind for s, yes in zip(read, taken, strict=True) if yes and s.kind not in STRICT]
    left = [s.kind for s, yes in zip(read, taken, strict=True) if not yes]
    assert {"local_phone", "national_id", "account"} <= set(added)  # the method adds
    assert "failed_card" in left and len(left) > 20  # and does not add everything
