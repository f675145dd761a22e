"""Brute-force versions of the operators, on plain Python values."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = {i: i + 32 for i in range(65, 91)}


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def without_repeats(texts: list[str | None], window: int) -> list[tuple[int, int, str]]:
    words = [WORD.findall(t or "") for t in texts]
    starts = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if starts[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def contamination(texts, items, width=10):
    grams: dict[tuple, set] = {}
    for item, text in items:
        w = PLAIN.findall((text or "").translate(LOW))
        k = min(len(w), width)
        for i in range(len(w) - k + 1 if w else 0):
            grams.setdefault(tuple(w[i : i + k]), set()).add(item)
    widths = {len(g) for g in grams}
    out = []
    for text in texts:
        w, hit, found = PLAIN.findall((text or "").translate(LOW)), set(), set()
        for k in widths:
            for i in range(len(w) - k + 1):
                if tuple(w[i : i + k]) in grams:
                    hit.update(range(i, i + k))
                    found |= grams[tuple(w[i : i + k])]
        out.append((len(w), len(hit), sorted(str(f) for f in found if f is not None)))
    return out


def components(texts, shingle, percent):
    sets = []
    for t in texts:
        w = WORD.findall((t or "").translate(LOW))
        grams = {tuple(w[i : i + shingle]) for i in range(len(w) - shingle + 1)} or ({tuple(w)} if w else set())
        sets.append(grams)
    top = list(range(len(sets)))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(i), root(j)))
                top[y] = x
    return [(len(s), root(i)) for i, s in enumerate(sets)]


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _spans(text, pattern, good):
    return [(m.start(), m.end()) for m in re.finditer(pattern, text) if good(m)]


def _written(kinds):
    every = sorted((s, rank, e, kind) for rank, (kind, spans) in enumerate(kinds.items()) for s, e in spans)
    return ",".join(f"{kind}:{s}:{e}" for s, _, e, kind in every)


def personal(text: str | None):
    text = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    kinds = {
        "email": _spans(text, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": _spans(text, r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) < 256 for p in m.group().split("."))),
        "card": _spans(text, r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m)) <= 19 and _luhn(digits(m))),
        "phone": _spans(text, r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m)) <= 15),
    }
    return [len(v) for v in kinds.values()], _written(kinds)


def secrets(text: str | None):
    text = text or ""
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    kinds = {
        "assign": _spans(text, f"(?ai:{assign[: assign.index(')') + 1]}){assign[assign.index(')') + 1 :]}", lambda m: len(m.group(2)) >= 8),
        "access": _spans(text, r"AKIA[A-Z0-9]+", lambda m: len(m.group()) >= 16),
        "hex": _spans(text, r"[0-9a-f]+", lambda m: len(m.group()) >= 32),
    }
    return [len(v) for v in kinds.values()], _written(kinds)


def nearest(vectors: dict[int, list[float]], query: int, k: int):
    import numpy as np

    q = np.array(vectors[query], np.float64)
    scored = [(-float((np.array(v, np.float64) * q).sum()), i) for i, v in vectors.items() if i != query]
    return [(i, -s) for s, i in sorted(scored)[:k]]


LETTERS = re.compile(r"[^\W\d_]+|\d+")


def verdicts(said: list[str], urls: list[tuple[str, str, str | None]], split) -> list[str]:
    """Naive Bayes over (host, path, given) with all words of `said`; `split` makes a splitter of counts."""
    cut = split(Counter(w.lower() for text in said for w in re.findall(r"[^\W\d_]{2,}", text)))
    tokens = []
    for host, path, _ in urls:
        runs = LETTERS.findall(host)
        tokens.append([f"h:{w}" for r in runs for w in ([f"#{len(r)}"] if r.isdigit() else cut.split(r))])
        tokens[-1] += [f"p:#{len(r)}" if r.isdigit() else f"p:{r.lower()}" for r in LETTERS.findall(path)]
    seen = {"block": Counter(), "allow": Counter()}
    classes = Counter(g for _, _, g in urls if g)
    for (_, _, given), found in zip(urls, tokens, strict=True):
        if given:
            seen[given].update(found)
    size = len(set(seen["block"]) | set(seen["allow"])) + 1
    log = lambda kind, t: math.log((seen[kind][t] + 1) / (sum(seen[kind].values()) + size))
    prior = math.log((classes["block"] + 1) / (classes["allow"] + 1))
    return ["block" if prior + sum(log("block", t) - log("allow", t) for t in found) > 1e-9 else "allow" for found in tokens]


SPACED = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def middle_filled(key, text: str | None, unit: str, rate: int = 50, suffix_first: int = 80):
    """(n, form, prefix_chars, middle_chars, output) by slices of Python text."""
    text = text or ""
    h = sha(f"42:{'' if key is None else key}")
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in range(0, 32, 8))
    units = SPACED.findall(text) if unit == "tokens" else list(text)
    a, b = sorted(h % (len(units) + 1) for h in (h1, h2))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return len(units), "plain", None, None, text
    if h4 % 100 < suffix_first:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def folds(digests: list[str]) -> tuple[str, list[str]]:
    """The root over some digests, eight to a node, and the siblings of each from its level upwards."""
    if len(digests) == 1:
        return digests[0], [""]
    runs = [digests[i : i + 8] for i in range(0, len(digests), 8)]
    root, above = folds([sha("".join(r)) for r in runs])
    return root, ["".join(x for j, x in enumerate(r) if j != i) + above[n] for n, r in enumerate(runs) for i in range(len(r))]


def manifest(rows: list[tuple]) -> tuple[str, dict[tuple, list[tuple[str, str]]]]:
    """The root, and (subroot, all siblings) of each (group, key, digest)."""
    groups: dict = {}
    for group, key, digest in rows:
        groups.setdefault(group, []).append((key is not None, key or 0, digest, key))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    lower = {g: folds([d for *_, d, _ in sorted(groups[g], key=lambda r: r[:3])]) for g in order}
    root, above = folds([lower[g][0] for g in order])
    out: dict = {}
    for g, rest in zip(order, above, strict=True):
        for (_, _, digest, key), own in zip(sorted(groups[g], key=lambda r: r[:3]), lower[g][1], strict=True):
            out.setdefault((g, key, digest), []).append((lower[g][0], own + rest))
    return root, out
