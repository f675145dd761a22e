"""URL filter: explicit rules first, then naive Bayes over words of the host and tokens of the path.

Host names are words run together; a unigram model of words splits them by Viterbi. The words come
from the text, the links and the URL path of all pages; each run of letters in a host is sent with
those of its substrings that are words. The classifier is multinomial naive Bayes, fitted on the URLs
that the rules decide, all of them. Its odds are a table that is joined to the tokens of the URLs, so
neither model has to fit a worker.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.shipping import shipped
from tidewell.session import materialize

ALLOW, BLOCK = "allow", "block"
#: Letters of a word of the word model, and runs that a splitter remembers.
SHORTEST, LONGEST, CACHE = 2, 24, 100_000
#: Odds are summed as whole numbers of this size, so that the order of adding does not matter.
_UNIT = 1e12


@dataclass(frozen=True)
class Rule:
    """`place` is a host, a slash and how the path begins; it holds for subdomains too."""

    verdict: str
    place: str


def host_and_path(url: Column) -> tuple[Column, Column]:
    """As the contract has them; both empty without `://` or URL."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(_url, instr(_url, '://') + 3)"))
    host = F.regexp_extract(rest, r"(?s)^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    low = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(low, F.lit("")), F.coalesce(path, F.lit(""))


def longest_rule(rules: list[Rule]) -> tuple[Column, Column]:
    """The rule and verdict for `host` and `path`; null where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.place), r.place)):  # the longest is asked first
        host, slash, path = rule.place.partition("/")
        fits = ((F.col("host") == host) | F.endswith(F.col("host"), F.lit(f".{host}"))) & F.startswith(
            F.col("path"), F.lit(slash + path)
        )
        name = F.when(fits, F.lit(rule.place)).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


class Splitter:
    """Splits run-together letters into the likeliest words under a unigram model."""

    def __init__(self, counts: dict[str, int], total: int | None = None) -> None:
        """`total` is that of all words, where `counts` has only those that can occur."""
        total = (sum(counts.values()) if total is None else total) + 1
        self.cost = {w: -math.log(n / total) for w, n in counts.items() if n > 0}
        self.unknown = math.log(total) + 2.0
        self.seen: dict[str, list[str]] = {}

    def split(self, name: str) -> list[str]:
        if name not in self.seen:
            if len(self.seen) >= CACHE:
                self.seen = {}
            self.seen[name] = self._viterbi(name)
        return self.seen[name]

    def _viterbi(self, name: str) -> list[str]:
        best, back = [0.0] + [math.inf] * len(name), [0] * (len(name) + 1)
        for end in range(1, len(name) + 1):
            for start in range(max(0, end - LONGEST), end):
                word = name[start:end]
                # Unknown stretches cost by length, so that known words are preferred.
                cost = self.cost.get(word, self.unknown * (end - start))
                if best[start] + cost < best[end]:
                    best[end], back[end] = best[start] + cost, start
        words, at = [], len(name)
        while at:
            words.append(name[back[at] : at])
            at = back[at]
        return words[::-1]


_LETTERS = re.compile(r"[^\W\d_]+|\d+")


def pieces_of(host: str, path: str) -> list[str]:
    """r:letters of each host label, not yet split, and path tokens; numbers by their number of digits."""
    found = [f"h:#{len(run)}" if run.isdigit() else f"r:{run}" for run in _LETTERS.findall(host)]
    return found + [f"p:#{len(run)}" if run.isdigit() else f"p:{run.lower()}" for run in _LETTERS.findall(path)]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
        pieces = pa.array([pieces_of(h, p) for h, p in zip(hosts, paths, strict=True)], pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("given"), pieces], names=["row", "given", "pieces"])


def word_counts(pages: DataFrame) -> DataFrame:
    """(word, n): runs of letters in the text, the link targets and the URL path of all pages, lower-cased.

    Scripts, styles, comments, tags and character references are not text; of an absolute link its
    host is not read, as hosts are what is to be split.
    """
    html = F.regexp_replace(
        F.coalesce("html", F.lit("")), r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b.*?(?:</\1\s*>|\z)", " "
    )
    text = F.regexp_replace(F.regexp_replace(html, "<[^<>]*>", " "), "&#?[A-Za-z0-9]+;", " ")
    links = F.regexp_extract_all(html, F.lit(r"""(?i)\bhref\s*=\s*["']?([^\s"'<>]+)"""), F.lit(1))
    links = F.transform(links, lambda x: F.regexp_replace(x, "^([A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*", ""))
    path = host_and_path(F.col("_url"))[1]
    targets = F.transform(F.concat(links, F.array(path)), lambda x: F.coalesce(F.try_url_decode(x), x))
    said = F.concat_ws(" ", text, targets)
    words = F.regexp_extract_all(said, F.lit(rf"[\p{{L}}\p{{M}}]{{{SHORTEST},}}"), F.lit(0))
    words = pages.withColumn("_url", F.col("url")).select(F.explode(words).alias("word"))
    return words.groupBy(F.lower("word").alias("word")).agg(F.count("*").alias("n"))


def _split(runs: DataFrame, words: DataFrame) -> DataFrame:
    """(piece, words): each distinct r:letters of `runs` and its likeliest words, as h:word."""
    total = words.agg(F.sum("n")).first()[0] or 0
    run = F.expr("substring(piece, 3)")
    parts = runs.select("piece", run.alias("run")).withColumn("at", F.explode(F.sequence(F.lit(1), F.length("run"))))
    parts = parts.withColumn("left", F.length("run") - F.col("at") + 1).filter(F.col("left") >= SHORTEST)
    parts = parts.withColumn("size", F.explode(F.sequence(F.lit(SHORTEST), F.least(F.lit(LONGEST), "left"))))
    parts = parts.select("piece", F.expr("substring(run, at, size)").alias("part")).distinct()
    known = parts.withColumn("word", F.lower("part")).join(words, "word")
    known = known.groupBy("piece").agg(F.collect_list(F.struct("part", "n")).alias("known"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for piece, have in zip(batch.column("piece").to_pylist(), batch.column("known").to_pylist(), strict=True):
                counts = {k["part"]: k["n"] for k in have or []}
                out.append([f"h:{w}" for w in Splitter(counts, total).split(piece[2:])])
            yield pa.RecordBatch.from_arrays([batch.column("piece"), pa.array(out, pa.list_(pa.string()))], names=["piece", "words"])

    return runs.join(known, "piece", "left").mapInArrow(work, "piece string, words array<string>")


def judge(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per row of `pages` (page_id, url, html): page_id, host, path, rule, verdict, learned.

    The longest rule that fits decides, else naive Bayes; of equal odds, or with nothing to learn
    from, it allows. A null URL, or one without `://`, has an empty host and path and is judged by
    the classes' frequencies. Repeated rows give repeated rows; other columns are not read.
    """
    rows = shipped(pages).select("page_id", F.col("url").alias("_url"))
    host, path = host_and_path(F.col("_url"))
    rows = rows.select("page_id", host.alias("host"), path.alias("path"))
    name, verdict = longest_rule(rules)
    rows = rows.select("page_id", "host", "path", name.alias("rule"), verdict.alias("given"))
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "urls")
    pieces = rows.select("row", "given", "host", "path").mapInArrow(
        _cut, "row bigint, given string, pieces array<string>"
    )
    pieces = pieces.select("row", "given", F.explode("pieces").alias("piece"))
    runs = materialize(pieces.select("piece").filter(F.startswith("piece", F.lit("r:"))).distinct(), "runs")
    split = materialize(_split(runs, materialize(word_counts(pages), "words")), "split")
    tokens = pieces.join(split, "piece", "left").select(
        "row", "given", F.explode(F.coalesce("words", F.array("piece"))).alias("token")
    )
    tokens = materialize(tokens, "tokens")

    classes = {r["given"]: r["count"] for r in rows.filter("given IS NOT NULL").groupBy("given").count().collect()}
    tally = tokens.filter("given IS NOT NULL").groupBy("token").agg(
        F.sum((F.col("given") == BLOCK).cast("long")).alias("blocked"),
        F.sum((F.col("given") == ALLOW).cast("long")).alias("allowed"),
    )
    odds, prior, unseen = _fitted(classes, materialize(tally, "tally"))
    scores = tokens.join(odds, "token", "left").groupBy("row").agg(F.sum(F.coalesce("odds", F.lit(unseen))).alias("odds"))
    learned = F.when(F.coalesce("odds", F.lit(0)) + F.lit(prior) > 0, BLOCK).otherwise(ALLOW)
    judged = rows.join(scores, "row", "left").withColumn("learned", learned)
    return judged.select("page_id", "host", "path", "rule", F.coalesce("given", "learned").alias("verdict"), "learned")


def _fitted(classes: dict[str, int], tally: DataFrame) -> tuple[DataFrame, int, int]:
    """Log odds of block against allow, in _UNITs: (token, odds), those of the classes, of an unseen token.

    Add-one smoothing; without rows of both classes there are no odds to speak of.
    """
    sums = tally.agg(F.count("*").alias("n"), F.sum("blocked").alias("b"), F.sum("allowed").alias("a")).first()
    all_b, all_a = ((sums[x] or 0) + sums["n"] + 1 for x in "ba")
    odds = F.ln((F.col("blocked") + 1) / F.lit(float(all_b))) - F.ln((F.col("allowed") + 1) / F.lit(float(all_a)))
    prior = math.log((classes.get(BLOCK, 0) + 1) / (classes.get(ALLOW, 0) + 1))
    listed = tally.select("token", F.round(odds * F.lit(_UNIT)).cast("bigint").alias("odds"))
    return listed, round(prior * _UNIT), round(math.log(all_a / all_b) * _UNIT)
