"""Secrets in texts, judged by who owns them over the whole corpus.

Patterns give candidates: assignments, access keys, long hexadecimal runs, and opaque tokens. Each
candidate's value is hashed, and the corpus is asked in how many repositories and by how many owners
the value is used. A repository is a distinct text, so copies of one document are one, whoever owns
them. A value that several owners have in several repositories is an example that was copied around;
any other that looks random is a live-looking credential. scan() reports and redacted() cuts by this
one rule. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm import spans
from tidewell.session import materialize

#: A value that this many owners use, in this many repositories, is a copied example.
COPIED_OWNERS = 3
COPIED_REPOSITORIES = 3
#: A value with this many digits looks random.
LEAST_DIGITS = 2
#: So does, where the pattern says secret already, one of this many bits a character: no placeholder or ruled line.
LEAST_ENTROPY = 2.0

# Fixed values of the contract: the kinds in order, and their patterns.
_KEYWORD = r"(?i:password|passwd|secret|token|api_?key)"
_VALUE = r"[A-Za-z0-9+/_.=-]+"
_SIGN = r"[\"']?\x20*[:=]\x20*[\"']?"
ASSIGN = rf"{_KEYWORD}{_SIGN}{_VALUE}"
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
#: The method's own kind: runs with a small letter, a capital and a digit.
OPAQUE = r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}+"


def value_of_assignment(body: Column) -> Column:
    return F.regexp_extract(body, rf"^{_KEYWORD}{_SIGN}({_VALUE})$", 1)


def base_kinds(text: Column) -> dict[str, Column]:
    words = ("password", "passwd", "secret", "token", "apikey", "api_key")
    lowered = F.lower(text)
    keyword = F.lit(False)
    for word in words:
        keyword = keyword | F.contains(lowered, F.lit(word))
    # Letters outside ASCII that turn into ASCII ones when lower-cased only make the quick test wider.
    return {
        "assign": spans.found(text, ASSIGN, lambda b: F.length(value_of_assignment(b)) >= 8, keyword),
        "access": spans.found(text, ACCESS, None, F.contains(text, F.lit("AKIA"))),
        "hex": spans.found(text, HEX),
    }


def _mixed(body: Column) -> Column:
    return body.rlike("[a-z]") & body.rlike("[A-Z]") & body.rlike("[0-9]")


def _value(span: Column) -> Column:
    return F.when(span["kind"] == "assign", value_of_assignment(span["body"])).otherwise(span["body"])


def _entropy(value: Column) -> Column:
    """Bits a character, by how often each character is in `value`."""
    size = F.length(value)

    def bits(letter: Column) -> Column:
        share = (size - F.length(F.replace(value, letter, F.lit("")))) / size
        return share * F.log2(share)

    letters = F.array_distinct(F.regexp_extract_all(value, F.lit("(?s)."), F.lit(0)))
    return F.round(-F.aggregate(letters, F.lit(0.0), lambda sum_, letter: sum_ + bits(letter)), 9)


_NONE = "cast(array() AS array<struct<start: int, rank: int, end: int, kind: string, body: string>>)"


def _read(docs: DataFrame, owner: str) -> DataFrame:
    """doc_id, owner, repository, `base` and all `candidates` of each row, beside the row itself."""
    text = F.coalesce("text", F.lit(""))
    kinds = base_kinds(text)
    read = docs.select(
        F.struct("*").alias("_row"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"),
        F.xxhash64("text").alias("repository"),
        spans.of_kinds(kinds).alias("base"),
        spans.found(text, OPAQUE, _mixed).alias("opaque"),
        # Keeps filters above the searches, which would otherwise be made again inside them.
        F.monotonically_increasing_id().alias("row"),
    )
    own = F.filter(
        "opaque",
        lambda o: ~F.exists("base", lambda b: (b["start"] < o["end"]) & (b["end"] > o["start"])),
    )
    more = spans.kind_of(own, len(kinds), "opaque")
    return read.withColumn("candidates", F.concat("base", more)).drop("opaque")


def _judged(read: DataFrame) -> DataFrame:
    """(row, span, owners, repositories, is_live, is_copied) of the candidates of `read`, a stored table."""
    each = read.select("row", "owner", "repository", F.explode("candidates").alias("span"))
    each = each.withColumn("value", F.sha2(_value(F.col("span")), 256))
    # One row per use; then counts of distinct repositories and owners. Both are summed up in the
    # tasks before they are shuffled, so a value that a third of all documents use is a few rows.
    uses = each.select("value", "owner", "repository").distinct()
    by_owner = uses.groupBy("value", "owner").agg(F.count("*").alias("n")).groupBy("value")
    by_repository = uses.groupBy("value", "repository").agg(F.count("*").alias("n")).groupBy("value")
    owners = by_owner.agg(F.count("*").alias("owners")).join(
        by_repository.agg(F.count("*").alias("repositories")), "value"
    )
    owners = materialize(owners, "ownership")
    digits = F.length(F.regexp_replace(_value(F.col("span")), "[^0-9]", ""))
    varied = (F.col("span.kind") != "opaque") & (_entropy(_value(F.col("span"))) >= LEAST_ENTROPY)
    copied = (F.col("owners") >= COPIED_OWNERS) & (F.col("repositories") >= COPIED_REPOSITORIES)
    return each.join(owners, "value").select(
        "row",
        "span",
        "owners",
        "repositories",
        (~copied & ((digits >= LEAST_DIGITS) | varied)).alias("is_live"),
        copied.alias("is_copied"),
    )


def scan(docs: DataFrame, owner: str = "source") -> DataFrame:
    """One row per row of `docs` (doc_id, text, owner): doc_id, base, all_spans, live, copied.

    `base` are the findings of the contract's patterns, `all_spans` those and the opaque tokens that
    look live, as lists of (start, rank, end, kind, body). `copied` counts the findings whose value
    COPIED_OWNERS owners or more use, in COPIED_REPOSITORIES texts or more; `live` counts the others
    that look random: by LEAST_DIGITS digits, or by LEAST_ENTROPY where the pattern says secret
    already, so passphrases and keys of letters too.

    A null text is empty; all null owners are one owner; a null doc_id is kept. Repeated rows give
    repeated rows; equal texts are one repository. An empty table gives an empty table.
    """
    read = materialize(_read(docs, owner).drop("_row"), "findings")
    by_row = (
        _judged(read)
        .filter((F.col("span.kind") != "opaque") | F.col("is_live"))
        .groupBy("row")
        .agg(
            F.array_sort(F.collect_list("span")).alias("all_spans"),
            F.sum(F.col("is_live").cast("bigint")).alias("live"),
            F.sum(F.col("is_copied").cast("bigint")).alias("copied"),
        )
    )
    return (
        read.select("row", "doc_id", "base")
        .join(by_row, "row", "left")
        .select(
            "doc_id",
            "base",
            F.coalesce("all_spans", F.expr(_NONE)).alias("all_spans"),
            F.coalesce("live", F.lit(0)).alias("live"),
            F.coalesce("copied", F.lit(0)).alias("copied"),
        )
    )


def redacted(docs: DataFrame, owner: str = "source") -> DataFrame:
    """`docs` with the values that scan() counts as live replaced, with their keywords, by <secret>.

    Copied examples and what does not look random stay; so do null texts.

    Texts with candidates are stored, joined with what the whole corpus says of their values, and
    rewritten; all others pass as they are and are not shuffled.
    """
    read = _read(docs, owner)
    clean = read.filter((F.size("candidates") == 0) & (F.col("row") >= 0)).select("_row.*")
    dirty = read.filter((F.size("candidates") > 0) & (F.col("row") >= 0))
    dirty = materialize(dirty, "with-candidates")
    found = (
        _judged(dirty.drop("_row"))
        .filter("is_live")
        .groupBy("row")
        .agg(F.array_sort(F.collect_list("span")).alias("cut"))
    )
    rewritten = F.expr(
        """aggregate(cut, struct(0 AS at, '' AS done), (seen, s) -> if(s.start < seen.at, seen,
             struct(s.end AS at,
                    concat(seen.done, substring(_row.text, seen.at + 1, s.start - seen.at), '<secret>') AS done)),
           seen -> concat(seen.done, substring(_row.text, seen.at + 1)))"""
    )
    joined = dirty.join(found, "row", "left")
    text = F.when(F.col("cut").isNull(), F.col("_row.text")).otherwise(rewritten)
    done = joined.select(
        *[text.alias("text") if c == "text" else F.col("_row")[c].alias(c) for c in docs.columns]
    )
    return clean.unionByName(done)
