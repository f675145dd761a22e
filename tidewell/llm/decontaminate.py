"""Benchmark decontamination: a broadcast hash set of test n-grams over all token windows.

The set that is broadcast holds the hashes of the benchmark's distinct n-grams and nothing else, eight
bytes each, at most `MAX_GRAMS` at a time: what a task holds is bounded whatever the n-grams' lengths,
and a larger benchmark is taken in more scans, each stored before the next. Every window of every text
is looked up in it. The windows found, few beside the corpus, are then verified: joined with the n-grams
by their words, without a hint, so Spark broadcasts the n-grams only where they are small. No text is
shuffled to find hits, and none passes through the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.session import materialize

WIDTH = 10
#: Hashes broadcast at once, on average over the scans: some 50 MB as Spark holds them.
MAX_GRAMS = 1_000_000

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_OTHER_CAPITALS = r"[\p{IsUppercase}\p{Lt}&&[^A-Z]]"


def ascii_lower(text: Column) -> Column:
    """A-Z as a-z, all else as it is. `lower` is much faster where it comes to the same."""
    same = (F.length(text) == F.octet_length(text)) | ~text.rlike(_OTHER_CAPITALS)
    return F.when(same, F.lower(text)).otherwise(F.translate(text, _CAPITALS, _SMALL))


def _tokens(texts: DataFrame) -> DataFrame:
    """Adds `_words` and `_hashes` for `_text`."""
    words = F.regexp_extract_all(ascii_lower(F.coalesce("_text", F.lit(""))), F.lit(WORD), F.lit(0))
    return texts.withColumn("_words", words).withColumn(
        "_hashes", F.transform("_words", lambda w: F.xxhash64(w))
    )


def _window_starts(width: int) -> Column:
    n = F.size("_hashes")
    return F.when(n >= width, F.sequence(F.lit(0), n - width)).otherwise(F.array().cast("array<int>"))


def _window_hash(at: Column, width: int) -> Column:
    return F.xxhash64(*[F.get("_hashes", at + j) for j in range(width)])


def _window_text(at: Column, width: int) -> Column:
    return F.array_join(F.slice("_words", at + 1, width), " ")


def grams(benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """(gram, hash, width, items): each distinct n-gram with the distinct items that hold it.

    An item of fewer words than `width` is one gram; an item without words, or null, has none.
    """
    read = _tokens(benchmark.select(F.col("item_id").alias("_item"), F.col("text").alias("_text")))
    n = F.size("_words")
    windows = F.transform(
        _window_starts(width),
        lambda i: F.struct(
            _window_text(i, width).alias("gram"),
            _window_hash(i, width).alias("hash"),
            F.lit(width).alias("width"),
        ),
    )
    for short in range(1, width):
        whole = F.struct(
            F.array_join("_words", " ").alias("gram"),
            _window_hash(F.lit(0), short).alias("hash"),
            F.lit(short).alias("width"),
        )
        windows = F.when(n == short, F.array(whole)).otherwise(windows)
    return (
        read.select("_item", F.explode(windows).alias("w"))
        .groupBy("w.gram", "w.hash", "w.width")
        .agg(F.collect_set("_item").alias("items"))
    )


def _hash_sets(found: DataFrame) -> list[DataFrame]:
    """The distinct hashes of the grams, in sets of some MAX_GRAMS at most; at least one set."""
    hashes = found.select(F.col("hash").alias("_hash")).distinct()
    n = max(1, -(-hashes.count() // MAX_GRAMS))
    return [hashes.filter(F.pmod(F.xxhash64("_hash"), F.lit(n)) == i) for i in range(n)]


def _looked_up(texts: DataFrame, hashes: DataFrame, widths: list[int], marked: bool) -> DataFrame:
    """Of `texts` (_key, _text): _key, _n (words), _start, _width, _gram of each window whose hash is known.

    Where `marked`, each row also gives one line without a window, of width 0.
    """

    def listed(width: int) -> Column:
        return F.transform(
            _window_starts(width),
            lambda i: F.struct(i.alias("start"), F.lit(width).alias("width"), _window_hash(i, width).alias("hash")),
        )

    lists = [listed(width) for width in widths]
    mark = F.struct(F.lit(-1).alias("start"), F.lit(0).alias("width"), F.lit(None).cast("bigint").alias("hash"))
    if marked:
        lists.insert(0, F.array(mark))
    elif not lists:
        lists.append(F.filter(F.array(mark), lambda _: F.lit(False)))
    # Listed before they are exploded: an explode of a column alone is compiled together with the join and
    # the filter, so a text's words are not copied for each of its windows. Outer, as Spark would else filter
    # by the list's size below, and cut the words again for each window; the null row is dropped as unknown.
    read = _tokens(texts).withColumn("_windows", F.concat(*lists))
    each = read.select("_key", "_words", F.explode_outer("_windows").alias("_w"))
    known = F.broadcast(hashes.withColumn("_known", F.lit(True)))
    each = each.join(known, F.col("_w.hash") == F.col("_hash"), "left")
    wanted = F.col("_known") | (F.col("_w.width") == 0) if marked else F.col("_known")
    words = F.slice("_words", F.col("_w.start") + 1, F.col("_w.width"))
    return each.filter(wanted).select(
        "_key",
        F.size("_words").cast("bigint").alias("_n"),
        F.col("_w.start").alias("_start"),
        F.col("_w.width").alias("_width"),
        F.when(F.col("_w.width") > 0, F.array_join(words, " ")).alias("_gram"),
    )


def _hits(texts: DataFrame, benchmark: DataFrame, width: int, marked: bool = False) -> tuple[DataFrame, DataFrame]:
    """The windows of `texts` found by hash, stored, and of these the verified ones with their items."""
    known = materialize(grams(benchmark, width), "grams")
    widths = sorted(row.width for row in known.select("width").distinct().collect())  # `width` rows at most
    stored = [
        materialize(_looked_up(texts, hashes, widths, marked and number == 0), "windows")
        for number, hashes in enumerate(_hash_sets(known))
    ]
    windows = reduce(DataFrame.unionByName, stored)
    same = known.select(F.col("gram").alias("_gram"), "items")
    return windows, windows.filter("_width > 0").join(same, "_gram")


def _covered(hits: str) -> str:
    """The places of words in any of these hits."""
    return (
        f"array_distinct(flatten(transform({hits}, h -> sequence(h.start, h.start + h.width - 1))))"
    )


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, n_words, n_hit, items.

    Words are runs of a-z, 0-9 and non-ASCII characters after A-Z are lower-cased. A word is hit if
    it lies in an occurrence of a gram; `items` are the ids, sorted as text, of the items with
    occurring grams.

    A null text has no words. Repeated rows give repeated rows; a null doc_id is kept, a null
    item_id is not listed. Empty tables on either side give no hit. Other columns are not read.
    """
    rows = docs.select(
        F.struct(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("hash")).alias("_key"),
        F.col("text").alias("_text"),
    )
    windows, hits = _hits(rows, benchmark, width, marked=True)
    # The hits of one text: no more than it has words, each once. Equal rows are one key.
    by_key = hits.groupBy("_key", "_n").agg(
        F.collect_set(F.struct(F.col("_start").alias("start"), F.col("_width").alias("width"))).alias("hits"),
        F.collect_set("items").alias("items"),
    )
    by_key = by_key.select(
        F.col("_key").alias("_hit_key"),
        F.col("_n").alias("_hit_n"),
        F.expr(f"cast(size({_covered('hits')}) AS bigint)").alias("n_hit"),
        F.expr("array_sort(transform(array_distinct(flatten(items)), i -> cast(i AS string)))").alias("items"),
    )
    same = F.col("_key").eqNullSafe(F.col("_hit_key")) & (F.col("_n") == F.col("_hit_n"))
    return (
        windows.filter("_width = 0")
        .join(by_key, same, "left")
        .select(
            "_key.doc_id",
            F.col("_n").alias("n_words"),
            F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
    )


def _by_text(docs: DataFrame) -> DataFrame:
    return docs.select(F.struct("*").alias("_row"), F.sha2("text", 256).alias("_key"), F.col("text").alias("_text"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """`docs` without the documents that hold a gram of the benchmark, items of fewer words as wholes.

    What is taken away is found by the digest of its text, so equal texts go or stay together. A null
    text stays. Empty tables on either side take nothing away.
    """
    read = _by_text(docs)
    _, hits = _hits(read, benchmark, width)
    return read.join(hits.select("_key").distinct(), "_key", "left_anti").select("_row.*")


def without_spans(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """`docs` with the hit words, and what stands between each and the word before, cut from `text`.

    Texts without a hit, and null ones, stay as they are. All hits are found in the text as given, also
    those of a benchmark that takes several scans.
    """
    word = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    gap = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"
    read = _by_text(docs)
    _, hits = _hits(read, benchmark, width)
    hits = hits.groupBy("_key").agg(
        F.collect_set(F.struct(F.col("_start").alias("start"), F.col("_width").alias("width"))).alias("_hits")
    )
    cut = hits.select("_key", F.expr(_covered("_hits")).alias("_cut"))
    pieces = F.regexp_extract_all("_text", F.lit(rf"{gap}{word}"), F.lit(0))
    left = F.array_join(F.filter(pieces, lambda p, i: ~F.array_contains(F.col("_cut"), i)), "")
    tail = F.regexp_extract("_text", rf"({gap})\z", 1)
    text = F.when(F.col("_cut").isNull(), F.col("_text")).otherwise(F.concat(left, tail))
    return read.join(cut, "_key", "left").select(
        *[text.alias("text") if c == "text" else F.col("_row")[c].alias(c) for c in docs.columns]
    )
