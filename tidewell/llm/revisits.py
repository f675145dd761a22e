"""WARC revisit resolution: each not-modified revisit to the latest earlier full response of its URL.

An as-of join by canonical URL and time. Records are dealt to tasks by ranges of (URL, time, record), so
that a hot URL, also one of a third of all records or with one time for all, is cut in stretches of
about equal numbers. Responses are carried forward inside a stretch, and the last one of each stretch
into the next ones; no task holds all records of such a URL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewell.session import materialize

# Fixed values of the standard (RFC 9111, 3.2 and RFC 9110, 15.4.5): what a not-modified answer may renew.
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "vary"]


def canonical(url: Column) -> Column:
    """Without scheme, `www.`, port 80 or 443, fragment, tracking parameters and final slash; host in small letters."""
    bare = F.regexp_replace(F.regexp_replace(url, r"#.*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(bare, r"^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r"^www\.", ""), r":(80|443)$", "")
    rest = F.regexp_replace(F.regexp_replace(bare, r"^[^/?]*", ""), r"([?&])utm_[a-z]+=[^&]*", "$1")
    rest = F.regexp_replace(F.regexp_replace(rest, r"&&+", "&"), r"\?&", "?")
    return F.concat(host, F.regexp_replace(rest, r"[?&/]+$", ""))


def same_validators(ours: Column, theirs: Column) -> Column:
    """The entity tags where both have one, weakly compared; else the dates; false where neither can be."""
    weak = lambda tag: F.regexp_replace(tag, r"^W/", "")
    tags = ours["etag"].isNotNull() & theirs["etag"].isNotNull()
    dates = ours["last-modified"].isNotNull() & theirs["last-modified"].isNotNull()
    return (
        F.when(tags, weak(ours["etag"]) == weak(theirs["etag"]))
        .when(dates, ours["last-modified"] == theirs["last-modified"])
        .otherwise(False)
    )


def merged_headers(response: Column, revisit: Column) -> Column:
    """The response's headers, with those that a not-modified answer may renew taken from it."""
    renewed = F.map_filter(revisit, lambda k, _: F.array_contains(F.array(*map(F.lit, PERMITTED)), k))
    kept = F.map_filter(response, lambda k, _: ~F.array_contains(F.map_keys(renewed), k))
    return F.map_from_entries(F.array_sort(F.concat(F.map_entries(kept), F.map_entries(renewed))))


def _parts(rows: DataFrame) -> int:
    return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def resolve(records: DataFrame) -> DataFrame:
    """One row per revisit of `records` (record_id, kind, url, at, headers, digest).

    `kind` is response or revisit, headers a map of small-lettered names, `at` a number. Gives
    revisit_id, canonical_url, response_id, state, headers and digest. The response is the latest
    one before the revisit (of equal times the larger record_id; a response at the revisit's own
    time is not earlier). state is `resolved`, `changed` where the validators differ or cannot be
    compared, or `missing` without an earlier response. Headers and digest are null unless resolved.

    A null URL or time finds nothing (`missing`), null headers are none; records of other or null
    kinds are left out. Repeated responses count once, repeated revisits give repeated rows. An
    empty table gives an empty table; other columns are not read.
    """
    none = F.expr("cast(map() AS map<string, string>)")
    rows = records.filter(F.col("kind").isin("response", "revisit")).select(
        "record_id", "kind", canonical(F.col("url")).alias("url"), F.col("at").cast("bigint").alias("at"),
        F.coalesce("headers", none).alias("headers"), "digest",
    )
    placed = F.col("url").isNotNull() & F.col("at").isNotNull()
    # All records in one order; at one time revisits come first: what has their own time is not earlier.
    # They are stored before they are sorted, which takes a sample first.
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "records")
    order = ["at", F.col("kind") == "response", "record_id", "row"]
    sorted_rows = rows.filter(placed).repartitionByRange(_parts(rows), "url", *order)
    sorted_rows = sorted_rows.sortWithinPartitions("url", *order).withColumn("stretch", F.spark_partition_id())
    cut = materialize(sorted_rows, "stretches")

    full = F.when(F.col("kind") == "response", F.struct(F.col("at"), F.col("record_id"), F.col("headers"), F.col("digest")))
    latest = F.when(full.isNotNull(), F.struct("at", "record_id", "row"))
    last = cut.groupBy("url", "stretch").agg(F.max_by(full, latest).alias("last"))
    so_far = Window.partitionBy("url").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.withColumn("before", F.last("last", ignorenulls=True).over(so_far)).select("url", "stretch", "before")
    carried = materialize(carried, "carried")

    ahead = Window.partitionBy("url", "stretch").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    within = cut.withColumn("own", F.last(full, ignorenulls=True).over(ahead)).filter(F.col("kind") == "revisit")
    found = within.join(carried, ["url", "stretch"]).withColumn("response", F.coalesce("own", "before"))
    lost = rows.filter((F.col("kind") == "revisit") & ~F.coalesce(placed, F.lit(False)))
    lost = lost.withColumn("response", F.lit(None).cast(found.schema["response"].dataType))
    every = found.select(*lost.columns).unionByName(lost)
    good = F.col("response").isNotNull() & same_validators(F.col("headers"), F.col("response.headers"))
    state = F.when(F.col("response").isNull(), "missing").when(good, "resolved").otherwise("changed")
    return every.select(
        F.col("record_id").alias("revisit_id"),
        F.col("url").alias("canonical_url"),
        F.col("response.record_id").alias("response_id"),
        state.alias("state"),
        F.when(good, merged_headers(F.col("response.headers"), F.col("headers"))).alias("headers"),
        F.when(good, F.col("response.digest")).alias("digest"),
    )


def records_of(pages: DataFrame) -> DataFrame:
    """Capture records of `pages` (page_id, url, html): each page as a response, and later a revisit of it.

    A crawl of every page, and a second one that found it not modified, under the URL as another link
    may write it. What the second one was told differs by the page's number: most entity tags are as
    before, some weak, some changed, some left out in favour of a date.
    """
    tag = F.concat(F.lit('"'), F.md5(F.coalesce("html", F.lit(""))), F.lit('"'))
    day = F.concat(F.lit("day "), (F.col("page_id") % 365).cast("string"))
    nth = F.pmod(F.col("page_id"), F.lit(7))
    maps = lambda *xs: F.map_filter(F.create_map(*xs), lambda _, v: v.isNotNull())
    response = F.struct(
        (2 * F.col("page_id")).alias("record_id"),
        F.lit("response").alias("kind"),
        F.col("url"),
        F.pmod(F.col("page_id") * 7919, F.lit(1_000_003)).alias("at"),
        maps(
            F.lit("content-type"), F.lit("text/html"), F.lit("date"), F.lit("first"), F.lit("etag"), F.when(nth != 6, tag),
            F.lit("last-modified"), day,
        ).alias("headers"),
        F.sha2(F.coalesce("html", F.lit("")), 256).alias("digest"),
    )
    told = F.when(nth == 0, F.concat(F.lit("W/"), tag)).when(nth == 1, F.lit('"other"')).when(nth < 5, tag)
    revisit = F.struct(
        (2 * F.col("page_id") + 1).alias("record_id"),
        F.lit("revisit").alias("kind"),
        F.when(nth < 4, F.concat(F.regexp_replace("url", r"#.*$", ""), F.lit("#again"))).otherwise(F.col("url")).alias("url"),
        F.pmod(F.col("page_id") * 7919 + F.when(nth == 3, -50).otherwise(5000), F.lit(1_000_003)).alias("at"),
        maps(
            F.lit("content-type"), F.lit("ignored"), F.lit("date"), F.lit("second"), F.lit("etag"), told,
            F.lit("last-modified"), F.when(nth == 5, day), F.lit("expires"), F.lit("never"),
        ).alias("headers"),
        F.lit(None).cast("string").alias("digest"),
    )
    return pages.select(F.explode(F.array(response, revisit)).alias("r")).select("r.*")
