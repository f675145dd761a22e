"""The operators as named queries over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import (
    bpe,
    decontaminate,
    fill_in_middle,
    language_id,
    merkle,
    near_dedup,
    nearest,
    piece_bpe,
    pii,
    revisits,
    secret_scan,
    spans,
    substring_dedup,
    url_filter,
)

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def _query(build: Query) -> Query:
    _QUERIES[build.__name__] = build
    return build


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query
def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return substring_dedup.without_repeats(docs).select(
        "document.doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


_SQL["op1_substring_dedup"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, sha256(array_to_string(w[i:i + 34], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
repeated AS (SELECT doc_id, i FROM windows JOIN (SELECT h FROM windows GROUP BY h HAVING count(*) > 1) USING (h)),
covered AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM repeated),
kept AS (
  SELECT x.doc_id, string_agg(x.word, ' ' ORDER BY x.p) AS t, count(*) AS n
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d) x
  ANTI JOIN covered c ON c.doc_id = x.doc_id AND c.p = x.p GROUP BY x.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


def vocabulary() -> tuple[str, str]:
    """The file of ranks, and the pattern that cuts pre-tokens."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def token_digests() -> list[Column]:
    """Of `ids` and `decoded`."""
    return [
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    ]


# Fixed values of the contract.
URL_RULES = [
    url_filter.Rule(url_filter.ALLOW, "org/"),
    url_filter.Rule(url_filter.BLOCK, "example.org/es/"),
    url_filter.Rule(url_filter.BLOCK, "example.org/en/1"),
    url_filter.Rule(url_filter.ALLOW, "com/fr/"),
    url_filter.Rule(url_filter.BLOCK, "com/de/"),
]


@_query
def op2_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(_table(spark, folder, "pages"), URL_RULES)


@_query
def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    found = language_id.predict(docs.select("doc_id", "text"), language_id.learn(docs))
    doc_id = F.col("document.doc_id")
    return found.select(
        doc_id.alias("doc_id"), language_id.held_out(doc_id).alias("held_out"), "lang_pred", "score"
    )


@_query
def op4_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path, pattern = vocabulary()
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    tokens = bpe.round_trip(docs, path, pattern)
    return tokens.select("document.doc_id", *token_digests())


@_query
def op5_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.personal_data(_table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        *[_count(kind) for kind in ("email", "ip", "card", "phone")],
        F.sha2(spans.written(F.col("base")), 256).alias("base_sha256"),
        spans.written(F.col("all_spans")).alias("spans"),
    )


def _count(kind: str) -> Column:
    """n_<kind>: how many of `base` are of this kind."""
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")


@_query
def op6_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(
        _table(spark, folder, "documents"), _table(spark, folder, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


_SQL["op6_benchmark_decontamination"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
grams AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT item_id, w, least(len(w), 10) AS k,
               unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
windows AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM d, (SELECT DISTINCT k FROM grams) WHERE len(w) >= k)),
hits AS (SELECT doc_id, i, w.k AS k, item_id FROM windows w JOIN grams g ON g.k = w.k AND g.g = w.g),
places AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT doc_id, i, k FROM hits))
  GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@_query
def op7_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return nearest.nearest(_table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, 20)


@_query
def op8_warc_revisits(spark: SparkSession, folder: str) -> DataFrame:
    found = revisits.resolve(revisits.records_of(_table(spark, folder, "pages")))
    written = F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return found.withColumn("headers", F.array_join(written, ";"))


_SQL["op8_warc_revisits"] = r"""
WITH p AS (SELECT page_id, url, '"' || md5(coalesce(html, '')) || '"' AS tag, 'day ' || CAST(page_id % 365 AS VARCHAR) AS day,
                  sha256(coalesce(html, '')) AS digest, page_id % 7 AS nth FROM pages),
raw AS (
  SELECT 2 * page_id AS record_id, 'response' AS kind, url, page_id * 7919 % 1000003 AS seen_at,
         CASE WHEN nth <> 6 THEN tag END AS etag, day AS modified, digest FROM p
  UNION ALL
  SELECT 2 * page_id + 1, 'revisit', CASE WHEN nth < 4 THEN regexp_replace(url, '#.*$', '') || '#again' ELSE url END,
         (page_id * 7919 + CASE WHEN nth = 3 THEN -50 ELSE 5000 END + 1000003) % 1000003,
         CASE WHEN nth = 0 THEN 'W/' || tag WHEN nth = 1 THEN '"other"' WHEN nth < 5 THEN tag END,
         CASE WHEN nth = 5 THEN day END, NULL FROM p),
bare AS (SELECT *, regexp_replace(regexp_replace(url, '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS b FROM raw),
c AS (
  SELECT record_id, kind, seen_at, etag, modified, digest,
    regexp_replace(regexp_replace(lower(regexp_extract(b, '^([^/?]*)', 1)), '^www\.', ''), ':(80|443)$', '') ||
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(b, '^[^/?]*', ''),
      '([?&])utm_[a-z]+=[^&]*', '\1', 'g'), '&&+', '&', 'g'), '\?&', '?', 'g'), '[?&/]+$', '') AS canonical_url
  FROM bare),
j AS (
  SELECT v.record_id AS revisit_id, v.canonical_url, v.etag, v.modified, r.record_id AS response_id,
         r.etag AS r_etag, r.modified AS r_modified, r.digest
  FROM (SELECT * FROM c WHERE kind = 'revisit') v
  LEFT JOIN c r ON r.kind = 'response' AND r.canonical_url = v.canonical_url AND r.seen_at < v.seen_at
  QUALIFY row_number() OVER (PARTITION BY v.record_id ORDER BY r.seen_at DESC NULLS LAST, r.record_id DESC) = 1),
s AS (
  SELECT *, CASE WHEN response_id IS NULL THEN 'missing'
    WHEN CASE WHEN etag IS NOT NULL AND r_etag IS NOT NULL THEN regexp_replace(etag, '^W/', '') = regexp_replace(r_etag, '^W/', '')
              WHEN modified IS NOT NULL AND r_modified IS NOT NULL THEN modified = r_modified ELSE false END
    THEN 'resolved' ELSE 'changed' END AS state FROM j)
SELECT revisit_id, canonical_url, response_id, state,
  CASE WHEN state = 'resolved' THEN array_to_string(list_filter(['content-type=text/html', 'date=second',
    CASE WHEN coalesce(etag, r_etag) IS NOT NULL THEN 'etag=' || coalesce(etag, r_etag) END, 'expires=never',
    'last-modified=' || r_modified], lambda x: x IS NOT NULL), ';') END AS headers,
  CASE WHEN state = 'resolved' THEN digest END AS digest
FROM s
"""


@_query
def op9_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rule = near_dedup.Rule(shingle=3, percent=85)
    found = near_dedup.near_duplicates(_table(spark, folder, "documents"), rule)
    return found.select(
        "doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept")
    )


_SQL["op9_minhash_near_dedup"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, g FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g
    FROM d)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
linked AS (
  SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * k >= 85 * (x.n + y.n - k)),
ends AS (SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM d
  UNION
  SELECT r.doc_id, e.b FROM reach r JOIN ends e ON e.a = r.other),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d JOIN least USING (doc_id) LEFT JOIN n USING (doc_id)
"""


@_query
def op10_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.scan(_table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        *[_count(kind) for kind in ("assign", "access", "hex")],
        F.sha2(spans.written(F.col("base")), 256).alias("base_sha256"),
        spans.written(F.col("all_spans")).alias("spans"),
        F.col("live").alias("n_live"),
        F.col("copied").alias("n_copied"),
    )


def _pieces(kind: str, rank: int, pattern: str) -> str:
    """SQL for the matches of one pattern: text before each, and the match; '' as the tail's match."""
    whole = rf"(?s)(.*?)(?:({pattern})|\z)".replace("'", "''")
    return (
        f"SELECT doc_id, source, text, '{kind}' AS kind, {rank} AS rank, unnest(range(1, len(gaps) + 1)) AS i,"
        f" unnest(gaps) AS gap, unnest(bodies) AS body FROM (SELECT doc_id, source, sha256(text) AS text,"
        f" regexp_extract_all(coalesce(text, ''), '{whole}', 1) AS gaps,"
        f" regexp_extract_all(coalesce(text, ''), '{whole}', 2) AS bodies FROM documents)"
    )


_ASSIGN_VALUE = (
    r"""regexp_extract(body, '^(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?"""
    r"""([A-Za-z0-9+/_.=-]+)$', 1)"""
)
_SQL["op10_secret_scan"] = rf"""
WITH pieces AS (
  {_pieces("assign", 0, secret_scan.ASSIGN)} UNION ALL
  {_pieces("access", 1, "AKIA[A-Z0-9]+")} UNION ALL
  {_pieces("hex", 2, "[0-9a-f]+")} UNION ALL
  {_pieces("opaque", 3, "[A-Za-z0-9_-]+")}),
placed AS (
  SELECT doc_id, source, text, kind, rank, body, length(body) AS n,
         sum(length(gap) + length(body)) OVER (PARTITION BY doc_id, rank ORDER BY i) AS stop FROM pieces),
valued AS (
  SELECT *, stop - n AS start, CASE WHEN kind = 'assign' THEN {_ASSIGN_VALUE} ELSE body END AS value
  FROM placed WHERE n > 0),
base AS (
  SELECT * FROM valued WHERE kind = 'assign' AND length(value) >= 8
    OR kind = 'access' AND n >= 16 OR kind = 'hex' AND n >= 32),
opaque AS (
  SELECT * FROM valued v WHERE kind = 'opaque' AND n >= 20 AND regexp_matches(body, '[a-z]')
    AND regexp_matches(body, '[A-Z]') AND regexp_matches(body, '[0-9]')
    AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = v.doc_id AND b.start < v.stop AND b.stop > v.start)),
uses AS (SELECT * FROM base UNION ALL SELECT * FROM opaque),
owners AS (
  SELECT value, count(DISTINCT coalesce(source, '')) >= {secret_scan.COPIED_OWNERS}
      AND count(DISTINCT text) >= {secret_scan.COPIED_REPOSITORIES} AS is_copied
  FROM uses GROUP BY value),
letters AS (
  SELECT value, n / sum(n) OVER (PARTITION BY value) AS share FROM (
    SELECT value, letter, count(*) AS n
    FROM (SELECT value, unnest(string_split(value, '')) AS letter FROM owners) GROUP BY value, letter)),
entropies AS (SELECT value, -sum(share * log2(share)) AS entropy FROM letters GROUP BY value),
marked AS (
  SELECT doc_id, kind, rank, start, stop, is_copied,
         NOT is_copied AND (length(regexp_replace(value, '[^0-9]', '', 'g')) >= {secret_scan.LEAST_DIGITS}
           OR kind <> 'opaque' AND round(entropy, 9) >= {secret_scan.LEAST_ENTROPY}) AS is_live
  FROM uses JOIN owners USING (value) JOIN entropies USING (value)),
judged AS (SELECT * FROM marked WHERE kind <> 'opaque' OR is_live),
written AS (SELECT *, kind || ':' || CAST(start AS VARCHAR) || ':' || CAST(stop AS VARCHAR) AS s FROM judged),
by_doc AS (
  SELECT doc_id, sum(CASE WHEN kind = 'assign' THEN 1 ELSE 0 END) AS n_assign,
    sum(CASE WHEN kind = 'access' THEN 1 ELSE 0 END) AS n_access,
    sum(CASE WHEN kind = 'hex' THEN 1 ELSE 0 END) AS n_hex,
    string_agg(s, ',' ORDER BY start, rank) FILTER (WHERE rank < 3) AS base,
    string_agg(s, ',' ORDER BY start, rank) AS spans,
    sum(CASE WHEN is_live THEN 1 ELSE 0 END) AS n_live,
    sum(CASE WHEN is_copied THEN 1 ELSE 0 END) AS n_copied
  FROM written GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access,
  CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans, CAST(coalesce(n_live, 0) AS BIGINT) AS n_live,
  CAST(coalesce(n_copied, 0) AS BIGINT) AS n_copied
FROM documents LEFT JOIN by_doc USING (doc_id)
"""


def piece_model() -> str:
    """The file of the sentencepiece model."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@_query
def op11_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    tokens = piece_bpe.round_trip(docs, piece_model())
    return tokens.select(
        "document.doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@_query
def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    fields = {name: F.col(name) for name in merkle.FIELDS}
    changed = {**fields, "text": F.translate("text", CAPITALS, SMALL)}
    suspect = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    leaf = merkle.leaf_of(list(fields.values()))
    shown = F.when(suspect, merkle.leaf_of(list(changed.values()))).otherwise(leaf)
    leaves = docs.select("doc_id", "lang", leaf.alias("leaf"), shown.alias("shown"))
    found = merkle.manifest(leaves, "lang", ["doc_id"])
    root = merkle.folded(F.col("carried.shown"), F.col("proof"))
    return found.select(
        "carried.doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(merkle.siblings(F.col("proof")), 256).alias("proof_sha256"),
        root.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def _merkle_sql(levels: int, group_levels: int) -> str:
    """SQL for trees of at most 8 ** levels leaves, and 8 ** group_levels groups; one step a level."""

    def tree(name: str, key: str, height: int) -> str:
        # <name>0 (key, i, digest); runs of a level, and the nodes above them.
        parts = []
        for n in range(height):
            parts.append(
                f"{name}_run{n} AS (SELECT {key}, i // 8 AS i, list(digest ORDER BY i) AS run,"
                f" sum(count(*)) OVER (PARTITION BY {key}) AS total FROM {name}{n} GROUP BY {key}, i // 8),"
            )
            parts.append(
                f"{name}{n + 1} AS (SELECT {key}, i, CASE WHEN total = 1 AND len(run) = 1 THEN run[1]"
                f" ELSE sha256(array_to_string(run, '')) END AS digest FROM {name}_run{n}),"
            )
        return "\n".join(parts)

    def climb(name: str, source: str, key: str, height: int) -> str:
        # <name>_at<n> (..., i, shown, proof): a leaf's place, the digest folded so far, its siblings.
        parts = []
        for n in range(height):
            below = source if n == 0 else f"{name}_at{n}"
            alone = "total = 1 AND len(run) = 1"
            before, after = "array_to_string(run[:a.i % 8], '')", "array_to_string(run[a.i % 8 + 2:], '')"
            parts.append(
                f"{name}_at{n + 1} AS (SELECT a.* REPLACE (a.i // 8 AS i,"
                f" CASE WHEN {alone} THEN shown ELSE sha256({before} || shown || {after}) END AS shown,"
                f" CASE WHEN {alone} THEN proof ELSE proof || {before} || {after} END AS proof)"
                f" FROM {below} a JOIN {name}_run{n} r ON r.{key} = a.{key} AND r.i = a.i // 8),"
            )
        return "\n".join(parts)

    def value(column: str) -> str:
        return f"coalesce(strlen(CAST({column} AS VARCHAR)) || ':' || CAST({column} AS VARCHAR), '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(value(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    lower = f"translate(text, '{CAPITALS}', '{SMALL}')"
    # crc32, bit by bit: after each byte seven more shifts.
    bits = "flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [ord(c)::UBIGINT, 0, 0, 0, 0, 0, 0, 0]))"
    crc = (
        f"xor(4294967295, list_reduce({bits}, lambda c, b:"
        " xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1)), 4294967295::UBIGINT))"
    )
    return rf"""
WITH leaves AS (
  SELECT doc_id, coalesce('=' || lang, '') AS g, {leaf("text")} AS digest,
         CASE WHEN {crc} % 3 = 0 THEN {leaf(lower)} ELSE {leaf("text")} END AS shown FROM documents),
t0 AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, digest) - 1 AS i FROM leaves),
{tree("t", "g", levels)}
s0 AS (SELECT 0 AS one, g, row_number() OVER (ORDER BY g) - 1 AS i, digest FROM t{levels}),
{tree("s", "one", group_levels)}
start AS (SELECT doc_id, g, 0 AS one, i, digest AS leaf, shown, '' AS proof FROM t0),
{climb("t", "start", "g", levels)}
half AS (SELECT a.* REPLACE (s0.i AS i), s0.digest AS subroot FROM t_at{levels} a JOIN s0 USING (g)),
{climb("s", "half", "one", group_levels)}
whole AS (SELECT * FROM s{group_levels})
SELECT doc_id, leaf, subroot, digest AS root, sha256(proof) AS proof_sha256, shown AS folded_root, shown = digest AS verified
FROM s_at{group_levels}, whole
"""


_SQL["op12_merkle_manifest"] = _merkle_sql(levels=8, group_levels=4)


@_query
def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    found = fill_in_middle.transform(docs)
    text = fill_in_middle.restored(F.col("output"), F.col("form"))
    return found.select(
        "document.doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output"), 256).alias("output_sha256"),
        F.sha2(text, 256).alias("restored_sha256"),
    )


_SQL["op13_fill_in_middle"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[ 	-
]*[^ 	-
]+|[ 	-
]+') AS w
  FROM documents),
drawn AS (
  SELECT *, len(w) AS n, ('0x' || h[1:8])::UBIGINT AS h1, ('0x' || h[9:16])::UBIGINT AS h2,
         ('0x' || h[17:24])::UBIGINT AS h3, ('0x' || h[25:32])::UBIGINT AS h4 FROM d),
cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
         WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (
  SELECT *, array_to_string(w[1:a], '') AS p, array_to_string(w[a + 1:b], '') AS m, array_to_string(w[b + 1:], '') AS s
  FROM cut)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
         ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts
"""


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def all_oracles() -> dict[str, str]:
    return dict(_SQL)
