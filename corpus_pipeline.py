"""The corpus pipeline: documents in known languages, once each, unseen in tests, without secrets, as tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import bpe, decontaminate, language_id, near_dedup, secret_scan
from tidewell.llm.queries import token_digests, vocabulary
from tidewell.session import materialize

#: A document goes where the marginals of its words are this near to uniform; see language_id.predict.
LEAST_SURE = 0.1


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose words tell languages, one or several; those without letters go.

    Where no language could be learned, all documents are passed on.
    """
    field = language_id.learn(docs)
    if field is None:
        return docs
    found = language_id.predict(docs, field, evidence=True)
    known = (F.col("lang_pred") != language_id.UNKNOWN) & (F.col("sure") >= LEAST_SURE)
    return found.filter(known).select("document.*")


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words a shingle, a similarity of 0.8."""
    return near_dedup.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no ten consecutive words of a benchmark item, nor a whole item of fewer words."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with credentials that are no copied examples cut from its text."""
    return secret_scan.redacted(docs)


def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, the token ids, and digests of these and of what they decode to."""
    path, pattern = vocabulary()
    tokens = bpe.round_trip(docs, path, pattern)
    return tokens.select("document.doc_id", "document.lang", "document.source", "ids", *token_digests())


STAGES = [
    ("language", known_language),
    ("near_dedup", without_near_copies),
    ("decontamination", without_benchmark),
    ("secrets", without_secrets),
    ("tokens", as_tokens),
]

#: SQL can express neither the fitted language model nor the tokens.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each on what the one before has stored."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
