"""From documents to token ids: language, near duplicates, benchmark passages, personal data, encoding.

Each stage reads what the one before wrote and decides on all of it. ``run`` applies the stages to ``documents``.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.llm import decontaminate, jaccard, language, pieces, pii
from millwright.session import cut

#: The tokenizer's file.
PIECES = os.environ.get("PIECES_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
#: Texts of a smaller score, in which no language has a fair part, are rejected; undetermined texts have 0.
LEAST_LANGUAGE = 0.2
#: Near duplicates share this percentage of their five-word shingles.
SHINGLE, PERCENT = 5, 80


def beside(docs: DataFrame, step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``step`` with the columns it works on, ``doc_id`` and ``text``; all others wait under other names, as some operators' own may clash."""
    others = {c: f"_own_{c}" for c in docs.columns if c not in ("doc_id", "text")}
    return step(docs.withColumnsRenamed(others)).select(*(F.col(others.get(c, c)).alias(c) for c in docs.columns))


def counted(docs: DataFrame) -> DataFrame:
    """``docs`` with ``n_chars``, where present, as the length of the text."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is determined. A null or letterless text has none. Learns from the texts with a known ``lang``."""
    model = language.train(docs)
    sure = (F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= LEAST_LANGUAGE)
    return beside(docs, lambda own: language.identify(own, model).where(sure))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of each group, null ids last, and one of rows that are equal throughout.

    Rows are told apart by a hash of all their columns, so rows of one id with different texts are documents of their own.
    """
    keyed = docs.withColumn("_key", F.xxhash64(*docs.columns))
    near = jaccard.near_duplicates(keyed.select("_key", "text"), key="_key", size=SHINGLE, percent=PERCENT)
    group = near.select(F.col("_key").alias("_own"), F.col("component_id").alias("_group")).distinct()
    member = keyed.select("_key", "doc_id").distinct().join(group, F.col("_key") == F.col("_own"))
    first = member.groupBy("_group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "_key")).alias("f")).select(F.col("f._key").alias("_first"))
    return keyed.join(first, F.col("_key") == F.col("_first"), "left_semi").dropDuplicates(["_key"]).select(docs.columns)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which a twentieth or more of the words are benchmark passages, and cuts passages out of all others; ``n_chars`` follows."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return counted(beside(docs, lambda own: decontaminate.without_passages(own, benchmark)))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every span of personal data by its kind; ``n_chars``, where present, follows the text."""
    return counted(beside(docs, lambda own: pii.find(own).withColumn("text", pii.masked("text"))))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, the ids of the text, their number, and whether they decode to the text."""
    return pieces.encode(docs.select("doc_id", "text"), pieces.Vocabulary.load(PIECES)).drop("text")


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate_benchmark),
    ("personal_data", mask_personal_data),
    ("encoding", encode_pieces),
]

#: The stages learn models and encode pieces, which SQL cannot say; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs)
    return docs
