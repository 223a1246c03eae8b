"""Corpus pipeline: quality rules, near-duplicates, secrets, mixing by source, token ids; each stage reads what the last one kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heightgrid.llm.bpe import encode_documents
from heightgrid.llm.mixing import mixed
from heightgrid.llm.near_dup import near_duplicates
from heightgrid.llm.repetition import repetition
from heightgrid.llm.secrets import redact
from heightgrid.session import checkpoint

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: SQL cannot express the stages on words, the network and the merges; tests hold them against plain versions.
ORACLE_SQL = None


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def _kept(docs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Documents with a verdict ``kept``. Ids name documents; rows that repeat an id share one verdict, that of any of them."""
    good = verdicts.where("kept").select(F.col("doc_id").alias("_kept")).distinct()
    return docs.join(good, F.col("doc_id").eqNullSafe(F.col("_kept"))).select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the repetition rules; the verdict is reached row by row, so nothing is joined."""
    return repetition(_plain(docs), carry=True).where("kept").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, similarity 0.8 or more): the one with the smallest id."""
    return _kept(docs, near_duplicates(_plain(docs), percent=80))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark; ``n_chars`` follows the text."""
    return redact(_plain(docs))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed(_plain(docs))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` of every row."""
    return encode_documents(_plain(docs), public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("minhash near-dedup", near_dedup),
    ("secret scans", secret_scan),
    ("mixing sources", mixing),
    ("bpe encoding", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = checkpoint(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
