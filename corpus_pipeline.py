"""A corpus pipeline of five stages; each reads what its predecessor has written.

Rejected documents, exact copies and near copies go; what is left is put into the order of the
mixture and encoded.  All stages but the last return the columns of ``documents``; the last gives the
place of every document in the mixture as columns, because files keep no order between them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tailfold.llm import exact_dedup, mixing, ngram_join, pieces, quality, settings
from tailfold.session import stage


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the classifier rejects; labels of held-out rows teach nothing."""
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal normalised texts the smallest doc_id stays."""
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every component of near copies the smallest doc_id stays."""
    return ngram_join.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mixture."""
    return mixing.mixed(docs, settings.MIX_PARTS, settings.MIX_REST_PARTS,
                        settings.MIX_BLOCK_DOCS, settings.MIX_SEED)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests per document, with its ``lane``, ``slot`` and ``position``.

    The schedule depends on ids and sources only, so it is the one that the stage before has used.
    """
    placed = mixing.schedule(
        docs.select("doc_id", "source", "text"), settings.MIX_PARTS, settings.MIX_REST_PARTS,
        settings.MIX_BLOCK_DOCS, settings.MIX_SEED)
    return pieces.encoded(placed, extra=("lane", "slot", "position"))


STAGES = [
    ("quality_classifier", keep_quality),
    ("exact_dedup", drop_exact_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("mixing", mix_sources),
    ("sentencepiece", encode_pieces),
]

# The network and the pieces are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
