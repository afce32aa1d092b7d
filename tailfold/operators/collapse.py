"""Gene collapse and carrier pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tailfold import vocab
from tailfold.functions.values import class_tokens

FLAGS = ("is_any_lof", "is_hc", "is_hc_or_lc")


def collapse_genes(observations: DataFrame) -> DataFrame:
    """Per (gene, sample) minimum over all features of the gene.

    NULLs are ignored and an all-missing pair stays NULL.  The minimum combines on
    the map side, so a gene with very many features adds one row per map task.
    """
    return observations.groupBy("gene_id", "sample_id").agg(F.min("value").alias("value"))


def carrier_pairs(carriers: DataFrame) -> DataFrame:
    """One row per (sample, gene) of the truthy rows, with one flag per definition."""
    classes = class_tokens(F.col("lof_classes"))
    hc = F.array_contains(classes, "HC")
    lc = F.array_contains(classes, "LC")
    return (
        carriers.where("has_lof")
        .groupBy("sample_id", "gene_id")
        .agg(
            F.lit(True).alias("is_any_lof"),
            F.bool_or(hc).alias("is_hc"),
            F.bool_or(hc | lc).alias("is_hc_or_lc"),
        )
    )


def carrier_definition_counts(pairs: DataFrame) -> DataFrame:
    return pairs.agg(
        *[F.count_if(f).alias(d) for d, f in zip(vocab.CARRIER_DEFINITIONS, FLAGS)]
    )


def flag_observations(observations: DataFrame, pairs: DataFrame) -> DataFrame:
    """Left join of carrier flags; an absent pair is a non-carrier.

    Both sides are unique on (gene, sample), and the collapse already hashed the
    observations on those keys, so only the sparse pair table moves.
    """
    joined = observations.join(pairs, ["gene_id", "sample_id"], "left")
    return joined.select(
        "gene_id", "sample_id", "value",
        *[F.coalesce(F.col(f), F.lit(False)).alias(f) for f in FLAGS],
    )
