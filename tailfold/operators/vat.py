"""Transcript annotations reduced to one row per allele and per allele-gene pair."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tailfold import vocab
from tailfold.functions import annotation as A
from tailfold.functions.values import match_gene, strip, to_double

ALLELE = ["chrom", "pos", "ref", "alt"]


def interpret(rows: DataFrame) -> DataFrame:
    """Typed transcript rows from text columns.

    Input: ``chrom, pos (long), ref, alt, gene_id, consequence, gvs_max_af``, an
    order column ``ord``, optionally ``LoF``; other columns pass through.
    """
    has_lof = vocab.VAT_LOFTEE_COLUMN in rows.columns
    lof = F.col(vocab.VAT_LOFTEE_COLUMN) if has_lof else F.lit(None).cast("string")
    # two steps: what several results need is worked out once
    parsed = rows.withColumns({
        "_af": to_double(F.col("gvs_max_af")),
        "_lof": F.upper(strip(lof)),
        "terms": A.consequence_terms(F.col("consequence")),
    }).withColumn("_ranks", A.term_ranks(F.col("terms")))
    label = F.col("_lof")
    state = (
        F.when(label == "HC", "hc").when(label == "LC", "lc")
        .when(A.is_missing_label(label), "missing").when(label.isNotNull(), "unrecognized")
    )
    gene = F.col("gene_id")
    return parsed.withColumns({
        "frequency": A.frequency(F.col("gvs_max_af"), F.col("_af")),
        "gene_key": F.when(~A.is_missing_gene(gene), match_gene(gene)),
        "consequence_rank": A.severity_rank(F.col("_ranks")),
        "unknown": F.when(F.array_contains("_ranks", 0), A.unknown_terms(F.col("terms")))
        .otherwise(F.array().cast("array<string>")),
        "loftee_rank": A.loftee_rank(label),
        "loftee_state": state,
    }).drop("_af", "_lof", "_ranks")


def allele_frequencies(rows: DataFrame) -> DataFrame:
    """One frequency per allele with the status of all its transcript rows.

    The first valid value is the anchor.  A later valid value further away than the
    tolerance makes the allele inconsistent; otherwise the last invalid status
    sticks.  Comparing the extremes with the anchor finds any such value, so one
    map-side combined aggregation is enough.
    """
    status, raw = F.col("frequency.status"), F.col("frequency.raw_af")
    valid_order = F.when(status == "valid", F.col("ord"))
    invalid_order = F.when(status != "valid", F.col("ord"))
    grouped = rows.groupBy(*ALLELE).agg(
        F.min_by(F.struct(raw.alias("raw_af"), F.col("frequency.maf").alias("maf")),
                 valid_order).alias("anchor"),
        F.min(raw).alias("lo"), F.max(raw).alias("hi"),
        F.max_by(status, invalid_order).alias("problem"),
    )
    anchor = F.col("anchor.raw_af")
    apart = (F.col("hi") - anchor > vocab.FREQUENCY_TOLERANCE) | (
        anchor - F.col("lo") > vocab.FREQUENCY_TOLERANCE)
    return grouped.select(
        *ALLELE,
        F.when(apart, "inconsistent").otherwise(
            F.coalesce("problem", F.lit("valid"))).alias("status"),
        anchor.alias("raw_af"), F.col("anchor.maf").alias("maf"),
    )


def gene_annotations(rows: DataFrame) -> DataFrame:
    """Most severe recognised consequence and best LoF confidence per allele-gene."""
    grouped = rows.where("gene_key IS NOT NULL").groupBy(*ALLELE, "gene_key").agg(
        F.min("consequence_rank").alias("c"), F.min("loftee_rank").alias("l"))
    return grouped.select(
        *ALLELE, "gene_key",
        A.consequence_of_rank(F.col("c")).alias("consequence"),
        A.loftee_of_rank(F.col("l")).alias("loftee"),
    )


def row_counters(rows: DataFrame, by: list[str]) -> DataFrame:
    """Counters over transcript rows (frequency range, terms, LoF states)."""
    state = F.col("loftee_state")
    in_gene = F.col("gene_key").isNotNull()
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("vat_rows"),
        F.max("frequency.raw_af").alias("observed_raw_gvs_max_af"),
        F.count_if("frequency.converted").alias("converted_gvs_max_af_values"),
        F.coalesce(F.sum(F.size("terms")), F.lit(0)).alias("consequence_terms_parsed"),
        F.coalesce(F.sum(F.size("terms") - F.size("unknown")), F.lit(0))
        .alias("recognized_consequence_terms"),
        F.coalesce(F.sum(F.size("unknown")), F.lit(0)).alias("unknown_consequence_rows"),
        *[F.count_if(in_gene & (state == s)).alias(f"loftee_{s}_values")
          for s in ("hc", "lc", "missing", "unrecognized")],
    )


def duplicate_rows(rows: DataFrame, by: list[str], whole: str = "line") -> DataFrame:
    """Number of repeats of identical rows; hot repeats combine on the map side."""
    copies = rows.groupBy(*by, whole).agg((F.count(F.lit(1)) - 1).alias("extra"))
    return copies.groupBy(*by).agg(F.sum("extra").alias("duplicate_vat_rows"))


def unknown_term_counts(rows: DataFrame, by: list[str]) -> DataFrame:
    exploded = rows.select(*by, F.explode("unknown").alias("term"))
    return exploded.groupBy(*by, "term").agg(F.count(F.lit(1)).alias("row_count"))


def frequency_counters(frequencies: DataFrame, maximum_maf: float, by: list[str]) -> DataFrame:
    status = F.col("status")
    return frequencies.groupBy(*by).agg(
        F.count(F.lit(1)).alias("unique_vat_alleles"),
        *[F.count_if(status == s).alias(f"{s}_frequency_alleles")
          for s in ("missing", "non_numeric", "out_of_range", "inconsistent")],
        F.count_if((status == "valid") & (F.col("maf") > maximum_maf))
        .alias("above_maf_threshold_alleles"),
    )


def pair_counters(annotations: DataFrame, consequences, by: list[str]) -> DataFrame:
    return annotations.groupBy(*by).agg(
        F.count(F.lit(1)).alias("unique_vat_allele_gene_pairs"),
        F.count_if(F.col("consequence").isin(*consequences) if consequences else F.lit(False))
        .alias("configured_consequence_annotations"),
    )


