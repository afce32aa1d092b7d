"""Variant alleles, allele-feature pairs and carrier minimum distances."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tailfold import vocab
from tailfold.config import AcClass
from tailfold.functions import genotype as G
from tailfold.functions.values import match_gene
from tailfold.operators.ranges import range_join
from tailfold.operators.vat import ALLELE


def alt_alleles(records: DataFrame) -> DataFrame:
    """One row per ALT of VCF records ``(ref, alt, info, format, samples, ...)``.

    Holds the INFO count, the genotype count and the carrier sample positions; ``ac``
    is the INFO value when given, else the genotype count, else NULL when no
    genotype was called at all.  Call-state totals of the record ride along, so the
    long sample array is parsed once and dropped here.
    """
    texts = G.genotype_texts(F.col("samples"), G.genotype_index(F.col("format")))
    called = records.withColumn("alts", F.split("alt", ",")).withColumn("calls", G.calls(texts))
    per_record = called.drop("samples", "format", "alt").withColumns({
        **{f"{name}_calls": c for name, c in G.state_counts(F.col("calls")).items()},
        "any_called": F.exists("calls", lambda c: c["called"] > 0),
        "alt_calls": G.with_alt(F.col("calls")),
        "sample_total": F.size("calls"),
    }).drop("calls")
    # "outer" keeps Spark from testing the array first, which would split each line twice
    exploded = per_record.select("*", F.posexplode_outer("alts").alias("alt_index", "alt")).withColumn(
        "alt_index", F.col("alt_index") + 1)
    counted = exploded.withColumns({
        "complete": (F.col("sample_total") > 0)
        & (F.col("complete_calls") == F.col("sample_total")),
        "info_ac": G.info_ac(F.col("info"), F.col("alt_index")),
        "genotype_ac": G.alt_allele_count(F.col("alt_calls"), F.col("alt_index")),
        "carrier_positions": G.alt_carriers(F.col("alt_calls"), F.col("alt_index")),
    })
    counted = counted.withColumn(
        "ac", F.coalesce("info_ac", F.when(F.col("any_called"), F.col("genotype_ac"))))
    return counted.drop("alts", "alt_calls", "info", "sample_total")


def allele_counters(alleles: DataFrame, by: list[str]) -> DataFrame:
    """Call states, and where each ALT took its allele count from."""
    given = F.col("info_ac").isNotNull()
    compared = given & F.col("complete")
    per_record = {
        "complete_genotype_calls": F.col("complete_calls"),
        "partial_genotype_calls": F.col("partial_calls"),
        "fully_missing_genotype_calls": F.col("fully_missing_calls"),
        "missing_genotypes": F.col("partial_calls") + F.col("fully_missing_calls"),
    }
    first = F.col("alt_index") == 1
    return alleles.groupBy(*by).agg(
        F.count_if(first).alias("extracted_records"),
        F.count(F.lit(1)).alias("alt_alleles"),
        *[F.coalesce(F.sum(F.when(first, c)), F.lit(0)).alias(n) for n, c in per_record.items()],
        F.count_if(given).alias("info_ac_alt_alleles"),
        F.count_if(~given & F.col("any_called")).alias("genotype_ac_fallback_alt_alleles"),
        F.count_if(~given & ~F.col("any_called")).alias("unavailable_ac_alt_alleles"),
        F.count_if(compared).alias("info_genotype_ac_compared_alt_alleles"),
        F.count_if(compared & (F.col("info_ac") != F.col("genotype_ac")))
        .alias("info_genotype_ac_mismatch_alt_alleles"),
        F.count_if(given & ~F.col("complete")).alias("info_genotype_ac_unchecked_alt_alleles"),
        F.count("ac").alias("classified_alt_alleles"),
    )


def with_frequency(alleles: DataFrame, frequencies: DataFrame) -> DataFrame:
    """Left join of allele frequencies; ``status`` stays NULL for unknown alleles."""
    return alleles.join(frequencies.select(*ALLELE, "status", "maf"), ALLELE, "left")


def rare(alleles: DataFrame, maximum_maf: float) -> DataFrame:
    return alleles.where((F.col("status") == "valid") & (F.col("maf") <= maximum_maf))


def feature_pairs(alleles: DataFrame, features: DataFrame, annotations: DataFrame,
                  max_distance: int) -> DataFrame:
    """Rare alleles near a feature, with the annotation of that feature's gene."""
    near = range_join(alleles, features, max_distance)
    keyed = near.withColumn("gene_key", match_gene(F.col("feature_id")))
    marked = annotations.withColumn("gene_matched", F.lit(True))
    joined = keyed.join(marked, [*ALLELE, "gene_key"], "left")
    return joined.withColumn("gene_matched", F.coalesce("gene_matched", F.lit(False)))


def pair_counters(pairs: DataFrame, max_distance: int, by: list[str]) -> DataFrame:
    return pairs.groupBy(*by).agg(
        F.count(F.lit(1)).alias("variant_feature_pairs"),
        F.count_if(F.col("distance") == max_distance).alias("boundary_variant_feature_pairs"),
        F.count_if("gene_matched").alias("gene_matched_variant_feature_pairs"),
        F.count_if(~F.col("gene_matched")).alias("gene_unmatched_variant_feature_pairs"),
    )


def class_matches(ac_column, ac: list[AcClass]):
    """Array of the configured AC class labels an allele count belongs to."""
    labels = [
        F.when(ac_column == c.value if c.kind == "exact" else ac_column <= c.value, c.label)
        for c in ac
    ]
    return F.array_compact(F.array(*labels))


def annotation_keys(consequences, consequence="consequence", loftee="loftee"):
    """Array of (family, class): baseline always, the others when they apply."""
    def key(family, label):
        return F.struct(family.alias("annotation_family"), label.alias("annotation_class"))

    keys = [key(F.lit(vocab.BASELINE[0]), F.lit(vocab.BASELINE[1]))]
    if consequences:
        listed = F.col(consequence).isin(*consequences)
        keys.append(F.when(listed, key(F.lit("consequence"), F.col(consequence))))
    called = F.col(loftee).isin("HC", "LC")
    keys.append(F.when(called, key(F.lit("loftee"), F.col(loftee))))
    return F.array_compact(F.array(*keys))


def explode_strata(pairs: DataFrame, ac: list[AcClass], consequences) -> DataFrame:
    """Repeat allele-feature pairs per AC class and annotation key they belong to."""
    classed = pairs.withColumn("ac_class", F.explode(class_matches(F.col("ac"), ac)))
    return classed.withColumn("_key", F.explode(annotation_keys(consequences))).select(
        "*", "_key.*").drop("_key")


def minimum_distances(rows: DataFrame) -> DataFrame:
    """Smallest distance per carrier key.

    Minimum is associative and idempotent: it combines before the shuffle, and
    results of separate runs can be reduced again by the same function.
    """
    distance = "minimum_distance_bp" if "minimum_distance_bp" in rows.columns else "distance"
    return rows.groupBy(*vocab.MINIMA_KEYS).agg(F.min(distance).alias("minimum_distance_bp"))


def carrier_minima(pairs: DataFrame, sample_names: DataFrame, ac: list[AcClass],
                   consequences, by: tuple[str, ...] = ()) -> DataFrame:
    """Minima of all carriers, by feature columns ``by`` too.

    ``sample_names`` maps position to shared sample ID; carriers without an ID should be left out of
    the arrays before (``shared_carriers``), because they are dropped last here.
    """
    strata = explode_strata(pairs.where(F.size("carrier_positions") > 0), ac, consequences)
    keys = (*by, "feature_id", "ac_class", "annotation_family", "annotation_class")
    carried = strata.select(*keys, "distance", F.explode("carrier_positions").alias("position"))
    per_position = carried.groupBy("position", *keys).agg(
        F.min("distance").alias("minimum_distance_bp"))
    named = per_position.join(sample_names, "position")
    return named.select(*by, *vocab.MINIMA_COLUMNS)


def shared_carriers(positions: list[int]):
    """Carriers of an allele among the given sample positions."""
    kept = F.array(*[F.lit(p) for p in positions]) if positions else F.array().cast("array<int>")
    return F.array_intersect("carrier_positions", kept)
