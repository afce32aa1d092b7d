"""Registered queries: every operator group on the whole driver tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tailfold import config, vocab
from tailfold.functions import annotation as A
from tailfold.functions import values as V
from tailfold.functions.tables import fisher_exact, table_statistics
from tailfold.operators import carriers as C
from tailfold.operators import cells, collapse, plateau, ranges, residuals
from tailfold.operators import vat as T
from tailfold.operators.fdr import benjamini_hochberg
from tailfold.operators.samples import overlap_counts, shared_samples
from tailfold.plans import lof_pc, merge, rare_variant
from tailfold.plans import surrogates as S
from tailfold.plans.file_queries import FILE_QUERIES
from tailfold.session import stage
from tailfold.sources import gtf

DISTANCE = 100
WINDOW = 100
CHUNK = 30
MAX_MAF = 0.01
EXACT_AC, CUMULATIVE_AC = (1, 2, 3), (2, 5)
Z_HIGH = (1.0, 1.5)
DISTANCES = (25, 100)
STAT_COLUMNS = (
    "outlier_carrier_rate", "nonoutlier_carrier_rate", "carrier_rate_ratio", "odds_ratio",
    "odds_ratio_corrected_0_5", "fisher_p_value", "fisher_fdr_bh")


def rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


# ------------------------------------------------ parsing and normalisation


def identifier_normalisation(spark, d):
    part = S.table(spark, d, "part")
    number, size = S.text("p_partkey"), S.text("p_size")
    versioned = F.concat(S.ensembl(F.col("p_partkey")), F.lit("."), size)
    odd = F.concat(F.lit("GENE."), size)
    composite = F.concat(F.lit("chr1:10:20:clu_"), number, F.lit("_+:"), versioned)
    two = F.concat(versioned, F.lit("|"), S.ensembl(F.col("p_size")))
    mixed = F.when(F.col("p_size") % 3 == 0, composite).when(F.col("p_size") % 3 == 1, two).otherwise(
        F.concat(F.lit("x"), versioned))
    return part.select(
        "p_partkey", V.drop_version(versioned).alias("plain_id"),
        V.drop_version(F.concat(versioned, F.lit("."), size)).alias("one_suffix"),
        V.match_gene(odd).alias("kept_id"), V.match_gene(versioned).alias("matched_id"),
        V.single_gene(mixed).alias("token"), V.gene_problem(mixed).alias("problem"),
        V.strip(F.concat(F.lit("\t "), F.col("p_name"), F.lit(" \t"))).alias("trimmed"),
    )


def value_parsing(spark, d):
    lines = S.table(spark, d, "lineitem")
    word = F.element_at(
        F.array(*[F.lit(w) for w in (" Yes", "TRUE", "1", "no ", "False", "0", "maybe")]),
        F.col("l_linenumber"))
    number = F.when(F.col("l_discount") < 0.005, " NA").when(F.col("l_tax") < 0.005, "1d").when(
        F.col("l_tax") > 0.075, "inf").otherwise(S.text("l_extendedprice"))
    return lines.select(
        V.truth(word).alias("truth"), V.is_bad_phenotype(number).alias("bad"),
        V.phenotype(number).alias("value"), "l_linestatus",
    ).groupBy("truth", "bad", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("value").alias("n_values"),
        F.min("value").alias("lowest"), F.max("value").alias("highest"))


def phenotype_bed_long(spark, d):
    bed = S.bed(spark, d)
    rows = bed.rows.withColumn("gene_id", V.single_gene(F.col("feature")))
    samples = bed.sample_table()
    cells = bed.long(rows, samples).groupBy("sample_id", "chrom").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("value").alias("n_values"),
        F.count_if("bad").alias("n_bad"), F.min("value").alias("lowest"), F.max("value").alias("highest"))
    # A gene counts for the samples that its widest line reaches, so genes meet once and not per sample;
    # one row per chromosome and width is melted.
    widest = rows.groupBy("chrom", "gene_id").agg(F.max(F.size("fields")).alias("width"))
    widths = widest.groupBy("chrom", "width").agg(F.count("gene_id").alias("genes")).select(
        "chrom", "genes", F.array_repeat(F.lit("NA"), F.col("width")).alias("fields"))
    genes = bed.long(widths, samples).groupBy("sample_id", "chrom").agg(F.sum("genes").alias("n_genes"))
    return cells.join(genes, ["sample_id", "chrom"], "left").select(
        "sample_id", "chrom", "n_rows", "n_values", "n_bad",
        F.coalesce("n_genes", F.lit(0)).alias("n_genes"), "lowest", "highest")


def phenotype_bed_validation(spark, d):
    bed = S.bed(spark, d)
    shifted = bed.rows.withColumn(
        "end", F.when(F.col("chrom") == "chr7", F.concat("end", F.lit("0"))).when(
            F.col("chrom") == "chr6", "x").otherwise(F.col("end")))
    problem = F.coalesce(bed.structure_problem(), V.gene_problem(F.col("feature")),
                         bed.value_problem())
    return shifted.select("chrom", problem.alias("problem")).groupBy("chrom", "problem").agg(
        F.count(F.lit(1)).alias("n_rows"))


def gtf_coding_genes(spark, d):
    return gtf.coding_records(gtf.gene_records(S.gtf_lines(spark, d))).groupBy("gene_id").agg(
        F.count(F.lit(1)).alias("n_records"))


def carrier_definitions(spark, d):
    return collapse.carrier_pairs(S.lof_carriers(spark, d))


def carrier_definition_counts(spark, d):
    return collapse.carrier_definition_counts(carrier_definitions(spark, d))


# -------------------------------------------------------- samples and genes


def gene_min_collapse(spark, d):
    rows = S.brand_lines(spark, d).select(
        "gene_id", "sample_id",
        F.when(F.col("l_discount") > 0.005, F.col("l_extendedprice")).alias("value"))
    return collapse.collapse_genes(rows)


def sample_intersection(spark, d):
    supplier = S.table(spark, d, "supplier").select(S.text("s_suppkey").alias("sample_id"))
    customer = S.table(spark, d, "customer").where("c_acctbal > 0").select(
        S.text("c_custkey").alias("sample_id"))
    orders = S.table(spark, d, "orders").select(S.text("o_custkey").alias("sample_id"))
    return shared_samples(supplier, customer, orders)


def sample_overlap_counts(spark, d):
    supplier = S.table(spark, d, "supplier").where("s_acctbal > 1000").select(
        S.text("s_suppkey").alias("sample_id"))
    customer = S.table(spark, d, "customer").where("c_acctbal > 0").select(
        S.text("c_custkey").alias("sample_id"))
    return overlap_counts(supplier, customer)


def flagged_observations(spark, d):
    pairs = collapse.carrier_pairs(S.lof_carriers(spark, d))
    return rounded(collapse.flag_observations(S.observations(spark, d), pairs), "value")


# ------------------------------------------------------------- residual models


def standardized_expression(spark, d):
    return rounded(residuals.standardize(S.observations(spark, d)).drop("value"), "z")


def residual_z_scores(spark, d):
    z = residuals.residual_z(S.observations(spark, d), S.design(spark, d), 0, S.PC_COUNTS)
    return rounded(z, "z")


def _sparse_fits(spark, d):
    design = S.table(spark, d, "supplier").select(
        S.text("s_suppkey").alias("sample_id"),
        F.array((F.col("s_suppkey") % 2).cast("double")).alias("x"))
    flagged = S.sparse_observations(spark, d).select(
        "*", *[F.lit(False).alias(f) for f in collapse.FLAGS])
    return residuals.gene_sweep(flagged, design, 0, [0, 1], [-1.0])


def residual_exclusions(spark, d):
    return rounded(_sparse_fits(spark, d), "residual_sd").select(
        "gene_id", "pc_count", "usable", "rank", "residual_sd", "reason")


def sweep_exclusion_totals(spark, d):
    return cells.sweep_totals(_sparse_fits(spark, d)).select(
        "pc_count", "eligible_gene_count", "total_observations", *vocab.EXCLUSION_REASONS)


def lof_pc_enrichment(spark, d):
    return _lof_pc(spark, d, S.design(spark, d), 0, S.PC_COUNTS)


def lof_pc_with_covariate(spark, d):
    return _lof_pc(spark, d, S.design(spark, d), 1, (0, 1))


def lof_pc_intercept_only(spark, d):
    return _lof_pc(spark, d, S.design(spark, d), 0, (0,))


def _lof_pc(spark, d, design, fixed, pc_counts):
    pairs = collapse.carrier_pairs(S.lof_carriers(spark, d))
    rows = lof_pc.enrichment(
        S.observations(spark, d), design, pairs, fixed, pc_counts, S.Z_LOW)
    return rounded(rows.drop("threshold_order", "definition_order"), *STAT_COLUMNS)


# ------------------------------------------------------- tables and selection


def fisher_two_sided(spark, d):
    p = fisher_exact("n11", "n10", "n01", "n00")
    return rounded(S.supplier_tables(spark, d).withColumn("fisher_p_value", p), "fisher_p_value")


def table_rates_and_odds(spark, d):
    t = S.supplier_tables(spark, d)
    stats = table_statistics(F.col("n11"), F.col("n11") + F.col("n01"), F.col("n10"),
                             F.col("n10") + F.col("n00"))
    return rounded(t.withColumns(stats), *stats)


def bh_fdr(spark, d):
    share = F.col("o_totalprice") / 500000.0
    orders = S.table(spark, d, "orders").select(
        "o_orderkey", (share * share * share * share).alias("p"))
    adjusted = benjamini_hochberg(orders, p="p", out="q")
    return rounded(adjusted, "p", "q")


def shard_merge_global_fdr(spark, d):
    scored = fisher_two_sided(spark, d).withColumn(
        "shard", F.pmod(F.hash("l_returnflag"), F.lit(SHARDS)))
    shards = [benjamini_hochberg(scored.where(F.col("shard") == i).drop("shard"))
              for i in range(SHARDS)]
    return rounded(merge.merged_fdr(shards), "fisher_fdr_bh")


# Shards by hash, whatever values the split column has.
SHARDS = 3
SWEEP_BANDS = S.SWEEP_BANDS


def median_log_odds(spark, d):
    points = plateau.median_log_odds(S.sweep_results(spark, d), SWEEP_BANDS)
    return rounded(points, "median_log_odds_ratio", "median_odds_ratio")


def plateau_pc_count(spark, d):
    points = plateau.median_log_odds(S.sweep_results(spark, d), SWEEP_BANDS)
    return rounded(plateau.plateau_entry(points), "max_median_log_odds_ratio",
                   "plateau_log_odds_ratio")


def sweep_percent_of_maximum(spark, d):
    table = plateau.percent_of_maximum(plateau.sweep_groups(S.sweep_results(spark, d), SWEEP_BANDS))
    return rounded(table, "median_log_odds_ratio", "median_odds_ratio",
                   "maximum_median_odds_ratio", "percent_of_maximum")


# --------------------------------------------------------- variants and VCF


def outlier_tails(spark, d):
    lines = S.table(spark, d, "lineitem").select(
        "l_returnflag", ((F.col("l_extendedprice") - 50000.0) / 20000.0).alias("value"))
    return rare_variant.outlier_counts(lines, (0.5, 1.0, 2.0), ["l_returnflag"])


def phenotype_totals(spark, d):
    return cells.observation_totals(S.feature_observations(spark, d), Z_HIGH, "absolute")


def vcf_alt_alleles(spark, d):
    alleles = C.alt_alleles(S.vcf_records(spark, d))
    carriers = F.array_join(F.sort_array(F.transform("carrier_positions", lambda p: p)), ",")
    return alleles.select(
        "chrom", "pos", "ref", "alt", "alt_index", "info_ac", "genotype_ac", "ac", "complete",
        "any_called", carriers.alias("carriers"))


def vcf_allele_counters(spark, d):
    return C.allele_counters(C.alt_alleles(S.vcf_records(spark, d)), ["chrom"])


def ac_class_membership(spark, d):
    ac = config.ac_classes(EXACT_AC, CUMULATIVE_AC)
    matched = S.variants(spark, d).withColumn(
        "ac_class", F.explode(C.class_matches(F.col("ac"), ac)))
    return matched.groupBy("chrom", "ac_class").agg(F.count(F.lit(1)).alias("n_alleles"))


# ------------------------------------------------------ transcript annotation


def _parsed(spark, d):
    return T.interpret(S.transcript_rows(spark, d))


def _staged(spark, d, *columns):
    """Parsed once, in the columns needed, for plans that read the rows more than once."""
    rows = _parsed(spark, d)
    return stage(rows.select(*columns) if columns else rows, "annotation-rows")


def consequence_severity(spark, d):
    rows = _parsed(spark, d)
    worst = A.consequence_of_rank(F.col("consequence_rank"))
    return rows.groupBy(worst.alias("consequence"), "loftee_state").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.size("terms")).alias("n_terms"),
        F.sum(F.size("unknown")).alias("n_unknown"))


def transcript_collapse(spark, d):
    return T.gene_annotations(_parsed(spark, d))


def minor_allele_frequency(spark, d):
    frequency = A.frequency(F.col("gvs_max_af"))
    rows = S.transcript_rows(spark, d).select("gvs_max_af", frequency.alias("f"))
    return rows.groupBy("gvs_max_af", "f.status", "f.raw_af", "f.maf", "f.converted").agg(
        F.count(F.lit(1)).alias("n_rows"))


def frequency_consistency(spark, d):
    return T.allele_frequencies(_parsed(spark, d))


def unknown_consequence_terms(spark, d):
    return T.unknown_term_counts(_parsed(spark, d), ["chrom"])


def vat_counters(spark, d):
    rows = _staged(spark, d)
    by = ["chrom"]
    whole = F.to_json(F.struct("pos", "ref", "alt", "gene_id", "consequence", "gvs_max_af", "LoF"))
    return (
        T.row_counters(rows, by)
        .join(T.duplicate_rows(rows.withColumn("line", whole), by), by)
        .join(T.frequency_counters(T.allele_frequencies(rows), MAX_MAF, by), by)
        .join(T.pair_counters(T.gene_annotations(rows), S.CONSEQUENCES, by), by)
    )


# ------------------------------------------------------------ ranges, windows


def tss_windows(spark, d):
    return ranges.tss_windows(S.features(spark, d), WINDOW)


def query_chunks(spark, d):
    return ranges.query_chunks(S.features(spark, d), WINDOW, CHUNK)


def variants_in_query_windows(spark, d):
    windows = ranges.query_windows(S.features(spark, d), WINDOW)
    located = ranges.within_windows(S.variants(spark, d), windows, WINDOW, CHUNK)
    return located.select("o_orderkey", "chrom", "pos", F.col("chunk.window").alias("window_start"),
                          F.col("chunk.piece").alias("piece"))


def variant_feature_range_join(spark, d):
    pairs = ranges.range_join(
        S.variants(spark, d), S.features(spark, d).select(*vocab.FEATURE_COLUMNS), DISTANCE)
    return pairs.select("chrom", "pos", "tss", "feature_id", "distance")


def _rare_pairs(spark, d):
    parsed = _staged(spark, d, *T.ALLELE, "ord", "frequency", "gene_key", "consequence_rank", "loftee_rank")
    known = C.with_frequency(S.variants(spark, d), T.allele_frequencies(parsed))
    features = S.features(spark, d).select(*vocab.FEATURE_COLUMNS)
    return C.feature_pairs(
        C.rare(known, MAX_MAF), features, T.gene_annotations(parsed), DISTANCE)


def gene_matched_pairs(spark, d):
    return C.pair_counters(_rare_pairs(spark, d), DISTANCE, ["chrom"])


def _minima(spark, d):
    ac = config.ac_classes(EXACT_AC, CUMULATIVE_AC)
    strata = C.explode_strata(_rare_pairs(spark, d), ac, S.CONSEQUENCES)
    carried = strata.join(S.carriers_of(spark, d), F.col("o_orderkey") == F.col("l_orderkey"))
    return carried.select(*vocab.MINIMA_KEYS, "distance", "alt")


def carrier_minimum_distance(spark, d):
    return C.minimum_distances(_minima(spark, d))


def gather_minimum_distance(spark, d):
    rows = stage(_minima(spark, d), "carried").withColumn(
        "shard", F.pmod(F.hash("alt"), F.lit(SHARDS)))
    shards = [C.minimum_distances(rows.where(F.col("shard") == i)) for i in range(SHARDS)]
    return C.minimum_distances(reduce(DataFrame.unionByName, shards))


def carrier_key_counts(spark, d):
    return carrier_minimum_distance(spark, d).groupBy("annotation_family").agg(
        F.count(F.lit(1)).alias("n_keys"), F.count_distinct("feature_id").alias("n_features"))


def annotation_enrichment(spark, d):
    ac = config.ac_classes(EXACT_AC, CUMULATIVE_AC)
    annotations = config.annotation_classes(S.CONSEQUENCES, True)
    rows = rare_variant.enrichment(
        S.feature_observations(spark, d), carrier_minimum_distance(spark, d), Z_HIGH, DISTANCES,
        "absolute", ac, annotations)
    return rounded(rows.select(*vocab.ANNOTATION_RESULT_COLUMNS), *STAT_COLUMNS)


QUERIES = {
    f.__name__: f for f in (
        identifier_normalisation, value_parsing, phenotype_bed_long, phenotype_bed_validation,
        gtf_coding_genes, carrier_definitions, carrier_definition_counts, gene_min_collapse,
        sample_intersection, sample_overlap_counts, flagged_observations,
        standardized_expression, residual_z_scores, residual_exclusions,
        sweep_exclusion_totals, lof_pc_enrichment,
        lof_pc_with_covariate, lof_pc_intercept_only, fisher_two_sided, table_rates_and_odds,
        bh_fdr, shard_merge_global_fdr, median_log_odds, plateau_pc_count,
        sweep_percent_of_maximum, outlier_tails, phenotype_totals, vcf_alt_alleles,
        vcf_allele_counters, ac_class_membership, consequence_severity, transcript_collapse,
        minor_allele_frequency, frequency_consistency, unknown_consequence_terms, vat_counters,
        tss_windows, query_chunks, variants_in_query_windows, variant_feature_range_join,
        gene_matched_pairs, carrier_minimum_distance, gather_minimum_distance,
        carrier_key_counts, annotation_enrichment,
    )
}
QUERIES |= FILE_QUERIES
