"""Names, vocabularies and file headers shared by the whole package.

Everything in this module is a fixed value: the words are part of the input and
output file formats (or public Ensembl vocabulary) and have to match exactly.
"""

# --- fixed values: carrier definitions and exclusion reasons, in output order
CARRIER_DEFINITIONS = ("any_lof", "HC", "HC_or_LC")
EXCLUSION_REASONS = (
    "insufficient_dof",
    "rank_deficiency",
    "invalid_or_zero_residual_sd",
    "other",
)

# --- fixed values: file headers
LOF_CARRIER_COLUMNS = (
    "sample_id", "gene_id", "gene_symbol", "has_lof_variant",
    "n_lof_variants", "variant_ids", "lof_classes",
)
PC_RESULT_COLUMNS = (
    "pc_count", "z_threshold", "carrier_definition", "eligible_gene_count",
    "total_observations", "outlier_observations", "carrier_observations",
    "n11", "n10", "n01", "n00",
    "outlier_carrier_rate", "nonoutlier_carrier_rate", "carrier_rate_ratio",
    "odds_ratio", "odds_ratio_corrected_0_5", "fisher_p_value", "fisher_fdr_bh",
)
GENE_QC_COLUMNS = (
    "gene_id", "pc_count", "usable_sample_count", "rank",
    "residual_mean", "residual_sd", "status", "exclusion_reason",
)
ANNOTATION_RESULT_COLUMNS = (
    "z_threshold", "tail", "annotation_family", "annotation_class",
    "ac_class", "ac_kind", "ac_value", "distance_bp",
    "total_observations", "outlier_observations", "nonoutlier_observations",
    "n11", "n10", "n01", "n00",
    "outlier_carrier_rate", "nonoutlier_carrier_rate", "carrier_rate_ratio",
    "odds_ratio", "odds_ratio_corrected_0_5", "fisher_p_value", "fisher_fdr_bh",
)
MINIMA_KEYS = (
    "sample_id", "feature_id", "ac_class", "annotation_family", "annotation_class",
)
MINIMA_COLUMNS = MINIMA_KEYS + ("minimum_distance_bp",)
FEATURE_COLUMNS = ("chrom", "tss", "feature_id")
VAT_REQUIRED_COLUMNS = (
    "chrom", "pos", "ref", "alt", "gene_id", "consequence", "gvs_max_af",
)
VAT_LOFTEE_COLUMN = "LoF"
SWEEP_COLUMNS = (
    "carrier_definition", "pc_count", "n_thresholds", "thresholds_present",
    "median_log_odds_ratio", "median_odds_ratio", "maximum_pc",
    "maximum_median_odds_ratio", "percent_of_maximum",
)

# --- fixed values: tokens that mean "missing", which differ by column
MISSING_PHENOTYPE = ("", ".", "na", "nan")
MISSING_CONSEQUENCE = ("", ".", "na", "nan", "null")
MISSING_FREQUENCY = ("", ".", "na", "null")
MISSING_GENE = ("", ".", "na", "nan", "null")
TRUE_WORDS = ("true", "1", "yes")
FALSE_WORDS = ("false", "0", "no")

# --- fixed values: Ensembl consequence terms from most to least severe
SEVERITY_VERSION = "Ensembl release 116"
CONSEQUENCE_SEVERITY = (
    "transcript_ablation",
    "splice_acceptor_variant",
    "splice_donor_variant",
    "stop_gained",
    "frameshift_variant",
    "stop_lost",
    "start_lost",
    "transcript_amplification",
    "feature_elongation",
    "feature_truncation",
    "inframe_insertion",
    "inframe_deletion",
    "missense_variant",
    "protein_altering_variant",
    "splice_donor_5th_base_variant",
    "splice_region_variant",
    "splice_donor_region_variant",
    "splice_polypyrimidine_tract_variant",
    "incomplete_terminal_codon_variant",
    "start_retained_variant",
    "stop_retained_variant",
    "synonymous_variant",
    "coding_sequence_variant",
    "mature_miRNA_variant",
    "5_prime_UTR_variant",
    "3_prime_UTR_variant",
    "non_coding_transcript_exon_variant",
    "intron_variant",
    "NMD_transcript_variant",
    "non_coding_transcript_variant",
    "coding_transcript_variant",
    "upstream_gene_variant",
    "downstream_gene_variant",
    "TFBS_ablation",
    "TFBS_amplification",
    "TF_binding_site_variant",
    "regulatory_region_ablation",
    "regulatory_region_amplification",
    "regulatory_region_variant",
    "intergenic_variant",
    "sequence_variant",
)

# --- fixed values: tails, families, selection defaults, genotype counters
TAILS = ("absolute", "positive", "negative")
BASELINE = ("baseline", "all_rare_variants")
SELECTION_DEFINITIONS = ("HC", "any_lof")
SELECTION_THRESHOLDS = (-3.0, -4.0, -5.0, -6.0)
PLATEAU_FRACTION = 0.95
GENOTYPE_COUNTERS = (
    "alt_alleles",
    "complete_genotype_calls",
    "fully_missing_genotype_calls",
    "genotype_ac_fallback_alt_alleles",
    "info_ac_alt_alleles",
    "info_genotype_ac_compared_alt_alleles",
    "info_genotype_ac_mismatch_alt_alleles",
    "info_genotype_ac_unchecked_alt_alleles",
    "missing_genotypes",
    "partial_genotype_calls",
    "unavailable_ac_alt_alleles",
)
FREQUENCY_TOLERANCE = 1e-12
