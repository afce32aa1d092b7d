"""Rare-variant enrichment near TSS by allele count, distance and annotation."""

from __future__ import annotations

import platform
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tailfold import __version__, config, files, sinks, vocab
from tailfold.functions.values import outlier
from tailfold.operators import carriers as C
from tailfold.operators import cells, ranges
from tailfold.operators import vat as T
from tailfold.operators.samples import overlap_counts
from tailfold.session import stage
from tailfold.sources import documents as docs
from tailfold.sources import regions, tables, text
from tailfold.sources import vat as vat_source
from tailfold.sources import vcf as vcf_source
from tailfold.sources.bed import PhenotypeBed, read_bed

# fixed values: sentences and names of the summary document
LIMITATION = (
    "Pooled Fisher tests are screening statistics because samples and features recur "
    "as observations; use a dependence-aware model for confirmatory inference.")
TSS_CONVENTION = "TSS equals BED end; distance boundaries are inclusive."
PROVENANCE_STATES = ("generated", "supplied", "unknown")


# ------------------------------------------------------------ phenotypes


def _features_of(bed: PhenotypeBed, check_values: bool) -> DataFrame:
    """Feature rows with their TSS and the first rule each one breaks."""
    problem = [bed.structure_problem(), F.when(F.col("feature") == "", "an empty feature ID")]
    if check_values:
        problem.append(bed.value_problem())
    return bed.rows.select(
        "ord", "fields", "chrom", F.col("end").try_cast("bigint").alias("tss"),
        F.col("feature").alias("feature_id"), F.coalesce(*problem).alias("problem"))


def _survey(bed: PhenotypeBed, features: DataFrame) -> DataFrame:
    """Staged ``(feature_id, chrom, tss, ord)``; raises on any broken or repeated row."""
    table = stage(features.select("ord", "chrom", "tss", "feature_id", "problem"), "bed-features")
    text.fail_on_violation(table, F.col("problem"), "phenotype BED", bed.lines)
    repeated = table.groupBy("feature_id").count().where("count > 1").first()
    if repeated is not None:
        raise ValueError(f"duplicate feature ID: {repeated.feature_id}")
    return table.drop("problem")


def prepare_phenotypes(spark: SparkSession, phenotype_bed, vcf_samples, chromosomes,
                       z_thresholds, tail, feature_output, sample_output, qc_output) -> None:
    """Feature table, shared samples and overlap counters for the later steps."""
    selected = config.chromosomes(chromosomes)
    thresholds = config.outlier_thresholds(z_thresholds)
    config.tail_mode(tail)
    vcf_side = tables.read_samples(spark, vcf_samples)
    bed = read_bed(spark, phenotype_bed, trim_samples=False)
    bed_side = bed.sample_table()
    overlap = overlap_counts(bed_side, vcf_side).first()
    if not overlap.shared_sample_count:
        raise ValueError("no shared BED and VCF samples")
    shared = bed_side.join(vcf_side.select("sample_id"), "sample_id", "left_semi")
    sinks.write_table(sample_output, shared, ["sample_idx"], ["sample_id"],
                      header=False)

    features = _features_of(bed, check_values=True)
    table = _survey(bed, features)
    per_chrom = {r.chrom: r.n for r in table.where(F.col("chrom").isin(*selected))
                 .groupBy("chrom").agg(F.count(F.lit(1)).alias("n")).collect()}
    absent = [c for c in selected if c not in per_chrom]
    if absent:
        raise ValueError("requested chromosomes are absent from BED: " + ", ".join(absent))
    input_count, selected_count = table.count(), sum(per_chrom.values())
    wanted = F.col("chrom").isin(*selected)
    sinks.write_table(feature_output, table.where(wanted), ["ord"],
                      list(vocab.FEATURE_COLUMNS))
    melted = bed.long(features.where(wanted).select("fields"), shared)
    facts = cells.observation_totals(melted, thresholds, tail).first()
    sinks.write_json(qc_output, {
        "bed_only_sample_count": overlap.left_only_sample_count,
        "bed_sample_count": len(bed.samples),
        "feature_count": selected_count,
        "input_feature_count": input_count,
        "missing_z_observations": facts.missing_z_observations,
        "non_missing_observations": facts.total_observations,
        "outlier_observations": {str(t): facts[f"o{i}"] for i, t in enumerate(thresholds)},
        "selected_chromosomes": selected,
        "selected_feature_count": selected_count,
        "shared_sample_count": overlap.shared_sample_count,
        "unselected_feature_count": input_count - selected_count,
        "vcf_only_sample_count": overlap.right_only_sample_count,
        "vcf_sample_count": overlap.shared_sample_count + overlap.right_only_sample_count,
    })


def prepare_vat(spark: SparkSession, vat, chromosomes, schema_output) -> vat_source.VatSchema:
    """Resolve the annotation columns and check that all chromosomes occur."""
    schema, rows = vat_source.read_vat(spark, vat)
    vat_source.require_chromosomes(rows, chromosomes)
    files.write_text(schema_output, schema.to_json())
    return schema


# -------------------------------------------------------- classification

# fixed values: counters of the per-chromosome QC document, all starting at zero
CHROMOSOME_COUNTERS = (
    "annotation_chunk_count", "above_maf_threshold_alleles", "baseline_emitted_keys",
    "boundary_variant_feature_pairs", "classified_alt_alleles",
    "configured_consequence_annotations", "consequence_emitted_keys",
    "consequence_terms_parsed", "converted_gvs_max_af_values", "duplicate_vat_rows",
    "emitted_keys", "extracted_records", "feature_count",
    "gene_matched_variant_feature_pairs", "gene_unmatched_variant_feature_pairs",
    "inconsistent_frequency_alleles", "loftee_emitted_keys", "loftee_hc_values",
    "loftee_lc_values", "loftee_missing_values", "loftee_unrecognized_values",
    "merged_region_count", "missing_frequency_alleles", "non_numeric_frequency_alleles",
    "out_of_range_frequency_alleles", "recognized_consequence_terms", "tabix_query_count",
    "unique_vat_allele_gene_pairs", "unique_vat_alleles", "unknown_consequence_rows",
    "unknown_consequence_terms", "vat_joined_alt_alleles", "vat_rows",
    "vat_tabix_query_count", "vat_unmatched_alt_alleles", "variant_feature_pairs",
    "vcf_tabix_query_count",
)


@dataclass(frozen=True)
class Classified:
    """Staged ``minima`` and ``chunks`` of several chromosomes, and a QC document for each."""

    minima: DataFrame
    chunks: DataFrame
    qc: dict[str, dict]


def classify(spark: SparkSession, vcf, vat, vat_schema, features, shared_samples, chromosomes,
             exact_ac, cumulative_ac_max, consequence_classes, maximum_gvs_maf, max_distance,
             annotation_chunk_size_bp) -> Classified:
    """Carrier minimum distances, query chunks and QC of all ``chromosomes`` in one chain of jobs.

    ``vcf`` and ``vat`` are texts, which are read once for all chromosomes, or layouts of
    ``sources.regions``, of which the stretches near the features are read.
    """
    samples, contigs, records, vcf_lines = regions.open_vcf(spark, vcf)
    if not contigs:
        raise ValueError("VCF header does not declare contigs")
    absent = [c for c in chromosomes if c not in contigs]
    if absent:
        raise ValueError("requested chromosome is absent from VCF: " + ", ".join(absent))
    config.maximum_maf(maximum_gvs_maf)
    schema = vat_source.VatSchema.from_json(files.read_text(vat_schema))
    config.annotation_classes(consequence_classes, schema.loftee_enabled)
    ac = config.ac_classes(exact_ac, cumulative_ac_max)
    config.chunk_size(annotation_chunk_size_bp)
    selected = F.col("chrom").isin(*chromosomes)
    tss = stage(tables.read_features(spark, features).where(selected).drop("ord"), "features")
    shared = tables.read_samples(spark, shared_samples)

    windows = stage(ranges.query_windows(tss, max_distance), "windows")
    chunks = stage(ranges.query_chunks(tss, max_distance, annotation_chunk_size_bp), "chunks")
    qc = {c: {**dict.fromkeys([*CHROMOSOME_COUNTERS, *vocab.GENOTYPE_COUNTERS], 0), "chromosome": c,
              "observed_raw_gvs_max_af": "none"} for c in chromosomes}
    _count(qc, tss.groupBy("chrom").agg(F.count(F.lit(1)).alias("feature_count")))
    # one region query per chunk on either input, in the terms of the QC document
    _count(qc, chunks.groupBy("chrom").agg(*[F.count(F.lit(1)).alias(k) for k in (
        "annotation_chunk_count", "vat_tabix_query_count", "vcf_tabix_query_count", "tabix_query_count")]))
    if not any(document["feature_count"] for document in qc.values()):
        empty = spark.createDataFrame([], ", ".join(f"{c} string" for c in ("chrom", *vocab.MINIMA_COLUMNS)))
        return Classified(empty, chunks, qc)
    _count(qc, ranges.tss_windows(tss, max_distance).groupBy("chrom").agg(
        F.count(F.lit(1)).alias("merged_region_count")))

    annotations, frequencies = _annotations(
        spark, vat, schema, selected, windows, max_distance, annotation_chunk_size_bp,
        maximum_gvs_maf, consequence_classes, qc)
    alleles = _alleles(records(windows).where(selected), vcf_lines, len(samples), windows,
                       max_distance, annotation_chunk_size_bp, qc)
    counted = alleles.where("ac IS NOT NULL")
    # an annotation row belongs to the chunk of its position; elsewhere the allele has no match
    _count(qc, counted.where("NOT starts_here").groupBy("chrom").agg(
        F.count(F.lit(1)).alias("vat_unmatched_alt_alleles")))
    known = C.with_frequency(counted.where("starts_here"), frequencies)
    _count(qc, known.groupBy("chrom").agg(
        F.count("status").alias("vat_joined_alt_alleles"),
        F.count_if(F.col("status").isNull()).alias("vat_unmatched_alt_alleles")), add=True)
    names = spark.createDataFrame(list(enumerate(samples)), "position int, sample_id string")
    positions = names.join(shared.select("sample_id"), "sample_id", "left_semi")
    kept = C.rare(known, maximum_gvs_maf).select(*T.ALLELE, "ac", "carrier_positions").withColumn(
        "carrier_positions", C.shared_carriers([r["position"] for r in positions.collect()]))
    pairs = stage(C.feature_pairs(kept, tss, annotations, max_distance), "pairs")
    _count(qc, C.pair_counters(pairs, max_distance, ["chrom"]))
    minima = stage(C.carrier_minima(pairs, positions, ac, consequence_classes, ("chrom",)), "minima")
    for row in minima.groupBy("chrom", "annotation_family").count().collect():
        qc[row.chrom][f"{row.annotation_family}_emitted_keys"] = row["count"]
        qc[row.chrom]["emitted_keys"] += row["count"]
    return Classified(minima, chunks, qc)


def _write_chromosome(done: Classified, chromosome: str, carrier_output, regions_output,
                      qc_output) -> None:
    own, qc = F.col("chrom") == chromosome, done.qc[chromosome]
    bed = done.chunks.where(own).select(
        F.col("chrom").alias("#chrom"), (F.col("start") - 1).alias("start"), "end")
    sinks.write_table(regions_output, bed, ["start"], ["#chrom", "start", "end"])
    sinks.write_table(carrier_output, done.minima.where(own), list(vocab.MINIMA_KEYS),
                      list(vocab.MINIMA_COLUMNS))
    sinks.write_json(qc_output, qc)


def classify_chromosome(spark: SparkSession, *, chromosome, carrier_output, regions_output, qc_output,
                        **inputs) -> None:
    """Carrier minimum distances of one chromosome, its query regions and its QC."""
    done = classify(spark, chromosomes=[chromosome], **inputs)
    _write_chromosome(done, chromosome, carrier_output, regions_output, qc_output)


def classify_chromosomes(spark: SparkSession, *, chromosomes, output_folder, **inputs) -> None:
    """The same for several chromosomes at once: ``<chromosome>.carriers.tsv``, ``.regions.bed`` and
    ``.qc.json`` in one folder."""
    done = classify(spark, chromosomes=list(dict.fromkeys(chromosomes)), **inputs)
    for chromosome in done.qc:
        _write_chromosome(done, chromosome, *(
            files.join(output_folder, f"{chromosome}.{kind}") for kind in ("carriers.tsv", "regions.bed", "qc.json")))


def _count(qc: dict[str, dict], counters: DataFrame, add: bool = False) -> None:
    """Take the rows of an aggregate by ``chrom`` into the QC documents."""
    for row in counters.collect():
        document = qc[row["chrom"]]
        for key, value in row.asDict().items():
            if key != "chrom" and value is not None:
                document[key] = document[key] + value if add else value


def _annotations(spark, vat, schema, selected, windows, distance, chunk_bp, maximum_maf,
                 consequences, qc):
    rows, lines = regions.open_vat(spark, vat, schema)
    located = ranges.within_windows(rows(windows).where(selected), windows, distance, chunk_bp)
    # the text is read once: rules, digest and parsed columns are staged together
    parsed = stage(T.interpret(located.withColumn("problem", vat_source.row_problem(schema))), "vat-rows")
    text.fail_on_violation(parsed, F.col("problem"), "VAT", lines, _place(lines))
    _count(qc, T.row_counters(parsed, ["chrom"]))
    _count(qc, T.duplicate_rows(parsed, ["chrom"], "digest"))
    # terms are distinct within a chunk and then summed over chunks
    _count(qc, T.unknown_term_counts(parsed, ["chrom", "chunk"]).groupBy("chrom").agg(
        F.count(F.lit(1)).alias("unknown_consequence_terms")))
    frequencies = stage(T.allele_frequencies(parsed), "frequencies")
    _count(qc, T.frequency_counters(frequencies, maximum_maf, ["chrom"]))
    annotations = stage(T.gene_annotations(parsed), "annotations")
    _count(qc, T.pair_counters(annotations, consequences, ["chrom"]))
    return annotations, frequencies


def _alleles(records, lines, sample_count, windows, distance, chunk_bp, qc) -> DataFrame:
    """Alleles of every record in every chunk that it reaches, as separate region queries find them."""
    located = ranges.records_in_chunks(records, windows, distance, chunk_bp)
    checked = located.withColumn("problem", vcf_source.record_problem(sample_count))
    alleles = stage(C.alt_alleles(checked.drop("chunk", "n_fields", "pos_text")), "alleles")
    text.fail_on_violation(alleles, F.col("problem"), "VCF", lines, _place(lines))
    _count(qc, C.allele_counters(alleles, ["chrom"]))
    return alleles


def _place(lines):
    """Chromosome and position, for inputs without line numbers."""
    return F.concat_ws(":", "chrom", "pos") if lines is None else None


# ---------------------------------------------------------------- gather


def gather(spark: SparkSession, carrier_inputs, qc_inputs, carrier_output, qc_output) -> None:
    """Reduce carrier tables of several chromosomes and combine their QC."""
    if len(carrier_inputs) != len(qc_inputs):
        raise ValueError("expected the same number of carrier and QC inputs")
    if not carrier_inputs:
        raise ValueError("at least one carrier input and one QC input are required")
    records = [docs.read_chromosome_object(p) for p in qc_inputs]
    if len({r["chromosome"] for r in records}) < len(records):
        raise ValueError("QC inputs must contain unique chromosomes")
    classified = docs.sum_counter(records, "classified_alt_alleles")
    if classified and not docs.sum_counter(records, "vat_joined_alt_alleles"):
        raise ValueError("no queried VCF ALT alleles matched VAT allele keys")
    union = reduce(DataFrame.unionByName, [tables.read_minima(spark, p) for p in carrier_inputs])
    minima = stage(C.minimum_distances(union), "minima")
    order = ["feature_id", "sample_id", *vocab.MINIMA_KEYS[2:]]
    sinks.write_table(carrier_output, minima, order, list(vocab.MINIMA_COLUMNS))
    files.write_text(qc_output, docs.chromosome_table(records))


# ------------------------------------------------------------- calculate


def enrichment(observations: DataFrame, minima: DataFrame, thresholds, distances, tail,
               ac, annotations) -> DataFrame:
    """Result grid of in-memory tables: the whole calculation as one DataFrame."""
    totals = cells.observation_totals(observations, thresholds, tail)
    counts = cells.stratum_counts(observations, minima, thresholds, distances, tail)
    return cells.stratum_statistics(
        cells.stratum_cells(totals, counts, thresholds, distances, tail, ac, annotations))


def calculate(spark: SparkSession, phenotype_bed, shared_samples, carriers, features, exact_ac,
              cumulative_ac_max, z_thresholds, distance_thresholds, tail, output_tsv,
              output_json, *, consequence_classes=(), loftee_enabled=False, phenotype_qc=None,
              chromosome_qc=None, selected_chromosomes=None, container_image=None,
              workflow_version="unknown", max_retries=0, index_provenance="unknown",
              vat_index_provenance="unknown", maximum_gvs_maf=0.01,
              annotation_chunk_size_bp=10_000_000, vat_schema=None) -> None:
    """Count carriers among outliers over the whole stratum grid and test each cell."""
    thresholds = config.outlier_thresholds(z_thresholds)
    distances = config.distances(distance_thresholds)
    ac = config.ac_classes(exact_ac, cumulative_ac_max, strict=True)
    annotations = config.annotation_classes(consequence_classes, loftee_enabled)
    config.tail_mode(tail)
    if isinstance(max_retries, bool) or not isinstance(max_retries, int) or max_retries < 0:
        raise ValueError("max_retries must be a non-negative integer")
    config.choice("index_provenance", index_provenance, PROVENANCE_STATES)
    config.choice("vat_index_provenance", vat_index_provenance, PROVENANCE_STATES)
    config.maximum_maf(maximum_gvs_maf)
    config.chunk_size(annotation_chunk_size_bp)
    manifest = None if vat_schema is None else vat_source.VatSchema.from_json(
        files.read_text(vat_schema)).manifest()

    samples = stage(tables.read_samples(spark, shared_samples), "samples")
    sample_count = samples.count()
    if not sample_count:
        raise ValueError("at least one shared sample is required")
    selected = stage(tables.read_features(spark, features, unique=True), "features")
    feature_count = selected.count()
    if not feature_count:
        raise ValueError("at least one selected feature is required")
    minima = stage(C.minimum_distances(tables.read_minima(spark, carriers)), "minima")
    _check_minima(minima, samples, selected, ac, annotations)

    bed = read_bed(spark, phenotype_bed, trim_samples=False)
    bed_samples = bed.sample_table()
    absent = samples.join(bed_samples, "sample_id", "left_anti").orderBy("ord").collect()
    if absent:
        raise ValueError("shared samples are absent from phenotype BED: "
                         + ", ".join(r.sample_id for r in absent))
    rows = _features_of(bed, check_values=False)
    table = _survey(bed, rows)
    unselected = _match_features(table, selected)
    kept = rows.join(selected.select("feature_id"), "feature_id", "left_semi")
    shared = bed_samples.join(samples.select("sample_id"), "sample_id", "left_semi")
    observations = stage(bed.long(kept.select("ord", "feature_id", "fields"), shared), "observed")
    text.fail_on_violation(
        observations, F.when(F.col("bad"), "a non-numeric or non-finite value"),
        "phenotype BED", bed.lines)

    totals = stage(cells.observation_totals(observations, thresholds, tail), "totals")
    counts = cells.stratum_counts(observations, minima, thresholds, distances, tail)
    grid = cells.stratum_cells(totals, counts, thresholds, distances, tail, ac, annotations)
    written = sinks.write_grid(
        output_tsv, cells.stratum_statistics(grid), vocab.ANNOTATION_RESULT_COLUMNS,
        ["threshold_order", "annotation_order", "ac_order", "distance_order"])
    facts = totals.first()
    keys = minima.agg(F.count(F.lit(1)).alias("n"),
                      F.count_distinct("feature_id").alias("features")).first()
    if selected_chromosomes is None:
        first = selected.groupBy("chrom").agg(F.min("ord").alias("ord")).orderBy("ord")
        selected_chromosomes = [r.chrom for r in first.collect()]
    consequences = [c for f, c in annotations if f == "consequence"]
    summary = {
        "ac_classes": [c.label for c in ac],
        "analysis_parameters": {
            "annotation_chunk_size_bp": annotation_chunk_size_bp,
            "annotation_classes": [{"family": f, "label": c} for f, c in annotations],
            "consequence_classes": consequences,
            "cumulative_allele_count_maxima": list(cumulative_ac_max),
            "distance_thresholds_bp": distances,
            "exact_allele_counts": list(exact_ac),
            "loftee_enabled": loftee_enabled,
            "maximum_gvs_maf": maximum_gvs_maf,
            "outlier_tail": tail,
            "z_thresholds": thresholds,
        },
        "carrier_key_count": keys.n,
        "distance_thresholds_bp": distances,
        "emitted_rows": len(written),
        "feature_count": feature_count,
        "features_with_carriers": keys.features,
        "features_without_carriers": feature_count - keys.features,
        "missing_z_observations": facts.missing_z_observations,
        "shared_sample_count": sample_count,
        "statistical_limitation": LIMITATION,
        "tail": tail,
        "total_observations": facts.total_observations,
        "tss_coordinate_convention": TSS_CONVENTION,
        "z_thresholds": thresholds,
        "unselected_feature_count": unselected,
        "provenance": {
            "annotation_chunk_size_bp": annotation_chunk_size_bp,
            "container_image": container_image,
            "consequence_classes": consequences,
            "loftee_enabled": loftee_enabled,
            "maximum_gvs_maf": maximum_gvs_maf,
            "max_retries": max_retries,
            "selected_chromosomes": list(selected_chromosomes),
            "software_versions": {
                "python": platform.python_version(), "pyspark": spark.version,
                "tailfold": __version__, "workflow": workflow_version,
            },
            "severity_order_version": vocab.SEVERITY_VERSION,
            "vat_index": vat_index_provenance,
            "vat_schema": manifest,
            "vat_source": "variant_annotation_table",
            "vcf_index": index_provenance,
        },
    }
    if phenotype_qc is not None:
        summary["phenotype_qc"] = docs.read_phenotype_qc(phenotype_qc)
    if chromosome_qc is not None:
        summary["chromosome_qc"] = docs.read_chromosome_table(chromosome_qc)
    sinks.write_json(output_json, summary)


def _check_minima(minima, samples, selected, ac, annotations) -> None:
    """Carrier keys must only use known samples, features and configured classes."""
    for key, known, what in (("sample_id", samples, "shared samples"),
                             ("feature_id", selected, "selected features")):
        stray = minima.join(known.select(key), key, "left_anti").select(key).first()
        if stray is not None:
            raise ValueError(f"carrier {key} is absent from {what}: {stray[0]}")
    stray = minima.where(~F.col("ac_class").isin(*[c.label for c in ac])).first()
    if stray is not None:
        raise ValueError(f"carrier AC class is not configured: {stray.ac_class}")
    both = F.concat_ws("\t", "annotation_family", "annotation_class")
    stray = minima.where(~both.isin(*["\t".join(a) for a in annotations])).first()
    if stray is not None:
        raise ValueError("carrier annotation class is not configured: "
                         f"{stray.annotation_family}/{stray.annotation_class}")


def _match_features(table: DataFrame, selected: DataFrame) -> int:
    """Compare selected features with the BED; return how many BED rows are unselected."""
    there = table.select("feature_id", F.col("chrom").alias("bed_chrom"),
                         F.col("tss").alias("bed_tss"))
    matched = there.join(selected, "feature_id", "full_outer")
    moved = F.col("chrom").isNotNull() & F.col("bed_chrom").isNotNull() & (
        (F.col("chrom") != F.col("bed_chrom")) | (F.col("tss") != F.col("bed_tss")))
    facts = matched.agg(
        F.min(F.when(moved, F.col("feature_id"))).alias("moved"),
        F.min(F.when(F.col("bed_chrom").isNull(), F.col("feature_id"))).alias("absent"),
        F.count_if(F.col("chrom").isNull()).alias("unselected"),
    ).first()
    if facts.moved is not None:
        raise ValueError(f"selected feature location does not match phenotype BED: {facts.moved}")
    if facts.absent is not None:
        raise ValueError(f"selected features are absent from phenotype BED: {facts.absent}")
    return facts.unselected


def outlier_counts(observations: DataFrame, thresholds, by: list[str]) -> DataFrame:
    """Outlying observations per tail and threshold."""
    return observations.groupBy(*by).agg(*[
        F.count_if(outlier(F.col("value"), t, tail)).alias(f"{tail}_{i}")
        for tail in vocab.TAILS for i, t in enumerate(thresholds)
    ])
