"""Loss-of-function enrichment among low outliers over a PC sweep."""

from __future__ import annotations

import logging
import platform
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tailfold import __version__, config, files, sinks, vocab
from tailfold.functions import values as V
from tailfold.operators import cells, collapse, residuals
from tailfold.operators.samples import design_table, shared_samples
from tailfold.plans.resume import WorkFolder
from tailfold.progress import reported
from tailfold.session import stage
from tailfold.sources import gtf, tables, text
from tailfold.sources.bed import read_bed

LOG = logging.getLogger(__name__)
PROGRESS_GENES = 500

# fixed values: sentences of the summary document
FDR_SCOPE = "global_across_all_emitted_rows"
OBSERVATION_UNIT = "eligible sample-gene residual"
DESIGN = "intercept plus first k principal components"
DESIGN_WITH_COVARIATES = (
    "intercept plus all additional covariates plus first k principal components")
OUTLIER_RULE = "residual_z <= z_threshold"
LIMITATION = (
    "Pooled Fisher tests are screening statistics because samples and genes recur "
    "as observations; use dependence-aware inference for confirmation.")


# ------------------------------------------------------------- gene lists


def prepare_coding_genes(spark: SparkSession, gtf_path, genes_output, qc_output) -> None:
    """Sorted unique protein-coding gene IDs of a GTF, with record counters."""
    lines = gtf.read_gtf(spark, gtf_path)
    records = gtf.gene_records(lines)
    per_gene = stage(
        gtf.coding_records(records).groupBy("gene_id").agg(F.count(F.lit(1)).alias("n")), "genes")
    facts = per_gene.agg(
        F.count(F.lit(1)).alias("unique"), F.coalesce(F.sum("n"), F.lit(0)).alias("coding")).first()
    if not facts.unique:
        raise ValueError("no protein-coding genes found in GTF")
    sinks.write_table(genes_output, per_gene, ["gene_id"], ["gene_id"])
    sinks.write_json(qc_output, {
        "duplicate_normalized_gene_records": facts.coding - facts.unique,
        "nine_field_gene_records": records.count(),
        "protein_coding_gene_records": facts.coding,
        "total_lines": lines.count(),
        "unique_protein_coding_gene_count": facts.unique,
    })


def write_pc_chunks(spark: SparkSession, principal_components, pc_counts, per_job, output) -> None:
    _, _, columns = tables.pc_header(spark, principal_components)
    sinks.write_json(output, config.pc_chunks(pc_counts, len(columns) - 1, per_job))


# ------------------------------------------------------------- core plan


def gene_table(flagged: DataFrame, design: DataFrame, fixed: int, pc_counts,
               thresholds, cached: list | None = None) -> DataFrame:
    """Per gene and PC count: fit summary and cell counts.

    Intercept-only models need no linear algebra and stay in the JVM.
    """
    if fixed == 0 and list(pc_counts) == [0]:
        shared = flagged.join(design.select("sample_id"), "sample_id", "left_semi")
        return residuals.gene_baseline(shared, thresholds)
    return residuals.gene_sweep(flagged, design, fixed, pc_counts, thresholds, cached=cached)


def enrichment(observations: DataFrame, design: DataFrame, pairs: DataFrame, fixed: int,
               pc_counts, thresholds) -> DataFrame:
    """Result grid of in-memory tables: the whole analysis as one DataFrame.

    ``observations``: (gene_id, sample_id, value), features already named by gene;
    ``design``: (sample_id, x); ``pairs``: output of ``carrier_pairs``.
    """
    flagged = collapse.flag_observations(collapse.collapse_genes(observations), pairs)
    if fixed or list(pc_counts) != [0]:
        flagged = stage(flagged, "observations")
    genes = gene_table(flagged, design, fixed, pc_counts, thresholds)
    grid = cells.sweep_cells(cells.sweep_totals(genes), pc_counts, thresholds)
    return cells.sweep_statistics(grid)


def run(spark: SparkSession, phenotype_bed, lof_carriers, principal_components,
        protein_coding_genes, negative_z_thresholds, pc_counts, results_output,
        summary_output, gene_pc_qc_output, analysis_qc_output, *, pc_grid_mode=None,
        additional_covariates=None, work_folder=None, pc_counts_per_job=None) -> None:
    """Analyse one cohort from files and write the four output documents.

    With ``pc_counts_per_job`` the sweep runs in batches of PC counts, and with ``work_folder`` too, a
    later run of the same analysis goes on after the last finished batch.
    """
    thresholds = config.negative_thresholds(negative_z_thresholds)
    mode = config.choice(
        "pc_grid_mode", pc_grid_mode or ("explicit" if pc_counts else "adaptive"),
        ("adaptive", "explicit"))
    pcs = tables.read_pcs(spark, principal_components)
    covs = None if additional_covariates is None else tables.read_covariates(
        spark, additional_covariates)
    grid = config.pc_grid(pc_counts, len(pcs.names))
    coding, coding_count = tables.read_coding_genes(spark, protein_coding_genes)
    carriers, carrier_rows, truthy_rows = tables.read_lof_carriers(spark, lof_carriers)
    pairs = stage(collapse.carrier_pairs(carriers), "pairs")
    pair_counts = collapse.carrier_definition_counts(pairs).first().asDict()
    fixed = 0 if covs is None else len(covs.names)
    LOG.info("Starting LoF/PC enrichment: thresholds=%s pc_counts=%s coding_genes=%d "
             "additional_covariates=%d", thresholds, grid, coding_count, fixed)

    bed = read_bed(spark, phenotype_bed, trim_samples=True)
    matrices = [pcs.table] if covs is None else [pcs.table, covs.table]
    shared = stage(shared_samples(bed.sample_table(), *matrices), "samples")
    shared_count = shared.count()
    if not shared_count:
        inputs = "phenotype BED and PC" if covs is None else (
            "phenotype BED, PC and additional-covariate")
        raise ValueError(f"no shared {inputs} samples")
    LOG.info("Found %d shared BED/PC%s samples (%d BED, %d PC)", shared_count,
             "" if covs is None else "/additional-covariate", len(bed.samples), pcs.sample_count)

    rows = bed.rows.withColumn("gene_id", V.single_gene(F.col("feature")))
    genes, facts = _survey_genes(bed, rows, coding)
    coding_rows = rows.join(coding, "gene_id", "left_semi").select("gene_id", "fields")
    melted = bed.long(coding_rows, shared).drop("bad")
    inputs = {
        "lof_carriers": str(lof_carriers), "phenotype_bed": str(phenotype_bed),
        "principal_components": str(principal_components),
        "protein_coding_genes": str(protein_coding_genes),
    }
    if additional_covariates is not None:
        inputs["additional_covariates"] = str(additional_covariates)
    work = None if work_folder is None else WorkFolder(spark, work_folder, {
        "inputs": {name: [path, *files.stamp(path)] for name, path in inputs.items()},
        "pc_counts": grid, "pc_counts_per_job": pc_counts_per_job, "thresholds": thresholds,
        "version": __version__})

    def kept(name, make):
        return stage(make(), name) if work is None else work.table(name, make)

    flagged = kept("observations", lambda: collapse.flag_observations(
        collapse.collapse_genes(melted), pairs))
    design = kept("design", lambda: design_table(
        shared, pcs.table, None if covs is None else covs.table, max(grid)))
    batches = config.pc_chunks(grid, len(pcs.names), pc_counts_per_job or len(grid))
    parts = [_batch(flagged, design, fixed, batch, thresholds, work, facts.coding_genes)
             for batch in batches]
    table = reduce(DataFrame.unionByName, parts) if work is None else work.rows(grid)

    totals = stage(cells.sweep_totals(table), "totals")
    per_pc = _per_pc(totals, grid)
    results = cells.sweep_statistics(cells.sweep_cells(totals, grid, thresholds))
    written = sinks.write_grid(results_output, results, vocab.PC_RESULT_COLUMNS,
                               ["pc_count", "threshold_order", "definition_order"])
    _write_gene_qc(gene_pc_qc_output, table, genes)
    sinks.write_json(analysis_qc_output, {
        "bed_feature_count": facts.features,
        "bed_gene_count": facts.genes,
        "bed_sample_count": len(bed.samples),
        "duplicate_feature_count": facts.features - facts.genes,
        "additional_covariates_supplied": covs is not None,
        "additional_covariate_count": fixed,
        "additional_covariate_names": [] if covs is None else covs.names,
        "additional_covariate_sample_count": 0 if covs is None else covs.sample_count,
        "pc_sample_count": pcs.sample_count,
        "protein_coding_bed_feature_count": facts.coding_features,
        "protein_coding_bed_gene_count": facts.coding_genes,
        "protein_coding_duplicate_feature_count": facts.coding_features - facts.coding_genes,
        "protein_coding_gene_count": coding_count,
        "shared_bed_pc_sample_count": shared_count,
        "shared_bed_pc_covariate_sample_count": shared_count,
        "pre_join_carrier_pair_counts": pair_counts,
        "lof_carrier_table": {
            "input_row_count": carrier_rows,
            "truthy_row_count": truthy_rows,
            "unique_any_lof_pair_count": pair_counts["any_lof"],
            "unique_hc_or_lc_pair_count": pair_counts["HC_or_LC"],
            "unique_hc_pair_count": pair_counts["HC"],
        },
        "per_pc": per_pc,
    })
    sinks.write_json(summary_output, {
        "available_pc_count": len(pcs.names),
        "carrier_definitions": list(vocab.CARRIER_DEFINITIONS),
        "emitted_result_rows": len(written),
        "fdr_scope": FDR_SCOPE,
        "negative_z_thresholds": thresholds,
        "observation_unit": OBSERVATION_UNIT,
        "pc_grid_mode": mode,
        "provenance": {
            "input_files": inputs,
            "software_versions": {
                "numpy": np.__version__, "python": platform.python_version(),
                "pyspark": spark.version, "tailfold": __version__,
            },
        },
        "residualization": {
            "design": DESIGN if covs is None else DESIGN_WITH_COVARIATES,
            "outlier_rule": OUTLIER_RULE,
            "residual_standard_deviation_ddof": 0,
        },
        "selected_pc_counts": grid,
        "statistical_limitation": LIMITATION,
    })
    LOG.info("Wrote LoF/PC enrichment outputs: results=%s summary=%s gene_pc_qc=%s "
             "analysis_qc=%s", results_output, summary_output, gene_pc_qc_output,
             analysis_qc_output)


def _batch(flagged, design, fixed, pc_counts, thresholds, work, n_genes) -> DataFrame | None:
    """Gene rows of some PC counts, staged, or added to the work folder unless they are there."""
    spark = flagged.sparkSession
    if work is not None and not work.missing(pc_counts):
        LOG.info("PC counts %s were finished before", pc_counts)
        return None
    cached: list[DataFrame] = []
    design = design.withColumn("x", F.slice("x", 1, fixed + pc_counts[-1]))
    what = f"Genes of PC counts {pc_counts[0]} to {pc_counts[-1]}"
    with reported(spark, what, n_genes, PROGRESS_GENES):
        rows = gene_table(flagged, design, fixed, pc_counts, thresholds, cached)
        if work is None:
            rows = stage(rows, "gene-table")
        else:
            work.add(rows, pc_counts)
            rows = work.rows(pc_counts)
    for frame in cached:
        frame.unpersist()
    eligible = rows.where("reason IS NULL").groupBy("pc_count").agg(
        F.count(F.lit(1)).alias("genes"), F.sum("usable").alias("observations"))
    for row in eligible.orderBy("pc_count").collect():
        LOG.info("Completed PC count %d: eligible_genes=%d observations=%d", row.pc_count, row.genes,
                 row.observations)
    return rows


def _survey_genes(bed, rows: DataFrame, coding: DataFrame):
    """Validate every BED row and count features and genes in one pass."""
    problem = F.coalesce(
        bed.structure_problem(), V.gene_problem(F.col("feature")), bed.value_problem())
    checked = rows.select("ord", "gene_id", problem.alias("problem"))
    per_gene = checked.groupBy("gene_id").agg(
        F.count(F.lit(1)).alias("features"), F.min("ord").alias("first"),
        F.min(F.when(F.col("problem").isNotNull(), F.struct("ord", "problem"))).alias("bad"))
    marked = per_gene.join(coding.withColumn("coding", F.lit(True)), "gene_id", "left")
    genes = stage(marked.withColumn("coding", F.coalesce("coding", F.lit(False))), "bed-genes")
    facts = genes.agg(
        F.min("bad").alias("bad"),
        F.coalesce(F.sum("features"), F.lit(0)).alias("features"),
        F.count(F.lit(1)).alias("genes"),
        F.coalesce(F.sum(F.when(F.col("coding"), F.col("features"))), F.lit(0))
        .alias("coding_features"),
        F.count_if("coding").alias("coding_genes"),
    ).first()
    text.report_first(facts.bad, "phenotype BED", bed.lines)
    if not facts.coding_genes:
        raise ValueError("no protein-coding genes of the list occur in the phenotype BED")
    return genes, facts


def _per_pc(totals: DataFrame, grid: list[int]) -> dict:
    out = {}
    by_count = {row.pc_count: row for row in totals.collect()}
    for k in grid:
        row = by_count[k]
        out[str(k)] = {
            "carrier_observations": {
                d: row[f"c{i}"] for i, d in enumerate(vocab.CARRIER_DEFINITIONS)},
            "eligible_gene_count": row.eligible_gene_count,
            "exclusion_counts": {r: row[r] for r in vocab.EXCLUSION_REASONS},
            "total_observations": row.total_observations,
        }
    return out


def _write_gene_qc(path, table: DataFrame, genes: DataFrame) -> None:
    excluded = F.col("reason").isNotNull()
    rows = table.join(genes.select("gene_id", "first"), "gene_id").select(
        "gene_id", "pc_count", F.col("usable").alias("usable_sample_count"),
        F.coalesce(F.col("rank").cast("string"), F.lit("NA")).alias("rank"),
        sinks.double_text("residual_mean").alias("residual_mean"),
        sinks.double_text("residual_sd").alias("residual_sd"),
        F.when(excluded, "excluded").otherwise("included").alias("status"),
        F.coalesce("reason", F.lit("")).alias("exclusion_reason"), "first",
    )
    sinks.write_table(path, rows, ["pc_count", "first"], list(vocab.GENE_QC_COLUMNS),
                      compress=True)
