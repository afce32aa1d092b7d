"""Merge of separately run PC-count shards with one global FDR."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tailfold import config, sinks, vocab
from tailfold.functions import values as V
from tailfold.operators.fdr import benjamini_hochberg
from tailfold.plans.lof_pc import FDR_SCOPE
from tailfold.session import stage
from tailfold.sources import documents as docs
from tailfold.sources import tables, text

CANONICAL_COUNT = "^(0|[1-9][0-9]*)$"  # fixed value: non-negative integer text


def merged_fdr(shards: list[DataFrame]) -> DataFrame:
    """Union of result rows with ``fisher_fdr_bh`` adjusted over all of them."""
    rows = reduce(DataFrame.unionByName, shards)
    return benjamini_hochberg(rows.drop("fisher_fdr_bh"))


def run(spark: SparkSession, results_inputs, summary_inputs, gene_pc_qc_inputs,
        analysis_qc_inputs, results_output, summary_output, gene_pc_qc_output,
        analysis_qc_output) -> None:
    """Check that shards belong together and write them as one analysis."""
    shards = len(results_inputs)
    if not shards or any(
            len(x) != shards for x in (summary_inputs, gene_pc_qc_inputs, analysis_qc_inputs)):
        raise ValueError("all merge input lists must have the same nonzero shard count")
    summaries = [docs.check_summary(docs.read_object(p, "summary")) for p in summary_inputs]
    for key in docs.SHARED_SUMMARY_KEYS:
        if any(s.get(key) != summaries[0].get(key) for s in summaries):
            raise ValueError(f"shard summaries have incompatible {key}")
    counts = [k for s in summaries for k in s["selected_pc_counts"]]
    if len(set(counts)) < len(counts):
        raise ValueError(f"duplicate PC count across merge shards: {max(counts, key=counts.count)}")
    thresholds = config.negative_thresholds(summaries[0]["negative_z_thresholds"])

    rows = _result_rows(spark, results_inputs, summaries, thresholds)
    analysis = [docs.read_object(p, "analysis QC") for p in analysis_qc_inputs]
    common = [{k: v for k, v in a.items() if k != "per_pc"} for a in analysis]
    if any(c != common[0] for c in common):
        raise ValueError("analysis QC shards have incompatible top-level metadata")
    per_pc = [docs.check_per_pc(a, s["selected_pc_counts"])
              for a, s in zip(analysis, summaries, strict=True)]
    gene_rows = _gene_rows(
        spark, gene_pc_qc_inputs, docs.coding_gene_count(analysis[0]), per_pc)

    merged = benjamini_hochberg(rows.drop("fisher_fdr_bh"), p="_p", out="_q", small=True)
    printable = merged.withColumn("fisher_fdr_bh", F.col("_q"))
    written = sinks.write_grid(
        results_output, printable, vocab.PC_RESULT_COLUMNS,
        ["_k", "_threshold", "_definition"])
    sinks.write_table(
        gene_pc_qc_output, gene_rows, ["_shard", "ord"], list(vocab.GENE_QC_COLUMNS),
        compress=True)
    by_count = {k: v for shard in per_pc for k, v in shard.items()}
    counts.sort()
    sinks.write_json(analysis_qc_output, {
        **common[0], "per_pc": {str(k): by_count[str(k)] for k in counts}})
    sinks.write_json(summary_output, {
        **summaries[0], "selected_pc_counts": counts, "emitted_result_rows": len(written),
        "fdr_scope": FDR_SCOPE})


def _order(column, values):
    """Position of a value in a configured list."""
    return F.array_position(F.array(*[F.lit(v) for v in values]), column)


def _result_rows(spark, inputs, summaries, thresholds) -> DataFrame:
    checked = []
    for shard, (path, summary) in enumerate(zip(inputs, summaries, strict=True)):
        what = f"results TSV {path}"
        rows, columns, lines = tables.read_result_columns(spark, path, what)
        if columns != list(vocab.PC_RESULT_COLUMNS):
            raise ValueError(f"{what} does not match the result schema")
        ks = summary["selected_pc_counts"]
        typed = rows.select(
            "*", F.lit(shard).alias("_shard"),
            F.when(F.col("pc_count").rlike(CANONICAL_COUNT), V.to_long(F.col("pc_count")))
            .alias("_k"),
            V.to_double(F.col("z_threshold")).alias("_t"),
            V.to_double(F.col("fisher_p_value")).alias("_p"),
        )
        problem = F.coalesce(
            F.when(F.col("malformed"), "another number of columns"),
            F.when(F.col("_k").isNull(), "an invalid pc_count"),
            F.when(~F.col("_k").isin(*ks), "an unselected PC count"),
            F.when(F.col("_t").isNull(), "an invalid z_threshold"),
            F.when(~F.col("_t").isin(*thresholds), "an unknown z_threshold"),
            F.when(~F.col("carrier_definition").isin(*vocab.CARRIER_DEFINITIONS),
                   "an unknown carrier definition"),
            F.when(F.col("_p").isNull() | ~F.col("_p").between(0.0, 1.0),
                   "an invalid fisher_p_value"),
        )
        text.fail_on_violation(typed, problem, what, lines)
        facts = typed.agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_distinct("_k", "_t", "carrier_definition").alias("distinct")).first()
        if facts.distinct < facts.rows:
            raise ValueError(f"{what} has duplicate result combinations")
        if facts.rows != len(ks) * len(thresholds) * len(vocab.CARRIER_DEFINITIONS):
            raise ValueError(f"{what} result combinations do not match the shard summary")
        if facts.rows != summary["emitted_result_rows"]:
            raise ValueError(f"{what} row count does not match the shard summary")
        checked.append(typed)
    union = reduce(DataFrame.unionByName, checked)
    return union.withColumns({
        "_threshold": _order(F.col("_t"), thresholds),
        "_definition": _order(F.col("carrier_definition"), vocab.CARRIER_DEFINITIONS),
    })


def _gene_rows(spark, inputs, expected_genes: int, per_pc: list[dict]):
    """Gene QC of all shards, reconciled with the per-count QC counters.

    All reconciliation is aggregation: these tables hold genes x PC counts rows.
    """
    parts = []
    for shard, path in enumerate(inputs):
        what = f"gene-PC QC TSV {path}"
        rows, columns, lines = tables.read_result_columns(spark, path, what)
        if columns != list(vocab.GENE_QC_COLUMNS):
            raise ValueError(f"{what} does not match the QC schema")

        def whole(name):
            return F.when(F.col(name).rlike(CANONICAL_COUNT), V.to_long(F.col(name)))

        typed = rows.select("*", F.lit(shard).alias("_shard"), whole("pc_count").alias("_k"),
                            whole("usable_sample_count").alias("_usable"))
        reason, status = F.col("exclusion_reason"), F.col("status")
        ks = [int(k) for k in per_pc[shard]]
        problem = F.coalesce(
            F.when(F.col("malformed"), "another number of columns"),
            F.when(F.col("gene_id") == "", "an empty gene_id"),
            F.when(F.col("_k").isNull(), "an invalid pc_count"),
            F.when(~F.col("_k").isin(*ks), "an unselected PC count"),
            F.when(F.col("_usable").isNull(), "an invalid usable_sample_count"),
            F.when(~status.isin("included", "excluded"), "an invalid status"),
            F.when((status == "included") & (reason != ""),
                   "an included row with an exclusion reason"),
            F.when((status == "excluded") & ~reason.isin(*vocab.EXCLUSION_REASONS),
                   "an invalid exclusion reason"),
        )
        text.fail_on_violation(typed, problem, what, lines)
        parts.append(typed)
    rows = stage(reduce(DataFrame.unionByName, parts), "gene-qc")
    repeated = rows.groupBy("_shard", "gene_id", "_k").count().where("count > 1").first()
    if repeated is not None:
        raise ValueError(
            f"gene-PC QC TSV {inputs[repeated['_shard']]} has a duplicate gene-PC QC row")
    included = F.col("status") == "included"
    sums = rows.groupBy("_shard", "_k").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(included).alias("included"),
        F.coalesce(F.sum(F.when(included, F.col("_usable"))), F.lit(0)).alias("observations"),
        *[F.count_if(F.col("exclusion_reason") == r).alias(r) for r in vocab.EXCLUSION_REASONS],
    )
    found = {(r["_shard"], r["_k"]): r for r in sums.collect()}
    for shard, entries in enumerate(per_pc):
        for k, qc in entries.items():
            row, where = found.get((shard, int(k))), f"gene-PC QC TSV {inputs[shard]}"
            if row is None or row.rows != expected_genes:
                raise ValueError(f"{where} lacks expected gene-PC QC rows for PC count {k}")
            if row.included != qc["eligible_gene_count"]:
                raise ValueError(f"{where} included row count does not match analysis QC for {k}")
            if row.observations != qc["total_observations"]:
                raise ValueError(f"{where} total_observations do not match analysis QC for {k}")
            if any(row[r] != n for r, n in qc["exclusion_counts"].items()):
                raise ValueError(f"{where} exclusion counts do not match analysis QC for {k}")
    per_gene = rows.groupBy("_shard", "gene_id").agg(F.count(F.lit(1)).alias("seen"))
    spread = per_gene.groupBy("_shard").agg(F.min("seen").alias("lo"), F.max("seen").alias("hi"))
    for row in spread.collect():
        if row.lo != row.hi:
            raise ValueError(f"gene-PC QC TSV {inputs[row['_shard']]} has incompatible gene "
                             "membership across PC counts")
    return rows
