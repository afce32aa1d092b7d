"""Registered queries over files: the driver tables written as the inputs of the plans, read back by
the production readers and run through whole plans."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tailfold import files, sinks, vocab
from tailfold.functions import genotype as G
from tailfold.operators import carriers as C
from tailfold.operators import collapse, plateau
from tailfold.operators import vat as T
from tailfold.operators.ranges import query_windows, records_in_chunks, within_windows
from tailfold.plans import lof_pc, merge, rare_variant
from tailfold.plans import surrogates as S
from tailfold.session import release, stage, staging_root
from tailfold.sources import bed, blocks, documents, regions, tables, text, vat, vcf

# Records of the region queries reach several chunks; the layout's stretches are short.
REACH, REACH_CHUNK, SPAN = 20, 15, 5000
SHARDS = ((0, 1), (2,))
PREPARED = ("chr1", "chr3")
# slices at most in which a large text is sorted
TEXT_SLICES = 4


def folder(spark, name: str) -> str:
    return f"{staging_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(spark, name: str, rows: DataFrame, order: list[str], header: bool = True, **how) -> str:
    """All columns of ``rows`` but those named ``_...`` as a table on file."""
    path = folder(spark, name)
    sinks.write_table(path, rows, order, [c for c in rows.columns if not c.startswith("_")], header=header, **how)
    return path


# ------------------------------------------------------------ one reader each


def _matrix_files(spark, d):
    supplier = S.table(spark, d, "supplier")
    pcs = written(spark, "pcs", supplier.select(
        S.text("s_suppkey").alias("ID"), F.col("s_acctbal").alias("PC1"),
        F.col("s_nationkey").alias("PC2"), F.col("s_suppkey").alias("PC3")), ["ID"])
    extra = written(spark, "covariates", supplier.where("s_acctbal > 0").select(
        F.col("s_nationkey").alias("age"), S.text("s_suppkey").alias("sample_id"),
        F.concat(F.lit('"'), F.col("s_acctbal").cast("string"), F.lit('"')).alias("bal")), ["sample_id"])
    return pcs, extra


def sample_matrix_files(spark, d):
    """Principal components and covariates, met by sample."""
    pcs, extra = _matrix_files(spark, d)
    left, right = tables.read_pcs(spark, pcs), tables.read_covariates(spark, extra)
    arrays = [c for m in (left, right) for c in m.table.columns if c != "sample_id"]
    names = [*left.names, *right.names]
    values = left.table.join(right.table, "sample_id").select(
        "sample_id", F.posexplode(F.concat(*arrays)).alias("at", "value"))
    return values.groupBy(F.array(*map(F.lit, names))[F.col("at")].alias("name")).agg(
        F.count(F.lit(1)).alias("n_samples"), F.round(F.sum("value"), 2).alias("total"),
        F.min("value").alias("lowest"), F.max("value").alias("highest"))


def _carrier_file(spark, d):
    """Carrier rows with quoted cells; genes by their number."""
    rows = S.lof_carriers(spark, d)
    quoted = F.concat(F.lit('"'), F.col("lof_classes"), F.lit('"'))
    return written(spark, "carriers", rows.select(
        F.concat(F.lit(" "), "sample_id").alias("sample_id"),
        F.concat(S.brand_gene(F.col("gene_id")), F.lit(".7")).alias("gene_id"),
        F.lit('"a ""b"" c"').alias("gene_symbol"),
        F.when(F.col("has_lof"), " Yes").otherwise("0").alias("has_lof_variant"),
        F.lit(1).alias("n_lof_variants"), F.lit("v1,v2").alias("variant_ids"),
        quoted.alias("lof_classes")), ["sample_id", "gene_id"])


def lof_carrier_file(spark, d):
    carriers, _, _ = tables.read_lof_carriers(spark, _carrier_file(spark, d))
    return collapse.carrier_pairs(carriers)


def coding_gene_file(spark, d):
    """The gene list and its counters as prepared from a GTF."""
    lines = S.gtf_lines(spark, d)
    gtf, genes, qc = folder(spark, "gtf"), folder(spark, "genes"), folder(spark, "genes-qc")
    blocks.write_block_gzip(lines, gtf)
    lof_pc.prepare_coding_genes(spark, gtf, genes, qc)
    counters = documents.read_object(qc, "QC")
    found, count = tables.read_coding_genes(spark, genes)
    return found.agg(
        F.count_distinct("gene_id").alias("n_genes"), F.min("gene_id").alias("first_gene"),
        F.max("gene_id").alias("last_gene")).select(
        "*", F.lit(count).cast("long").alias("listed"),
        *[F.lit(counters[k]).cast("long").alias(k) for k in (
            "duplicate_normalized_gene_records", "nine_field_gene_records",
            "protein_coding_gene_records", "total_lines")])


def feature_file(spark, d):
    features = S.features(spark, d).select(*vocab.FEATURE_COLUMNS)
    path = written(spark, "features", features, ["chrom", "tss"])
    return tables.read_features(spark, path, unique=True).drop("ord")


def sample_file(spark, d):
    supplier = S.table(spark, d, "supplier").select(S.text("s_suppkey").alias("sample_id"))
    path = written(spark, "samples", supplier, ["sample_id"], header=False)
    return tables.read_samples(spark, path).select("sample_id")


def gathered_minima_files(spark, d):
    """Carrier minima of three chromosomes as files, gathered with their QC."""
    lines = S.table(spark, d, "lineitem")
    rows = lines.select(
        S.text("l_suppkey").alias("sample_id"), S.text("l_partkey").alias("feature_id"),
        F.concat(F.lit("AC="), F.col("l_linenumber").cast("string")).alias("ac_class"),
        F.lit("baseline").alias("annotation_family"), F.lit("all_rare_variants").alias("annotation_class"),
        F.col("l_quantity").cast("long").alias("minimum_distance_bp"),
        (F.col("l_orderkey") % 3).alias("_chromosome"))
    inputs, qcs = [], []
    for i in range(3):
        own = rows.where(F.col("_chromosome") == i)
        inputs.append(written(spark, f"minima-{i}", own, list(vocab.MINIMA_KEYS)))
        qcs.append(folder(spark, f"qc-{i}"))
        sinks.write_json(qcs[-1], {"chromosome": f"chr{i}", "classified_alt_alleles": 4,
                                   "vat_joined_alt_alleles": 3})
    out, qc = folder(spark, "gathered"), folder(spark, "gathered-qc")
    rare_variant.gather(spark, inputs, qcs, out, qc)
    return tables.read_minima(spark, out)


def selection_from_file(spark, d):
    """The plateau entry, selected from a results file."""
    results = folder(spark, "results")
    sinks.write_grid(results, S.sweep_results(spark, d), (
        "pc_count", "z_threshold", "carrier_definition", "odds_ratio"), ["pc_count", "z_threshold", "carrier_definition"])
    points = plateau.median_log_odds(tables.read_selection_rows(spark, results), S.SWEEP_BANDS)
    entry = plateau.plateau_entry(points)
    return entry.withColumns({c: F.round(c, 6) for c in ("max_median_log_odds_ratio", "plateau_log_odds_ratio")})


def _bed_file(spark, d, meta: DataFrame, observations: DataFrame, key: str) -> str:
    """A phenotype BED (block gzip) with a column per supplier; absent cells are NA."""
    supplier = S.table(spark, d, "supplier")
    listed = supplier.agg(F.sort_array(F.collect_list(F.struct("s_suppkey"))).alias("names")).select(
        F.transform("names", lambda n: F.coalesce(n["s_suppkey"].cast("string"), F.lit("None"))).alias("names"))
    columns = listed.select(F.posexplode("names").alias("at", "sample_id"))
    known = F.coalesce("sample_id", F.raise_error(F.lit("a cell without sample")).cast("string"))
    cells = observations.where("value IS NOT NULL").withColumn("sample_id", known).join(columns, "sample_id").groupBy(
        key).agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("cells"))
    # sorted before the lines are put together, so that only the cells that are there move
    body = meta.join(cells, key, "left").withColumn("place", F.lit(1))
    top = listed.select(F.lit(0).alias("place"), F.concat(
        F.lit("\t".join(["#chr", "start", "end", "feature_id", ""])), F.array_join("names", "\t")).alias("header"))
    ordered = body.unionByName(top, allowMissingColumns=True).orderBy("place", "chrom", "end")
    line = F.concat_ws("\t", "chrom", (F.col("end") - 1).cast("string"), F.col("end").cast("string"), "feature_id",
                       *_shown("cells", supplier.count()))
    path = folder(spark, "bed")
    blocks.write_block_gzip(ordered.select(F.when(F.col("place") == 0, F.col("header")).otherwise(line).alias("line")), path)
    return path


def _shown(cells: str, width: int):
    """Texts of sorted ``(at, value)`` cells over ``width`` columns, and of the absent ones after the last.

    The gap before a cell is filled at once, so the work follows the length of the text.
    """
    def text(cell, i):
        before = F.coalesce(F.get(cells, i - 1)["at"], F.lit(-1))
        gap = F.when(before < cell["at"], cell["at"] - before - 1).otherwise(
            F.raise_error(F.lit("two cells of one sample")).cast("int"))
        return F.concat(F.repeat(F.lit("NA\t"), gap), cell["value"].cast("string"))

    last = F.coalesce(F.get(cells, F.size(cells) - 1)["at"], F.lit(-1))
    absent = F.lit(width - 1) - last
    rest = F.when(absent > 0, F.concat(F.repeat(F.lit("NA\t"), absent - 1), F.lit("NA")))
    return F.when(F.size(cells) > 0, F.array_join(F.transform(cells, text), "\t")), rest


def _brand_bed(spark, d) -> str:
    observations = S.observations(spark, d).withColumn("feature_id", S.brand_gene(F.col("gene_id")))
    meta = observations.select("feature_id").distinct().select(
        "feature_id", F.lit("chr1").alias("chrom"),
        F.substring("feature_id", 5, 20).cast("long").alias("end"))
    return _bed_file(spark, d, meta, observations, "feature_id")


def phenotype_bed_file(spark, d):
    """Cells of a wide BED file, read with header, rules and melt."""
    read = bed.read_bed(spark, _brand_bed(spark, d), trim_samples=True)
    rows = read.rows.where(F.coalesce(read.structure_problem(), read.value_problem()).isNull())
    return read.long(rows, read.sample_table()).groupBy("sample_id").agg(
        F.count(F.lit(1)).alias("n_cells"), F.count("value").alias("n_values"),
        F.round(F.sum("value"), 3).alias("total"))


# ------------------------------------------------------------- whole sweeps


def _sweep(spark, d, inputs, pc_counts):
    out = {n: folder(spark, n) for n in (
        "results_output", "summary_output", "gene_pc_qc_output", "analysis_qc_output")}
    lof_pc.run(spark, **inputs, negative_z_thresholds=list(S.Z_LOW), pc_counts=list(pc_counts), **out)
    return out


def _sweep_inputs(spark, d):
    genes = S.table(spark, d, "part").select(S.brand_gene(F.col("p_brand")).alias("gene_id")).distinct()
    return {"phenotype_bed": _brand_bed(spark, d), "lof_carriers": _carrier_file(spark, d),
            "principal_components": _matrix_files(spark, d)[0],
            "protein_coding_genes": written(spark, "genes", genes, ["gene_id"])}


def _typed(spark, path, columns, texts) -> DataFrame:
    """A result file as typed columns, statistics rounded."""
    whole = ("eligible_gene_count", "total_observations", "outlier_observations", "carrier_observations",
             "nonoutlier_observations", "n11", "n10", "n01", "n00", "ac_value", "distance_bp")
    rows, _, _ = tables.read_result_columns(spark, path)

    def typed(name):
        if name in texts:
            return F.col(name)
        if name == "pc_count":
            return F.col(name).cast("int")
        if name in whole:
            return F.col(name).cast("bigint")
        value = F.when(F.col(name) != "NA", F.col(name)).cast("double")
        return value if name == "z_threshold" else F.round(value, 6)

    return rows.select(*[typed(c).alias(c) for c in columns])


def lof_pc_files(spark, d):
    """The whole sweep from files to its results file."""
    out = _sweep(spark, d, _sweep_inputs(spark, d), S.PC_COUNTS)
    return _typed(spark, out["results_output"], vocab.PC_RESULT_COLUMNS, ("carrier_definition",))


def _merged(spark, d):
    inputs = _sweep_inputs(spark, d)
    shards = [_sweep(spark, d, inputs, counts) for counts in SHARDS]
    out = {n: folder(spark, f"merged-{n}") for n in shards[0]}
    merge.run(spark, *[[s[n] for s in shards] for n in (
        "results_output", "summary_output", "gene_pc_qc_output", "analysis_qc_output")], **out)
    return out


def lof_pc_merged_files(spark, d):
    """Two runs of some PC counts each, merged with one false discovery rate."""
    return _typed(spark, _merged(spark, d)["results_output"], vocab.PC_RESULT_COLUMNS, ("carrier_definition",))


def gene_pc_qc_files(spark, d):
    """Gene QC rows of the merged analysis, by PC count and reason."""
    rows, _, _ = tables.read_result_columns(spark, _merged(spark, d)["gene_pc_qc_output"], "gene QC")
    return rows.groupBy(F.col("pc_count").cast("int").alias("pc_count"), "status", "exclusion_reason", "rank").agg(
        F.count(F.lit(1)).alias("n_genes"),
        F.sum(F.col("usable_sample_count").cast("bigint")).alias("usable_samples"))


def _counters(spark, document: dict, **more: int) -> DataFrame:
    """``counter, value``: the whole numbers of a document, names of nested ones joined by dots."""
    rows = []

    def walk(name, value):
        if isinstance(value, dict):
            for key, inner in value.items():
                walk(f"{name}.{key}" if name else key, inner)
        elif isinstance(value, int) and not isinstance(value, bool):
            rows.append((name, value))

    walk("", {**document, **more})
    return spark.createDataFrame(rows, "counter string, value long")


def lof_pc_documents(spark, d):
    """Counters of the analysis QC document of a sweep, those of each PC count too."""
    out = _sweep(spark, d, _sweep_inputs(spark, d), S.PC_COUNTS)
    return _counters(spark, documents.read_object(out["analysis_qc_output"], "QC"))


def prepared_phenotypes(spark, d):
    """Counters of the phenotype preparation, and what its feature and sample tables hold."""
    from tailfold.plans import queries as Q

    meta = S.features(spark, d).select("feature_id", "chrom", F.col("tss").alias("end"))
    bed_path = _bed_file(spark, d, meta, S.feature_observations(spark, d), "feature_id")
    called = S.table(spark, d, "supplier").where("s_suppkey % 3 <> 0").select(
        S.text("s_suppkey").alias("sample_id")).union(
        S.table(spark, d, "nation").select(F.concat(F.lit("V"), S.text("n_nationkey"))))
    features, samples, qc = (folder(spark, f"prepared-{n}") for n in ("features", "samples", "qc"))
    rare_variant.prepare_phenotypes(
        spark, bed_path, written(spark, "called", called, ["sample_id"], header=False), list(PREPARED),
        list(Q.Z_HIGH), "absolute", features, samples, qc)
    return _counters(spark, documents.read_object(qc, "QC"),
                     listed_features=tables.read_features(spark, features, unique=True).count(),
                     listed_samples=tables.read_samples(spark, samples).count())


def calculate_files(spark, d):
    """Carriers among outliers over all strata, from files to the results file."""
    from tailfold.plans import queries as Q

    meta = S.features(spark, d).select("feature_id", "chrom", F.col("tss").alias("end"))
    bed_path = _bed_file(spark, d, meta, S.feature_observations(spark, d), "feature_id")
    samples = S.table(spark, d, "lineitem").select(S.text("l_suppkey").alias("sample_id")).distinct()
    minima = Q.carrier_minimum_distance(spark, d).select(*vocab.MINIMA_COLUMNS)
    seen = S.table(spark, d, "lineitem").select(F.col("l_partkey").alias("p_partkey")).distinct()
    features = S.features(spark, d).join(seen, "p_partkey").select(*vocab.FEATURE_COLUMNS)
    out, summary = folder(spark, "calculated"), folder(spark, "calculated-summary")
    rare_variant.calculate(
        spark, bed_path, written(spark, "samples", samples, ["sample_id"], header=False),
        written(spark, "minima", minima, list(vocab.MINIMA_KEYS)),
        written(spark, "features", features, ["chrom", "tss"]), list(Q.EXACT_AC), list(Q.CUMULATIVE_AC),
        list(Q.Z_HIGH), list(Q.DISTANCES), "absolute", out, summary,
        consequence_classes=list(S.CONSEQUENCES), loftee_enabled=True)
    return _typed(spark, out, vocab.ANNOTATION_RESULT_COLUMNS,
                  ("tail", "annotation_family", "annotation_class", "ac_class", "ac_kind"))


# -------------------------------------------------------- variants and regions


def records_in_query_chunks(spark, d):
    windows = query_windows(S.features(spark, d), REACH)
    records = S.variants(spark, d).withColumn("end_pos", S.record_end_bp())
    located = records_in_chunks(records, windows, REACH, REACH_CHUNK)
    return located.select("o_orderkey", "chrom", F.col("chunk.window").alias("window_start"),
                          F.col("chunk.piece").alias("piece"), "starts_here")


def block_gzip_lines(spark, d):
    """Orders written as block gzip and read back as lines."""
    path = folder(spark, "orders-bgz")
    blocks.write_block_gzip(S.order_lines(spark, d), path)
    fields = F.split("line", "\t")
    return text.read_lines(spark, path).select("line", fields.alias("f")).groupBy(
        F.get("f", F.lit(2)).alias("o_orderpriority")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("line")).alias("n_chars"),
        F.sum(F.get("f", F.lit(0)).cast("bigint")).alias("keys"),
        F.sum(F.get("f", F.lit(3)).cast("bigint")).alias("cents"),
        F.count_distinct(F.get("f", F.lit(1))).alias("n_states"))


def _vcf_file(spark, d) -> str:
    path = folder(spark, "cohort-vcf")
    lines = S.cohort_vcf(spark, d).repartitionByRange("part", "o_orderkey").sortWithinPartitions(
        "part", "o_orderkey")
    blocks.write_block_gzip(lines, path)
    return path


def vcf_file(spark, d):
    """Records of a VCF file under all its rules."""
    source = vcf.read_vcf(spark, _vcf_file(spark, d))
    gt = G.genotype_index(F.col("format"))
    text.fail_on_violation(source.records, vcf.record_problem(len(source.samples)), "VCF", source.lines)
    return source.records.groupBy("chrom").agg(
        F.count(F.lit(1)).alias("n_records"), F.sum("pos").alias("positions"), F.sum("end_pos").alias("ends"),
        F.min(gt).alias("gt_index"), F.max(F.size("samples")).alias("n_samples")).withColumn(
        "n_contigs", F.lit(len(source.contigs)))


def _near_alleles(spark, d):
    """Alleles of every record in every query chunk that it reaches, all chromosomes at once."""
    layout = folder(spark, "cohort-regions")
    regions.index_vcf(spark, _vcf_file(spark, d), layout, SPAN)
    laid = regions.read_layout(spark, layout)
    windows = query_windows(S.features(spark, d), REACH)
    located = records_in_chunks(laid.near(windows), windows, REACH, REACH_CHUNK)
    return laid, C.alt_alleles(located.drop("chunk", "n_fields", "pos_text"))


def region_allele_counters(spark, d):
    return C.allele_counters(_near_alleles(spark, d)[1], ["chrom"])


def region_record_starts(spark, d):
    _, alleles = _near_alleles(spark, d)
    return alleles.groupBy("chrom", "alt_index").agg(
        F.count_if("starts_here").alias("n_starting"), F.count_if(~F.col("starts_here")).alias("n_reaching"),
        F.min("pos").alias("first_pos"), F.max("end_pos").alias("last_pos"), F.sum("ac").alias("ac_total"))


def genotype_carrier_minima(spark, d):
    """Minima from the genotype arrays of a VCF; one of the seven samples is not shared."""
    from tailfold import config
    from tailfold.plans import queries as Q

    laid, alleles = _near_alleles(spark, d)
    parsed = stage(T.interpret(S.transcript_rows(spark, d)).select(
        *T.ALLELE, "ord", "frequency", "gene_key", "consequence_rank", "loftee_rank"), "annotation-rows")
    counted = alleles.where("ac IS NOT NULL AND starts_here")
    known = C.rare(C.with_frequency(counted, T.allele_frequencies(parsed)), Q.MAX_MAF)
    names = [(i, n) for i, n in enumerate(laid.header["samples"]) if n != "L3"]
    kept = known.select(*T.ALLELE, "ac", C.shared_carriers([i for i, _ in names]).alias("carrier_positions"))
    features = S.features(spark, d).select(*vocab.FEATURE_COLUMNS)
    pairs = C.feature_pairs(kept, features, T.gene_annotations(parsed), REACH)
    return C.carrier_minima(
        pairs, spark.createDataFrame(names, "position int, sample_id string"),
        config.ac_classes(Q.EXACT_AC, Q.CUMULATIVE_AC), S.CONSEQUENCES, ("chrom",))


def _vat_file(spark, d) -> str:
    rows = S.transcript_rows(spark, d).select(
        "chrom", "pos", "ref", "alt", F.lit(".").alias("rsid"), "gene_id", "consequence", "gvs_max_af",
        vocab.VAT_LOFTEE_COLUMN, F.col("o_orderkey").alias("_k"), F.col("ord").alias("_o"))
    return written(spark, "vat", rows, ["_k", "_o"], compress=True, bounds=_bounds(S.table(spark, d, "lineitem"), "l_orderkey"))


def _bounds(rows: DataFrame, column: str) -> list:
    """Values that cut ``rows`` into slices of like size."""
    count = min(TEXT_SLICES, rows.count() // regions.SLICE_ROWS)
    cuts = [i / count for i in range(1, count)]
    return sorted(set(rows.agg(F.percentile_approx(column, cuts)).first()[0] or [])) if cuts else []


def annotation_file_counters(spark, d):
    """Counters of an annotation file and of its layout by region, read near the features."""
    path, layout, manifest = _vat_file(spark, d), folder(spark, "vat-regions"), folder(spark, "vat-schema")
    release(spark)
    rare_variant.prepare_vat(spark, path, [f"chr{i}" for i in range(5)], manifest)
    schema = vat.VatSchema.from_json(files.read_text(manifest))
    windows = stage(query_windows(S.features(spark, d), REACH), "windows")

    def counted(source: str, where: str) -> DataFrame:
        rows, lines = regions.open_vat(spark, where, schema)
        parsed = T.interpret(within_windows(rows(windows), windows, REACH, REACH_CHUNK))
        return stage(T.row_counters(parsed, ["chrom"]).withColumn("source", F.lit(source)), f"{source}-counters")

    # one after the other: what a step leaves on disk is gone before the next
    counters = [counted("text", path)]
    release(spark)
    regions.index_vat(spark, path, layout, SPAN)
    files.delete(path)
    counters.append(counted("layout", layout))
    files.delete(layout)
    release(spark, windows)
    return reduce(DataFrame.unionByName, counters)


FILE_QUERIES = {
    f.__name__: f for f in (
        sample_matrix_files, lof_carrier_file, coding_gene_file, feature_file, sample_file,
        gathered_minima_files, selection_from_file, phenotype_bed_file, lof_pc_files,
        lof_pc_merged_files, gene_pc_qc_files, lof_pc_documents, prepared_phenotypes, calculate_files, records_in_query_chunks,
        block_gzip_lines, vcf_file, region_allele_counters, region_record_starts,
        genotype_carrier_minima, annotation_file_counters,
    )
}
