"""Tabular text inputs with fixed headers."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tailfold import vocab
from tailfold.functions import values as V
from tailfold.session import stage
from tailfold.sources import text


def _reject_repeats(rows: DataFrame, key: str, what: str) -> None:
    repeated = rows.groupBy(key).count().where("count > 1").select(key).first()
    if repeated is not None:
        raise ValueError(f"duplicate {what}: {repeated[0]}")


@dataclass(frozen=True)
class SampleMatrix:
    """Numeric columns per sample, as ``(sample_id, <array column>)``."""

    names: list[str]
    table: DataFrame
    sample_count: int


def _numeric_matrix(lines: DataFrame, header: str, columns: list[str], id_at: int,
                    array: str, what: str) -> SampleMatrix:
    rows = text.quoted_fields(lines, header, columns, what)
    numbers = [i for i in range(len(columns)) if i != id_at]
    sample = V.strip(text.cell(id_at))
    cells = F.concat(
        F.slice("fields", 1, id_at), F.slice("fields", id_at + 2, len(columns)))
    typed = rows.select(
        "ord", "malformed", sample.alias("sample_id"), F.transform(cells, V.to_double).alias(array))
    problem = F.coalesce(
        F.when(F.col("malformed"), F.lit(f"not {len(columns)} columns")),
        F.when(F.col("sample_id") == "", "an empty sample ID"),
        F.when(F.exists(array, F.isnull), "a value that is not a finite number"),
    )
    text.fail_on_violation(typed, problem, what, lines)
    out = typed.select("sample_id", array)
    _reject_repeats(out, "sample_id", f"{what} sample ID")
    count = out.count()
    if not count:
        raise ValueError(f"{what} must contain at least one sample")
    return SampleMatrix([columns[i] for i in numbers], out, count)


def pc_header(spark: SparkSession, path) -> tuple[DataFrame, str, list[str]]:
    """Lines, header text and PC names; reads no data row."""
    what = "principal-components TSV"
    lines = text.read_lines(spark, path)
    header = text.first_line(spark, path, what, skip_blank=False)
    columns = text.split_header(header)
    if len(columns) < 2 or columns[0] != "ID":
        raise ValueError(f"{what} header must begin with ID, PC1")
    if columns[1:] != [f"PC{i}" for i in range(1, len(columns))]:
        raise ValueError(f"{what} header PCs must be consecutive from PC1")
    return lines, header, columns


def read_pcs(spark: SparkSession, path) -> SampleMatrix:
    lines, header, columns = pc_header(spark, path)
    return _numeric_matrix(lines, header, columns, 0, "pcs", "principal-components TSV")


def read_covariates(spark: SparkSession, path) -> SampleMatrix:
    what = "additional-covariates TSV"
    lines = text.read_lines(spark, path)
    header = text.first_line(spark, path, what, skip_blank=False)
    columns = [c.strip() for c in text.split_header(header)]
    if not all(columns) or not columns:
        raise ValueError(f"{what} header contains an empty column")
    if len(set(columns)) < len(columns):
        raise ValueError(f"{what} header contains duplicate columns")
    ids = [i for i, c in enumerate(columns) if c in ("sample_id", "ID")]
    if len(ids) != 1:
        raise ValueError(f"{what} header must contain exactly one sample_id or ID column")
    if len(columns) == 1:
        raise ValueError(f"{what} must contain at least one covariate")
    return _numeric_matrix(lines, header, columns, ids[0], "covs", what)


def read_lof_carriers(spark: SparkSession, path) -> tuple[DataFrame, int, int]:
    """``(sample_id, gene_id, has_lof, lof_classes)``, input rows, truthy rows."""
    what = "LoF carrier table"
    lines = text.read_lines(spark, path)
    header = text.first_line(spark, path, what, skip_blank=False)
    columns = text.split_header(header)
    if len(set(columns)) < len(columns):
        raise ValueError(f"{what} header contains duplicate columns")
    absent = [c for c in vocab.LOF_CARRIER_COLUMNS if c not in columns]
    if absent:
        raise ValueError("missing required LoF carrier columns: " + ", ".join(absent))
    rows = text.quoted_fields(lines, header, columns, what, raw=True)

    def cell(name):
        return text.unquoted(text.cell(columns.index(name)))

    typed = rows.select(
        "ord", "malformed", V.strip(cell("sample_id")).alias("sample_id"),
        V.drop_version(V.strip(cell("gene_id"))).alias("gene_id"),
        V.truth(cell("has_lof_variant")).alias("has_lof"),
        cell("lof_classes").alias("lof_classes"),
    )
    problem = F.coalesce(
        F.when(F.col("malformed"), F.lit(f"not {len(columns)} columns")),
        F.when(F.col("sample_id") == "", "an empty sample ID"),
        F.when(F.col("gene_id") == "", "an empty gene ID"),
        F.when(F.col("has_lof").isNull(), "an invalid has_lof_variant"),
    )
    # quoted cells are costly to parse, and the facts and the rows are read apart: parsed once
    parsed = stage(typed.withColumn("problem", problem).select(
        "sample_id", "gene_id", "has_lof", "lof_classes",
        F.when(F.col("problem").isNotNull(), F.struct("ord", "problem")).alias("first")), "lof-carriers")
    facts = parsed.agg(
        F.min("first").alias("first"), F.count(F.lit(1)).alias("rows"),
        F.count_if("has_lof").alias("truthy")).first()
    text.report_first(facts.first, what, lines)
    return parsed.drop("first"), facts.rows, facts.truthy


def read_coding_genes(spark: SparkSession, path) -> tuple[DataFrame, int]:
    what = "protein-coding gene TSV"
    lines = text.read_lines(spark, path)
    header = text.first_line(spark, path, what, skip_blank=False)
    if text.split_header(header) != ["gene_id"]:
        raise ValueError(f"{what} header must be gene_id")
    rows = text.quoted_fields(lines, header, ["gene_id"], what).select(
        "ord", "malformed", V.drop_version(V.strip(text.cell(0))).alias("gene_id"))
    problem = F.coalesce(F.when(F.col("malformed"), "more than one column"),
                         F.when(F.col("gene_id") == "", "an empty gene ID"))
    text.fail_on_violation(rows, problem, what, lines)
    genes = rows.select("gene_id")
    _reject_repeats(genes, "gene_id", "normalized protein-coding gene ID")
    count = genes.count()
    if not count:
        raise ValueError(f"{what} must contain at least one gene")
    return genes, count


def read_features(spark: SparkSession, path, unique: bool = False) -> DataFrame:
    """``(chrom, tss, feature_id)``; ``unique`` also rejects repeated IDs."""
    what = "feature TSV"
    lines = text.read_lines(spark, path)
    header = text.first_line(spark, path, what)
    if header.split("\t") != list(vocab.FEATURE_COLUMNS):
        raise ValueError(f"{what} header must be " + ", ".join(vocab.FEATURE_COLUMNS))
    rows = text.raw_fields(lines, header, what)
    typed = rows.select(
        "ord", F.size("fields").alias("n"), F.get("fields", F.lit(0)).alias("chrom"),
        V.to_long(F.get("fields", F.lit(1))).alias("tss"),
        F.get("fields", F.lit(2)).alias("feature_id"),
    )
    problem = F.coalesce(
        F.when(F.col("n") != 3, "not three columns"),
        F.when(F.col("tss").isNull(), "a non-integer TSS"),
        F.when((F.col("chrom") == "") | (F.col("feature_id") == "") | (F.col("tss") < 1),
               "invalid feature values"),
    )
    text.fail_on_violation(typed, problem, what, lines)
    out = typed.select(*vocab.FEATURE_COLUMNS, "ord")
    if unique:
        _reject_repeats(out, "feature_id", "selected feature ID")
    return out


def read_samples(spark: SparkSession, path) -> DataFrame:
    """Unique sample IDs, one per line, with their order."""
    samples = text.nonempty_lines(spark, path).select(F.col("line").alias("sample_id"), "ord")
    _reject_repeats(samples, "sample_id", "sample ID")
    return samples


def read_minima(spark: SparkSession, path) -> DataFrame:
    """Carrier minimum distances; blank lines are errors here."""
    what = "carrier TSV"
    lines = text.read_lines(spark, path)
    header = text.first_line(spark, path, what, skip_blank=False)
    if header.split("\t") != list(vocab.MINIMA_COLUMNS):
        raise ValueError(f"{what} header does not match the expected header: {path}")
    body = text.body_lines(lines, header, what).select(
        "ord", "line", F.split("line", "\t").alias("f"))
    keys = [F.get("f", F.lit(i)).alias(n) for i, n in enumerate(vocab.MINIMA_KEYS)]
    typed = body.select("ord", "line", F.size("f").alias("n"), *keys,
                        V.to_long(F.get("f", F.lit(5))).alias("minimum_distance_bp"))
    empty = reduce(Column.__or__, [F.col(k) == "" for k in vocab.MINIMA_KEYS])
    distance = F.col("minimum_distance_bp")
    problem = F.coalesce(
        F.when(V.blank(F.col("line")), "no content"),
        F.when(F.col("n") != 6, "not six columns"),
        F.when(empty, "empty key fields"),
        F.when(distance.isNull() | (distance < 0),
               "a minimum_distance_bp that is not a non-negative integer"),
    )
    text.fail_on_violation(typed, problem, what, lines)
    return typed.select(*vocab.MINIMA_COLUMNS)


# -------------------------------------------------------- enrichment results


def read_result_columns(spark: SparkSession, path, what: str = "enrichment results"):
    """Result rows as text columns plus ``ord``; returns (rows, column names)."""
    lines = text.read_lines(spark, path)
    header = text.first_line(spark, path, what, skip_blank=False)
    columns = text.split_header(header)
    rows = text.quoted_fields(lines, header, columns, what)
    named = rows.select("ord", "malformed", *[text.cell(i).alias(c) for i, c in enumerate(columns)])
    return named, columns, lines


def read_selection_rows(spark: SparkSession, path) -> DataFrame:
    """Typed rows for PC selection, with the rule for undefined odds ratios.

    ``NA`` with observations is an error; without any it only means that nothing
    could be estimated, and the row counts as not estimable.
    """
    rows, columns, lines = read_result_columns(spark, path)
    # fixed values: columns a results file must have to be selected from
    required = ("pc_count", "z_threshold", "carrier_definition", "odds_ratio")
    if any(c not in columns for c in required):
        raise ValueError("enrichment results must contain columns: " + ", ".join(required))
    total = V.to_long(F.col("total_observations")) if "total_observations" in columns else (
        F.lit(None).cast("bigint"))
    ratio_text = V.strip(F.col("odds_ratio"))
    non_finite = F.lower(ratio_text).rlike("^[+-]?(inf|infinity|nan)$")
    return rows.select(
        "ord", V.to_long(F.col("pc_count")).cast("int").alias("pc_count"),
        V.to_double(F.col("z_threshold")).alias("z_threshold"), "carrier_definition",
        V.to_double(ratio_text).alias("odds_ratio"), total.alias("total_observations"),
        (V.to_double(ratio_text).isNull() & ~non_finite).alias("undefined"),
    )


def check_selection_rows(rows: DataFrame, thresholds, definitions) -> int:
    """Raise on invalid rows; return how many are skipped for lack of observations."""
    wanted = F.col("carrier_definition").isin(*definitions) & F.col("z_threshold").isin(
        *thresholds)
    no_data = F.coalesce(F.col("total_observations") == 0, F.lit(False))
    facts = rows.agg(
        F.count_if(F.col("pc_count").isNull() | F.col("z_threshold").isNull()).alias("broken"),
        F.count_if(wanted & F.col("undefined") & ~no_data).alias("undefined"),
        F.count_if(wanted & F.col("odds_ratio").isNull() & no_data).alias("skipped"),
    ).first()
    if facts.broken or facts.undefined:
        raise ValueError("enrichment result row has invalid selection fields")
    return facts.skipped
