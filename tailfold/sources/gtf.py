"""Gene annotation (GTF) reduced to protein-coding gene records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tailfold.functions import values as V
from tailfold.sources import text


def gene_records(lines: DataFrame) -> DataFrame:
    """Nine-field ``gene`` records: ``gene_type`` and normalised ``gene_id``."""
    fields = F.split("line", "\t")
    records = lines.select(fields.alias("f")).where((F.size("f") == 9) & (F.get("f", F.lit(2)) == "gene"))
    attributes = F.get("f", F.lit(8))
    gene = V.drop_version(V.strip(F.coalesce(V.gtf_attribute(attributes, "gene_id"), F.lit(""))))
    return records.select(
        V.gtf_attribute(attributes, "gene_type").alias("gene_type"), gene.alias("gene_id"))


def coding_records(records: DataFrame) -> DataFrame:
    # fixed value: biotype of the genes under analysis
    return records.where((F.col("gene_type") == "protein_coding") & (F.col("gene_id") != ""))


def read_gtf(spark: SparkSession, path) -> DataFrame:
    return text.read_lines(spark, path)
