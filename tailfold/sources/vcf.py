"""VCF text: header facts and variant records."""

from __future__ import annotations

import contextlib
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tailfold.functions import genotype as G
from tailfold.functions import values as V
from tailfold.sources import text

FIXED = 9
# fixed value: contig identifier inside a ``##contig=<...>`` line
CONTIG_ID = re.compile(r"(?:^|,)ID=([^,>]+)")


@dataclass(frozen=True)
class Vcf:
    samples: list[str]
    contigs: set[str]
    records: DataFrame
    lines: DataFrame

    def sample_positions(self) -> DataFrame:
        """``(position, sample_id)``, matching the order of the sample columns."""
        spark = self.records.sparkSession
        return spark.createDataFrame(
            list(enumerate(self.samples)), "position int, sample_id string")


def read_vcf(spark: SparkSession, path) -> Vcf:
    """Records keep their sample columns as one array; nothing is parsed yet."""
    samples, contigs = read_header(spark, path)
    lines = text.read_lines(spark, path)
    body = lines.where((F.col("line") != "") & ~F.col("line").startswith("#"))
    return Vcf(samples, contigs, split_records(body), lines)


def read_header(spark: SparkSession, path) -> tuple[list[str], set[str]]:
    """Samples and contigs, from the lines up to ``#CHROM``."""
    contigs = set()
    with contextlib.closing(text.head_lines(spark, path)) as lines:
        for line in lines:
            if line.startswith("##contig=<"):
                found = CONTIG_ID.search(line[len("##contig=<"):])
                if found:
                    contigs.add(found.group(1))
            elif line.startswith("#CHROM"):
                columns = line.split("\t")
                if len(columns) < FIXED:
                    raise ValueError("VCF header must contain the fixed columns and FORMAT")
                return columns[FIXED:], contigs
    raise ValueError("VCF does not contain a #CHROM header")


def split_records(body: DataFrame) -> DataFrame:
    names = ("chrom", "pos_text", "id", "ref", "alt", "qual", "filter", "info", "format")
    fields = body.select("ord", F.split("line", "\t").alias("f"))
    cells = [F.get("f", F.lit(i)).alias(n) for i, n in enumerate(names)
             if n not in ("id", "qual", "filter")]
    return fields.select(
        "ord", F.size("f").alias("n_fields"), *cells,
        F.slice("f", F.lit(FIXED + 1), F.greatest(F.size("f") - FIXED, F.lit(0))).alias("samples"),
    ).withColumn("pos", V.to_long(F.col("pos_text"))).withColumn(
        "end_pos", record_end(F.col("pos"), F.col("ref"), F.col("info")))


def record_end(pos, ref, info):
    """Last position that a record covers: INFO/END where it does not lie before ``pos``, else the
    end of REF."""
    # fixed value: the END entry of INFO
    stated = F.regexp_extract(info, r"(?:^|;)END=(\d+)", 1).try_cast("bigint")
    return F.when(stated >= pos, stated).otherwise(pos + F.greatest(F.char_length(ref), F.lit(1)) - 1)


def record_problem(sample_count: int):
    """First rule a record breaks, or NULL."""
    alt_count = F.size(F.split("alt", ","))
    gt = G.genotype_index(F.col("format"))
    return F.coalesce(
        F.when(F.col("n_fields") < FIXED, "too few fixed columns"),
        F.when(F.col("n_fields") != FIXED + sample_count, "another number of samples"),
        F.when(F.col("pos").isNull(), "a non-integer position"),
        F.when(gt < 0, "no GT in FORMAT"),
        G.info_ac_problem(F.col("info"), alt_count),
        G.genotype_problem(G.genotype_texts(F.col("samples"), gt), alt_count),
    )
