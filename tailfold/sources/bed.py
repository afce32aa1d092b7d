"""Wide phenotype BED: one row per feature, one column per sample."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tailfold import config
from tailfold.functions import values as V
from tailfold.sources import text

LEADING = 4
# the sample map comes from one header line; up to this many names it is broadcast
BROADCAST_SAMPLES = 1_000_000


@dataclass(frozen=True)
class PhenotypeBed:
    """Header names and feature rows ``(ord, chrom, start, end, feature, fields)``."""

    samples: list[str]
    rows: DataFrame
    lines: DataFrame
    width: int

    def sample_table(self) -> DataFrame:
        """``(sample_idx, sample_id)`` in column order."""
        spark = self.rows.sparkSession
        return spark.createDataFrame(
            list(enumerate(self.samples)), "sample_idx int, sample_id string")

    def structure_problem(self):
        """Field count, interval and chromosome rules shared by all commands."""
        return F.coalesce(
            F.when(F.size("fields") != self.width, F.lit(f"not {self.width} columns")),
            V.tss_problem(F.col("start"), F.col("end")),
            F.when(F.col("chrom") == "", "an empty chromosome"),
        )

    def value_problem(self):
        cells = F.slice("fields", LEADING + 1, len(self.samples))
        return F.when(F.exists(cells, V.is_bad_phenotype), "a non-numeric or non-finite value")

    def long(self, rows: DataFrame, samples: DataFrame) -> DataFrame:
        """Melt ``rows`` to one value per shared sample.

        ``posexplode`` streams the values of a row; ``unpivot`` would plan one
        projection per sample column.  Other samples go before values are parsed.
        The ``outer`` form keeps Spark from splitting each wide line a second time
        for an emptiness test.
        """
        keep = [c for c in rows.columns if c != "fields"]
        cells = F.slice("fields", LEADING + 1, len(self.samples))
        melted = rows.select(*keep, F.posexplode_outer(cells).alias("sample_idx", "text"))
        if len(self.samples) <= BROADCAST_SAMPLES:
            samples = F.broadcast(samples)
        parsed = melted.join(samples, "sample_idx").select(
            *keep, "sample_id", "text", V.phenotype(F.col("text")).alias("value"))
        return parsed.select(*keep, "sample_id", "value", (
            F.col("value").isNull() & ~V.is_missing_phenotype(F.col("text"))).alias("bad"))


def read_bed(spark: SparkSession, path, trim_samples: bool) -> PhenotypeBed:
    lines = text.read_lines(spark, path)
    header_text = text.first_line(spark, path, "phenotype BED")
    header = header_text.split("\t")
    if len(header) <= LEADING:
        raise ValueError("phenotype BED header needs four leading columns and one sample")
    # fixed values: names of the first three columns
    if header[:3] != ["#chr", "start", "end"] or not header[3]:
        raise ValueError("phenotype BED header must begin with #chr, start, end, feature ID")
    samples = [s.strip() if trim_samples else s for s in header[LEADING:]]
    if trim_samples and not all(samples):
        raise ValueError("phenotype BED header has an empty sample ID")
    config.require_unique(samples, "sample")
    fields = text.raw_fields(lines, header_text)
    rows = fields.select(
        "ord", "fields", *[F.get("fields", F.lit(i)).alias(n)
                           for i, n in enumerate(("chrom", "start", "end", "feature"))])
    return PhenotypeBed(samples, rows, lines, len(header))
