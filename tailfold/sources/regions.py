"""Position tables laid out by region, so that a query of some windows opens the files it needs.

A layout is a folder: ``records`` (Parquet by chromosome and stretch of ``span_bp`` positions, or several
neighbouring ones where there would be very many folders, sorted by position inside), ``manifest`` (one row a stretch: where its records begin and how far they reach) and
``header`` (a JSON line).  A reader works out the stretches whose records can reach a window, which
also finds long records that begin in an earlier stretch; they become a partition filter, and the
outermost window positions of every chromosome become pushed ranges over the row groups.
"""

from __future__ import annotations

import bisect
import contextlib
import json
import math
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tailfold import files
from tailfold.session import release, stage, staging_root
from tailfold.sources import text
from tailfold.sources import vat as vat_source
from tailfold.sources import vcf as vcf_source

SPAN_BP = 10_000_000
#: Folders of records that a layout has at most, or one or two more a chromosome.
FOLDERS = 400
#: Slices, of so many rows at least, that are sorted one after the other.
SLICES, SLICE_ROWS = 8, 1_000_000
SLICE = "region_slice"
#: Row groups of a staged slice.
STAGED_BYTES = 16 << 20


def is_layout(path) -> bool:
    return files.exists(f"{path}/manifest")


def write_layout(rows: DataFrame, path, header: dict, span_bp: int = SPAN_BP,
                 problem: Column | None = None, refuse: Callable[[], None] | None = None) -> None:
    """Lay out rows with ``chrom``, ``pos`` and ``end_pos``.

    A first pass finds the stretches, and whether any row has a ``problem``; then ``refuse`` is called.
    A second one parses the rows into staged slices of whole folders.  The ranges of a slice are sampled
    and sorted from there, and it is deleted before the next one, so at no time are all rows on disk
    twice.  A crowded stretch is written by several tasks.
    """
    spark = rows.sparkSession
    span = F.floor(F.col("pos") / span_bp).cast("bigint")
    said = F.lit(None).cast("string") if problem is None else problem
    reach = stage(rows.select("chrom", "pos", "end_pos", said.alias("problem")).groupBy(
        "chrom", span.alias("span")).agg(
        F.min("pos").alias("first"), F.max("end_pos").alias("last"), F.count(F.lit(1)).alias("n_rows"),
        F.count("problem").alias("n_problems")), "region-reach")
    if refuse is not None and reach.agg(F.sum("n_problems").alias("n")).first().n:
        refuse()
    manifest = reach.select("chrom", "span", "first", "last", "n_rows")
    extents = reach.groupBy("chrom").agg((F.max("span") - F.min("span") + 1).alias("n"))
    shared = max(1, math.ceil((extents.agg(F.sum("n").alias("n")).first().n or 0) / FOLDERS))

    def folder(span: Column) -> Column:
        return span - F.pmod(span, F.lit(shared))

    starts = _slice_starts(reach.groupBy("chrom", folder(F.col("span")).alias("span")).agg(
        F.sum("n_rows").alias("n")).orderBy("chrom", "span").collect())
    staged = f"{staging_root(spark).rstrip('/')}/region-rows-{uuid.uuid4().hex}"
    place = F.struct("chrom", folder(span).alias("span"))
    number = reduce(Column.__add__, [
        F.when(place >= F.struct(F.lit(c).alias("chrom"), F.lit(s).alias("span")), 1).otherwise(0)
        for c, s in starts], F.lit(0))
    try:
        # as many open files as slices, so that wide rows are not sorted; each holds little in memory
        with _setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(len(starts) + 1)):
            rows.withColumn(SLICE, number).write.option("compression", "zstd").option(
                "parquet.block.size", STAGED_BYTES).partitionBy(SLICE).parquet(staged)
        for i in range(len(starts) + 1):
            part = f"{staged}/{SLICE}={i}"
            if i and not files.exists(part):
                continue
            own = spark.read.schema(rows.schema).parquet(part) if files.exists(part) else rows.limit(0)
            own.withColumn("span", folder(span)).repartitionByRange("chrom", "pos").sortWithinPartitions(
                "chrom", "span", "pos").write.option("compression", "zstd").mode(
                "append" if i else "errorifexists").partitionBy("chrom", "span").parquet(f"{path}/records")
            del own
            files.delete(part)
            release(spark)
    finally:
        files.delete(staged)
    settings = {**header, "span_bp": span_bp} | ({"spans_per_folder": shared} if shared > 1 else {})
    spark.createDataFrame([(json.dumps(settings), rows.schema.json())],
                          "header string, rows string").write.parquet(f"{path}/header")
    # last, because it makes the folder a layout
    manifest.write.parquet(f"{path}/manifest")
    release(spark, reach)


@contextlib.contextmanager
def _setting(spark: SparkSession, name: str, value: str):
    """A session setting for the time of one job."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _slice_starts(folders) -> list[tuple[str, int]]:
    """First folders of all slices but the first, for folders in order with their numbers of rows."""
    least = max(SLICE_ROWS, math.ceil(sum(f["n"] for f in folders) / SLICES))
    starts, held = [], 0
    for f in folders:
        if held >= least and f["chrom"] is not None and f["span"] is not None:
            starts.append((f["chrom"], f["span"]))
            held = 0
        held += f["n"]
    return starts


@dataclass(frozen=True)
class Layout:
    header: dict
    records: DataFrame
    manifest: DataFrame

    def folders(self, windows: DataFrame) -> dict[str, tuple[list[int], int, int]]:
        """By chromosome: folders (by their first stretch) with records that can reach a window, first
        and last window position.

        All of it is bounded by the length of the genome over ``span_bp``.
        """
        width, shared = self.header["span_bp"], self.header.get("spans_per_folder", 1)
        spans = windows.select("chrom", F.explode(F.sequence(
            F.floor(F.col("start") / width), F.floor(F.col("end") / width))).alias("span"))
        touched = {r["chrom"]: r["spans"] for r in spans.groupBy("chrom").agg(
            F.sort_array(F.collect_set("span")).alias("spans")).collect()}
        limits = {r["chrom"]: (r["a"], r["b"]) for r in windows.groupBy("chrom").agg(
            F.min("start").alias("a"), F.max("end").alias("b")).collect()}
        needed: dict[str, set[int]] = {}
        for row in self.manifest.where(F.col("chrom").isin(*touched)).collect() if touched else []:
            own = touched[row["chrom"]]
            # the first touched stretch from this one on
            at = bisect.bisect_left(own, row["span"])
            if at < len(own) and own[at] <= max(row["span"], row["last"] // width):
                needed.setdefault(row["chrom"], set()).add(row["span"] - row["span"] % shared)
        return {c: (sorted(found), *limits[c]) for c, found in needed.items()}

    def near(self, windows: DataFrame) -> DataFrame:
        """Records of those folders that lie between the outermost windows of their chromosome."""
        def wanted(chrom: str, folders: list[int], first: int, last: int) -> Column:
            return ((F.col("chrom") == chrom) & F.col("span").isin(*folders)
                    & (F.col("pos") <= last) & (F.col("end_pos") >= first))

        parts = [wanted(c, *found) for c, found in sorted(self.folders(windows).items())]
        return self.records.where(reduce(Column.__or__, parts, F.lit(False))).drop("span")


def read_layout(spark: SparkSession, path) -> Layout:
    head = spark.read.schema("header string, rows string").parquet(f"{path}/header").first()
    schema = spark.createDataFrame([], _schema(head["rows"])).withColumn("span", F.lit(0).cast("bigint")).schema
    return Layout(
        json.loads(head["header"]), spark.read.schema(schema).parquet(f"{path}/records"),
        spark.read.schema("chrom string, span bigint, first bigint, last bigint, n_rows bigint")
        .parquet(f"{path}/manifest"))


def _schema(text_form: str):
    from pyspark.sql.types import StructType
    return StructType.fromJson(json.loads(text_form))


# ------------------------------------------------------------- VCF and VAT


def index_vcf(spark: SparkSession, vcf, output, span_bp: int = SPAN_BP) -> None:
    """Lay out the records of a VCF; one that has no place is an error."""
    source = vcf_source.read_vcf(spark, vcf)
    problem = F.coalesce(
        F.when(F.col("n_fields") < vcf_source.FIXED, "too few fixed columns"),
        F.when(F.col("pos").isNull(), "a non-integer position"))
    write_layout(source.records, output,
                 {"samples": source.samples, "contigs": sorted(source.contigs)}, span_bp, problem,
                 lambda: text.fail_on_violation(source.records, problem, "VCF", source.lines))


def index_vat(spark: SparkSession, vat, output, span_bp: int = SPAN_BP) -> None:
    """Lay out the rows of an annotation table, with a digest in place of the line."""
    schema, rows = vat_source.read_vat(spark, vat)
    problem = vat_source.row_problem(schema)
    write_layout(vat_source.digested(rows).withColumn("end_pos", F.col("pos")), output,
                 {"header": list(schema.header)}, span_bp, problem,
                 lambda: text.fail_on_violation(rows, problem, "VAT", text.read_lines(spark, vat)))


def open_vcf(spark: SparkSession, path):
    """``samples, contigs, records near windows, lines``; the lines of a layout are not known."""
    if not is_layout(path):
        source = vcf_source.read_vcf(spark, path)
        return source.samples, source.contigs, lambda windows: source.records, source.lines
    layout = read_layout(spark, path)
    return layout.header["samples"], set(layout.header["contigs"]), layout.near, None


def open_vat(spark: SparkSession, path, schema: vat_source.VatSchema):
    """``rows near windows, lines`` of an annotation table or its layout."""
    if not is_layout(path):
        _, rows = vat_source.read_vat(spark, path, schema)
        return lambda windows: vat_source.digested(rows), text.read_lines(spark, path)
    layout = read_layout(spark, path)
    if tuple(layout.header["header"]) != schema.header:
        raise ValueError("the annotation layout was made with another header")
    return lambda windows: layout.near(windows).drop("end_pos"), None
