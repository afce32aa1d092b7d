"""Cohort roles on the TPC-H-like tables, used by the registered queries and bench.

Supplier = sample, brand = gene, part = feature with a TSS, order = variant, lineitem
= transcript row.  Texts (BED, GTF, VCF, annotation rows) are put together from
columns and parsed back by the operators under test.  Every table is read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tailfold import vocab
from tailfold.sources.bed import PhenotypeBed
from tailfold.sources.vcf import split_records

# fixed values: parameters shared with the comparison SQL
PC_COUNTS = (0, 1, 2)
Z_LOW = (-1.0, -1.5, -2.0)
MIN_CELL_ROWS = 12
BASES_PER_PART, BASES_PER_ORDER = 50, 7
SWEEP_BANDS = (-3.0, -4.0, -5.0, -6.0)
CONSEQUENCES = ("stop_gained", "frameshift_variant", "missense_variant", "synonymous_variant")


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its schema is read from the file footers once per path."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def text(column: str) -> Column:
    return F.col(column).cast("string")


# ----------------------------------------------------- sample x gene matrix


def brand_lines(spark, sf_dir) -> DataFrame:
    """Lineitems with supplier as sample and brand as gene."""
    lines = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return lines.join(part, F.col("l_partkey") == F.col("p_partkey")).withColumns(
        {"sample_id": text("l_suppkey"), "gene_id": F.col("p_brand")})


def observations(spark, sf_dir) -> DataFrame:
    """Mean price per (supplier, brand); NULL for thin cells.  Sums are exact decimals."""
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    cells = brand_lines(spark, sf_dir).groupBy("gene_id", "sample_id").agg(
        F.sum(price).cast("double").alias("total"), F.count(F.lit(1)).alias("n"))
    value = F.when(F.col("n") >= MIN_CELL_ROWS, F.col("total") / F.col("n"))
    return cells.select("gene_id", "sample_id", value.alias("value"))


def design(spark, sf_dir, *columns: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    x = F.array(*[F.col(c).cast("double") for c in columns or ("s_acctbal", "s_nationkey")])
    return supplier.select(text("s_suppkey").alias("sample_id"), x.alias("x"))


def lof_carriers(spark, sf_dir) -> DataFrame:
    """Carrier rows: large returned items; line status gives the confidence class."""
    return brand_lines(spark, sf_dir).select(
        "sample_id", "gene_id",
        ((F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 49)).alias("has_lof"),
        F.when(F.col("l_linestatus") == "F", " hc,OS").otherwise("Lc , ,x").alias("lof_classes"),
    )


def sparse_observations(spark, sf_dir) -> DataFrame:
    """0/1 values of few suppliers per part: all exclusion reasons occur."""
    lines = table(spark, sf_dir, "lineitem")
    large = F.when(F.col("l_quantity") >= 45, F.col("l_quantity"))
    top = lines.groupBy("l_partkey", "l_suppkey").agg(F.max(large).alias("q"))
    return top.select(
        text("l_partkey").alias("gene_id"), text("l_suppkey").alias("sample_id"),
        F.when(F.col("q").isNotNull(), F.when(F.col("q") >= 48, 1.0).otherwise(0.0)).alias("value"))


# ------------------------------------------------------ features and variants


def ensembl(number: Column) -> Column:
    return F.concat(F.lit("ENSG"), F.lpad(number.cast("string"), 11, "0"))


def brand_gene(brand: Column) -> Column:
    """A gene ID by the number of a brand."""
    return ensembl(F.regexp_extract(brand, r"(\d+)", 1))


def features(spark, sf_dir) -> DataFrame:
    part = table(spark, sf_dir, "part")
    version = (F.col("p_size") % 9).cast("string")
    return part.select(
        F.concat(F.lit("chr"), (F.col("p_size") % 5).cast("string")).alias("chrom"),
        (F.col("p_partkey") * BASES_PER_PART + 1).alias("tss"),
        F.concat(ensembl(F.col("p_partkey")), F.lit("."), version).alias("feature_id"),
        "p_partkey",
    )


def placed_alleles(spark, sf_dir) -> DataFrame:
    """One allele per order, without its count."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat(F.lit("chr"), (F.col("o_custkey") % 5).cast("string")).alias("chrom"),
        (F.col("o_orderkey") * BASES_PER_ORDER + 1).alias("pos"), F.lit("A").alias("ref"),
        F.col("o_orderstatus").alias("alt"),
    )


def variants(spark, sf_dir) -> DataFrame:
    """One allele per order; its allele count is the number of distinct suppliers."""
    lines = table(spark, sf_dir, "lineitem")
    ac = lines.groupBy("l_orderkey").agg(F.count_distinct("l_suppkey").alias("ac"))
    return placed_alleles(spark, sf_dir).join(ac, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        "o_orderkey", "chrom", "pos", "ref", "alt", F.coalesce("ac", F.lit(0)).alias("ac"))


def carriers_of(spark, sf_dir) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return lines.select("l_orderkey", text("l_suppkey").alias("sample_id")).distinct()


def feature_observations(spark, sf_dir) -> DataFrame:
    """One standardised price per (part, supplier); NULL where it is all discounted."""
    lines = table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    kept = F.when(F.col("l_discount") < 0.095, price)
    cells = lines.groupBy("l_partkey", "l_suppkey").agg(
        F.sum(kept).cast("double").alias("total"), F.count(kept).alias("n"))
    mean = F.try_divide("total", "n")
    return cells.join(features(spark, sf_dir), F.col("l_partkey") == F.col("p_partkey")).select(
        "feature_id", text("l_suppkey").alias("sample_id"),
        ((mean - 50000.0) / 20000.0).alias("value"))


# ---------------------------------------------------------- transcript rows


def transcript_rows(spark, sf_dir) -> DataFrame:
    """Annotation text columns per lineitem, ordered by their whole content."""
    lines = table(spark, sf_dir, "lineitem")
    orders = placed_alleles(spark, sf_dir)
    near = F.floor(F.col("o_orderkey") * BASES_PER_ORDER / BASES_PER_PART) + F.col(
        "l_linenumber") - 4
    gene = F.when(F.col("l_quantity") == 1, "NA").when(F.col("l_quantity") == 2, ".").otherwise(
        F.concat(ensembl(F.greatest(near, F.lit(0))), F.lit("."), text("l_linenumber")))
    terms = F.expr("array('" + "', '".join(vocab.CONSEQUENCE_SEVERITY) + "')")
    first = F.get(terms, (F.col("l_partkey") % 41).cast("int"))
    second = F.when(F.col("l_suppkey") % 7 == 0, "made_up_term").when(
        F.col("l_suppkey") % 7 == 1, "NA").otherwise(
        F.get(terms, (F.col("l_suppkey") % 41).cast("int")))
    separator = F.when(F.col("l_linestatus") == "F", "&").otherwise(", ")
    base = F.col("o_orderkey") % 5
    af = (
        F.when(F.col("l_tax") > 0.075, "NA").when(F.col("l_quantity") == 50, "abc")
        .when(F.col("l_quantity") == 49, "1.5").when(F.col("l_discount") > 0.095, "0.25")
        .when(base == 0, "0.001").when(base == 1, "0.99").when(base == 2, "9.99e-1")
        .when(base == 3, "0.02").otherwise("0.01")
    )
    lof = F.when(F.col("l_returnflag") == "R", " hc").when(
        F.col("l_returnflag") == "A", "LC").when(F.col("l_linestatus") == "F", ".").otherwise("OS")
    order = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_tax", "l_discount")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "chrom", "pos", "ref", "alt", gene.alias("gene_id"),
        F.concat(first, separator, second).alias("consequence"), af.alias("gvs_max_af"),
        lof.alias(vocab.VAT_LOFTEE_COLUMN), order.alias("ord"), "o_orderkey", "l_partkey",
    )


# -------------------------------------------------------------- file texts


def bed(spark, sf_dir) -> PhenotypeBed:
    """BED lines of lineitems with their four measures as sample columns."""
    lines = table(spark, sf_dir, "lineitem")
    at = F.col("l_partkey") * 10 + F.col("l_linenumber")
    discount = F.when(F.col("l_discount") < 0.005, "NA").when(
        F.col("l_discount") < 0.015, " nan ").otherwise(text("l_discount"))
    line = F.concat_ws(
        "\t", F.concat(F.lit("chr"), text("l_linenumber")), at.cast("string"),
        (at + 1).cast("string"),
        F.concat(F.lit("P"), text("l_suppkey"), F.lit("_"), ensembl(F.col("l_partkey")),
                 F.lit("."), text("l_linenumber")),
        text("l_quantity"), text("l_extendedprice"), discount, text("l_tax"))
    fields = lines.select(F.split(line, "\t").alias("fields"))
    rows = fields.select("fields", *[
        F.get("fields", F.lit(i)).alias(n)
        for i, n in enumerate(("chrom", "start", "end", "feature"))])
    return PhenotypeBed(["quantity", "price", "discount", "tax"], rows, rows, 8)


def gtf_lines(spark, sf_dir) -> DataFrame:
    part = table(spark, sf_dir, "part")
    kind = F.when(F.col("p_size") % 10 == 0, "exon").otherwise("gene")
    biotype = F.when(F.col("p_type") == "ECONOMY", "lncRNA").otherwise("protein_coding")
    number = F.floor(F.col("p_partkey") / 2).cast("bigint")
    attributes = F.concat(
        F.lit('gene_id "'), ensembl(number), F.lit("."), text("p_size"),
        F.lit('"; gene_type "'), biotype, F.lit('"; note  two words;  gene_name "'),
        F.col("p_name"), F.lit('";'))
    return part.select(F.concat_ws(
        "\t", F.lit("chr1"), F.lit("made"), kind, text("p_partkey"), text("p_partkey"),
        F.lit("."), F.lit("+"), F.lit("."), attributes).alias("line"))


def _vcf_lines(spark, sf_dir, alt: Column, info: Column) -> DataFrame:
    """``o_orderkey, line`` of two-ALT records per order; the seven line numbers are the samples."""
    lines = table(spark, sf_dir, "lineitem")
    code = (F.col("l_quantity").cast("int") % 6)
    texts = F.element_at(
        F.array(*[F.lit(t) for t in ("0/0:9", "0/1:9", "1|2:9", "./.:9", "1/.:9", "2")]), code + 1)
    per_line = lines.groupBy("l_orderkey").agg(*[
        F.max(F.when(F.col("l_linenumber") == j, texts)).alias(f"s{j}") for j in range(1, 8)])
    placed = variants(spark, sf_dir).join(
        per_line, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    line = F.concat_ws(
        "\t", "chrom", text("pos"), text("o_orderkey"), "ref", alt, F.lit("."),
        F.lit("PASS"), info, F.lit("GT:DP"),
        *[F.coalesce(f"s{j}", F.lit(".")) for j in range(1, 8)])
    return placed.select("o_orderkey", line.alias("line"))


def _info() -> Column:
    return (
        F.when(F.col("o_orderkey") % 4 == 0, "DP=4;AC=1,2").when(F.col("o_orderkey") % 4 == 1, "AC=.")
        .when(F.col("o_orderkey") % 4 == 2, "AC=3,.;DP=1").otherwise("DP=7"))


def vcf_records(spark, sf_dir) -> DataFrame:
    body = _vcf_lines(spark, sf_dir, F.lit("C,G"), _info())
    return split_records(body.withColumnRenamed("o_orderkey", "ord")).drop("n_fields", "pos_text")


LONG_RECORD_BP, FAR_RECORD_BP = 90, 3000


def record_end_bp() -> Column:
    """Records cover up to 90 positions, some far more."""
    far = F.when(F.col("o_orderkey") % 500 == 3, FAR_RECORD_BP).otherwise(0)
    return F.col("pos") + F.col("o_orderkey") % LONG_RECORD_BP + far


def cohort_vcf(spark, sf_dir) -> DataFrame:
    """A VCF, header lines included, of long records whose first ALT the annotation rows know."""
    info = F.concat(_info(), F.lit(";END="), record_end_bp().cast("string"))
    header = ["##fileformat=VCFv4.2", *(f"##contig=<ID=chr{i}>" for i in range(5)),
              "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT",
                         *(f"L{j}" for j in range(1, 8))])]
    top = spark.createDataFrame(list(enumerate(header)), "o_orderkey long, line string")
    body = _vcf_lines(spark, sf_dir, F.concat(F.col("alt"), F.lit(",G")), info)
    return top.withColumn("part", F.lit(0)).unionByName(body.withColumn("part", F.lit(1)))


def order_lines(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.select(F.concat_ws(
        "\t", text("o_orderkey"), "o_orderstatus", "o_orderpriority",
        (F.col("o_totalprice") * 100).cast("decimal(18,0)").cast("string")).alias("line"))


# --------------------------------------------------------- sweep-like results


def sweep_results(spark, sf_dir) -> DataFrame:
    """An odds ratio per (line number, quantity band, return flag): a small sweep grid."""
    from tailfold.functions.tables import table_statistics

    lines = table(spark, sf_dir, "lineitem")
    band = -3.0 - F.floor((F.col("l_quantity") - 1) / 13).cast("double")
    definition = F.when(F.col("l_returnflag") == "R", "HC").when(
        F.col("l_returnflag") == "A", "any_lof").otherwise("HC_or_LC")
    cheap, closed = F.col("l_discount") > 0.045, F.col("l_linestatus") == "F"
    cells = lines.groupBy(
        (F.col("l_linenumber") * 10).alias("pc_count"), band.alias("z_threshold"),
        definition.alias("carrier_definition"),
    ).agg(
        F.count_if(cheap & closed).alias("n11"), F.count_if(~cheap & closed).alias("n10"),
        F.count_if(cheap & ~closed).alias("n01"), F.count_if(~cheap & ~closed).alias("n00"))
    stats = table_statistics(F.col("n11"), F.col("n11") + F.col("n01"), F.col("n10"),
                             F.col("n10") + F.col("n00"))
    return cells.withColumn("odds_ratio", stats["odds_ratio"])


def supplier_tables(spark, sf_dir) -> DataFrame:
    """A 2x2 table per (return flag, supplier)."""
    lines = table(spark, sf_dir, "lineitem")
    large, closed = F.col("l_quantity") >= 30, F.col("l_linestatus") == "F"
    return lines.groupBy("l_returnflag", "l_suppkey").agg(
        F.count_if(large & closed).alias("n11"), F.count_if(~large & closed).alias("n10"),
        F.count_if(large & ~closed).alias("n01"), F.count_if(~large & ~closed).alias("n00"))
