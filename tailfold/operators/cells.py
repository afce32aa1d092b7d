"""2x2 result tables over the configured grids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tailfold import vocab
from tailfold.config import AcClass
from tailfold.functions.tables import fisher_exact, table_statistics
from tailfold.functions.values import outlier
from tailfold.operators.fdr import benjamini_hochberg


def _one_row(spark: SparkSession) -> DataFrame:
    return spark.range(1).select()


def _dimension(df: DataFrame, name: str, structs: list) -> DataFrame:
    """Append a configured dimension as literals; no table, hence no join."""
    return df.withColumn(name, F.explode(F.array(*structs)))


# ------------------------------------------------------- PC sweep (two cells
# of the table are ordered as: n10 = other carriers, n01 = outlying others)


def sweep_totals(genes: DataFrame) -> DataFrame:
    """Sums of the per-gene table by PC count, over eligible genes."""
    eligible = F.col("reason").isNull()
    counts = genes.columns[genes.columns.index("c0"):]
    return genes.groupBy("pc_count").agg(
        F.count_if(eligible).alias("eligible_gene_count"),
        F.coalesce(F.sum(F.when(eligible, F.col("usable"))), F.lit(0)).alias("total_observations"),
        *[F.sum(c).alias(c) for c in counts],
        *[F.count_if(F.col("reason") == r).alias(r) for r in vocab.EXCLUSION_REASONS],
    )


def sweep_cells(totals: DataFrame, pc_counts, thresholds) -> DataFrame:
    """One row per PC count, threshold and carrier definition, in grid order."""
    spark = totals.sparkSession
    grid = _dimension(_one_row(spark), "pc_count", [F.lit(k) for k in pc_counts])
    full = grid.join(totals, "pc_count", "left")
    entries = [
        F.struct(
            F.lit(t).alias("t"), F.lit(float(threshold)).alias("z_threshold"),
            F.lit(d).alias("d"), F.lit(definition).alias("carrier_definition"),
            F.col(f"o{t}").alias("outliers"), F.col(f"c{d}").alias("carriers"),
            F.col(f"x{t}_{d}").alias("hits"),
        )
        for t, threshold in enumerate(thresholds)
        for d, definition in enumerate(vocab.CARRIER_DEFINITIONS)
    ]
    rows = full.select(
        "pc_count", "eligible_gene_count", "total_observations",
        F.explode(F.array(*entries)).alias("e"),
    )

    def zero(c):
        return F.coalesce(F.col(c), F.lit(0)).cast("bigint")

    n11, n10 = zero("e.hits"), zero("e.carriers") - zero("e.hits")
    n01 = zero("e.outliers") - zero("e.hits")
    return rows.select(
        "pc_count", F.col("e.t").alias("threshold_order"), F.col("e.d").alias("definition_order"),
        F.col("e.z_threshold").alias("z_threshold"),
        F.col("e.carrier_definition").alias("carrier_definition"),
        zero("eligible_gene_count").alias("eligible_gene_count"),
        zero("total_observations").alias("total_observations"),
        zero("e.outliers").alias("outlier_observations"),
        zero("e.carriers").alias("carrier_observations"),
        n11.alias("n11"), n10.alias("n10"), n01.alias("n01"),
        (zero("total_observations") - n11 - n10 - n01).alias("n00"),
    )


def sweep_statistics(cells: DataFrame) -> DataFrame:
    """Rates, odds ratios, exact test and global FDR of the PC-sweep cells."""
    n11, n10, n01, n00 = (F.col(c) for c in ("n11", "n10", "n01", "n00"))
    stats = table_statistics(n11, n11 + n01, n10, n10 + n00)
    scored = cells.withColumns(stats).withColumn(
        "fisher_p_value", fisher_exact("n11", "n10", "n01", "n00"))
    return benjamini_hochberg(scored, small=True).select(
        "threshold_order", "definition_order", *vocab.PC_RESULT_COLUMNS)


# ---------------------------------------------- annotation strata (here n10 =
# outlying others and n01 = other carriers)


def observation_totals(observations: DataFrame, thresholds, tail: str) -> DataFrame:
    """One row: observed, missing and outlying observations per threshold."""
    value = F.col("value")
    return observations.agg(
        F.count(value).alias("total_observations"),
        F.count_if(value.isNull()).alias("missing_z_observations"),
        *[F.count_if(outlier(value, t, tail)).alias(f"o{i}") for i, t in enumerate(thresholds)],
    )


def stratum_counts(observations: DataFrame, minima: DataFrame, thresholds, distances,
                   tail: str) -> DataFrame:
    """Carriers and outlying carriers per annotation, AC class and distance.

    Only the minimum distance of a carrier key is stored, so every distance
    threshold is a conditional count over the same joined rows.
    """
    seen = observations.where("value IS NOT NULL").select("feature_id", "sample_id", "value")
    joined = seen.join(minima, ["feature_id", "sample_id"])
    near = {j: F.col("minimum_distance_bp") <= d for j, d in enumerate(distances)}
    far = {i: outlier(F.col("value"), t, tail) for i, t in enumerate(thresholds)}
    return joined.groupBy("annotation_family", "annotation_class", "ac_class").agg(
        *[F.count_if(n).alias(f"c{j}") for j, n in near.items()],
        *[F.count_if(n & o).alias(f"x{i}_{j}") for i, o in far.items() for j, n in near.items()],
    )


def stratum_cells(totals: DataFrame, counts: DataFrame, thresholds, distances, tail: str,
                  ac: list[AcClass], annotations: list[tuple[str, str]]) -> DataFrame:
    """Complete grid: configured strata without any carrier also get their rows."""
    spark = totals.sparkSession
    grid = _dimension(
        _one_row(spark), "a",
        [F.struct(F.lit(i).alias("annotation_order"), F.lit(f).alias("annotation_family"),
                  F.lit(c).alias("annotation_class")) for i, (f, c) in enumerate(annotations)])
    grid = _dimension(
        grid, "k",
        [F.struct(F.lit(i).alias("ac_order"), F.lit(c.label).alias("ac_class"),
                  F.lit(c.kind).alias("ac_kind"), F.lit(c.value).cast("bigint").alias("ac_value"))
         for i, c in enumerate(ac)])
    grid = grid.select("a.*", "k.*")
    full = grid.join(counts, ["annotation_family", "annotation_class", "ac_class"], "left")
    entries = [
        F.struct(
            F.lit(i).alias("t"), F.lit(float(t)).alias("z_threshold"), F.lit(j).alias("d"),
            F.lit(d).cast("bigint").alias("distance_bp"),
            F.col(f"c{j}").alias("carriers"), F.col(f"x{i}_{j}").alias("hits"),
        )
        for i, t in enumerate(thresholds) for j, d in enumerate(distances)
    ]
    rows = full.withColumn("e", F.explode(F.array(*entries)))
    outliers = F.get(totals.select(
        F.array(*[F.col(f"o{i}") for i in range(len(thresholds))])).scalar(), F.col("e.t"))
    rows = rows.select("*", totals.select("total_observations").scalar()
                       .alias("total_observations"), outliers.alias("outliers"))

    def zero(c):
        return F.coalesce(F.col(c), F.lit(0)).cast("bigint")

    outliers = F.col("outliers")
    hits, n01 = zero("e.hits"), zero("e.carriers") - zero("e.hits")
    others = F.col("total_observations") - outliers
    return rows.select(
        F.col("e.t").alias("threshold_order"), "annotation_order", "ac_order",
        F.col("e.d").alias("distance_order"),
        F.col("e.z_threshold").alias("z_threshold"), F.lit(tail).alias("tail"),
        "annotation_family", "annotation_class", "ac_class", "ac_kind", "ac_value",
        F.col("e.distance_bp").alias("distance_bp"), "total_observations",
        outliers.alias("outlier_observations"), others.alias("nonoutlier_observations"),
        hits.alias("n11"), (outliers - hits).alias("n10"), n01.alias("n01"),
        (others - n01).alias("n00"),
    )


def stratum_statistics(cells: DataFrame) -> DataFrame:
    stats = table_statistics(
        F.col("n11"), F.col("outlier_observations"), F.col("n01"),
        F.col("nonoutlier_observations"))
    scored = cells.withColumns(stats).withColumn(
        "fisher_p_value", fisher_exact("n11", "n10", "n01", "n00"))
    orders = ["threshold_order", "annotation_order", "ac_order", "distance_order"]
    return benjamini_hochberg(scored, small=True).select(
        *orders, *vocab.ANNOTATION_RESULT_COLUMNS)
