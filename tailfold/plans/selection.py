"""PC-count selection and sweep summary from an enrichment result table."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tailfold import config, plots, sinks, vocab
from tailfold.operators import plateau
from tailfold.session import stage
from tailfold.sources import tables

LOG = logging.getLogger(__name__)


def select_pc_count(results: DataFrame, thresholds=vocab.SELECTION_THRESHOLDS,
                    fraction: float = vocab.PLATEAU_FRACTION,
                    definitions=vocab.SELECTION_DEFINITIONS) -> tuple[dict, list[dict]]:
    """(selection document, median points); both are as small as the sweep grid."""
    config.plateau_fraction(fraction)
    config.negative_thresholds(thresholds)
    if not definitions or len(set(definitions)) < len(definitions):
        raise ValueError("carrier_definitions must be non-empty and unique")
    points = plateau.median_log_odds(results, thresholds, definitions)
    entries = {r.carrier_definition: r for r in plateau.plateau_entry(points, fraction).collect()}
    absent = [d for d in definitions if d not in entries]
    if absent:
        raise ValueError("no median logOR points for carrier definition(s): " + ", ".join(absent))

    def by_definition(column):
        return {d: entries[d][column] for d in definitions}

    first = by_definition("minimum_pc_count")
    selection = {
        "carrier_definitions": list(definitions),
        "plateau_fraction": fraction,
        "max_median_log_odds_ratio_by_definition": by_definition("max_median_log_odds_ratio"),
        "plateau_log_odds_ratio_threshold_by_definition": by_definition("plateau_log_odds_ratio"),
        "minimum_pc_count_within_plateau_by_definition": first,
        "selected_pc_count": max(first.values()),
    }
    included = sorted(map(float, thresholds))
    place = {d: i for i, d in enumerate(definitions)}
    found = sorted(points.collect(), key=lambda r: (r.pc_count, place[r.carrier_definition]))
    medians = [
        {"pc_count": r.pc_count, "carrier_definition": r.carrier_definition,
         "included_z_thresholds": included, "median_log_odds_ratio": r.median_log_odds_ratio,
         "median_odds_ratio": r.median_odds_ratio}
        for r in found
    ]
    return selection, medians


def analyze(spark: SparkSession, results_input, selection_output, plot_output, *,
            selection_z_thresholds=vocab.SELECTION_THRESHOLDS,
            plateau_fraction: float = vocab.PLATEAU_FRACTION) -> None:
    thresholds = config.negative_thresholds(selection_z_thresholds)
    rows = stage(tables.read_selection_rows(spark, results_input), "result-rows")
    skipped = tables.check_selection_rows(rows, thresholds, vocab.SELECTION_DEFINITIONS)
    if skipped:
        LOG.warning("Skipped %d enrichment rows with no observations and no estimable odds ratio",
                    skipped)
    selection, medians = select_pc_count(rows, thresholds, plateau_fraction)
    observed = sorted(r.z_threshold for r in rows.select("z_threshold").distinct().collect())
    selection["included_z_thresholds"] = thresholds
    selection["excluded_z_thresholds"] = [t for t in observed if t not in thresholds]
    sinks.write_json(selection_output, {"selection": selection, "median_log_or": medians})
    plots.write_selection_svg(plot_output, _curves(rows), observed, medians, selection)


def _curves(rows: DataFrame) -> list:
    """Points of the threshold curves, in line order; bounded by the sweep grid."""
    shown = rows.where(
        F.col("carrier_definition").isin(*vocab.SELECTION_DEFINITIONS) & (F.col("odds_ratio") > 0))
    return shown.orderBy("carrier_definition", "z_threshold", "pc_count").collect()


def sweep_summary(results: DataFrame, thresholds=vocab.SELECTION_THRESHOLDS) -> DataFrame:
    """Strict sweep table: an incomplete PC count or definition is an error."""
    groups = plateau.sweep_groups(results, thresholds)
    short = groups.where(F.col("n_thresholds") != len(set(thresholds))).orderBy(
        "carrier_definition", "pc_count").collect()
    if short:
        names = ", ".join(f"{r.carrier_definition}:PC{r.pc_count}" for r in short)
        raise ValueError(f"not all requested thresholds are present for {names}")
    if groups.first() is None:
        raise ValueError("no finite odds-ratio rows match the thresholds and definitions")
    return plateau.percent_of_maximum(groups)


def write_sweep(spark: SparkSession, results_input, summary_output, plot_output, *,
                selection_z_thresholds=vocab.SELECTION_THRESHOLDS) -> None:
    thresholds = config.negative_thresholds(selection_z_thresholds)
    rows = tables.read_selection_rows(spark, results_input)
    place = F.array_position(
        F.array(*[F.lit(d) for d in vocab.SELECTION_DEFINITIONS]), F.col("carrier_definition"))
    table = sweep_summary(rows, thresholds).withColumn("_place", place)
    written = sinks.write_grid(summary_output, table, vocab.SWEEP_COLUMNS, ["_place", "pc_count"])
    plots.write_sweep_svg(plot_output, written)
