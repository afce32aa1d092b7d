"""Shard merge, PC selection, sweep summary, drawings and the command line."""

import csv
import gzip
import json
import math

import pytest

from tailfold import cli, vocab
from tailfold.operators import plateau
from tailfold.plans import merge, selection
from tests.outputs import content

DEFINITIONS = list(vocab.CARRIER_DEFINITIONS)


def write_shard(folder, name, pc_counts, p_values, genes=("G1", "G2")):
    paths = {k: folder / f"{name}-{k}" for k in ("results", "summary", "genes", "qc")}
    rows = []
    for k in pc_counts:
        for definition in DEFINITIONS:
            p = p_values[len(rows)]
            rows.append([k, -2.0, definition, 2, 10, 1, 3, 0, 3, 1, 6, "0.0", "0.5", "NA", "NA",
                         "0.6", p, "0.9"])
    lines = [vocab.PC_RESULT_COLUMNS, *rows]
    paths["results"].write_text("".join("\t".join(map(str, r)) + "\n" for r in lines))
    paths["summary"].write_text(json.dumps({
        "available_pc_count": 10, "carrier_definitions": DEFINITIONS,
        "emitted_result_rows": len(rows), "fdr_scope": "shard", "negative_z_thresholds": [-2.0],
        "observation_unit": "u", "pc_grid_mode": "adaptive",
        "provenance": {
            "input_files": dict.fromkeys(
                ("lof_carriers", "phenotype_bed", "principal_components",
                 "protein_coding_genes"), "f"),
            "software_versions": {"numpy": "2", "python": "3"}},
        "residualization": {"design": "d", "outlier_rule": "o",
                            "residual_standard_deviation_ddof": 0},
        "selected_pc_counts": pc_counts, "statistical_limitation": "s"}))
    qc_rows = [vocab.GENE_QC_COLUMNS]
    for k in pc_counts:
        qc_rows += [(genes[0], k, 10, 1 + k, "0.0", "1.5", "included", ""),
                    (genes[1], k, 2, 1, "NA", "NA", "excluded", "insufficient_dof")]
    body = "".join("\t".join(map(str, r)) + "\n" for r in qc_rows)
    paths["genes"].write_bytes(gzip.compress(body.encode()))
    reasons = {r: int(r == "insufficient_dof") for r in vocab.EXCLUSION_REASONS}
    paths["qc"].write_text(json.dumps({
        "protein_coding_bed_gene_count": 2, "bed_sample_count": 10,
        "per_pc": {str(k): {"eligible_gene_count": 1, "total_observations": 10,
                            "carrier_observations": dict.fromkeys(DEFINITIONS, 3),
                            "exclusion_counts": reasons} for k in pc_counts}}))
    return paths


@pytest.fixture
def shards(tmp_path):
    return [write_shard(tmp_path, "b", [2], [0.01, 0.2, 0.3]),
            write_shard(tmp_path, "a", [0], [0.02, 0.6, 0.5])]


@pytest.fixture
def merged(spark, tmp_path, shards):
    def run():
        out = {k: tmp_path / f"merged-{k}" for k in ("results", "summary", "genes", "qc")}
        merge.run(spark, *[[s[k] for s in shards] for k in ("results", "summary", "genes", "qc")],
                  *[out[k] for k in ("results", "summary", "genes", "qc")])
        return out

    return run


def test_merge_adjusts_over_all_shards(merged):
    out = merged()
    rows = list(csv.DictReader(out["results"].open(), delimiter="\t"))
    assert [(r["pc_count"], r["carrier_definition"]) for r in rows] == [
        (k, d) for k in ("0", "2") for d in DEFINITIONS]
    assert [r["fisher_fdr_bh"] for r in rows] == [
        "0.06", "0.6", "0.6", "0.06", "0.4000000000000001", "0.44999999999999996"]
    assert {r["odds_ratio"] for r in rows} == {"NA"}
    summary = json.loads(out["summary"].read_text())
    assert summary["selected_pc_counts"] == [0, 2] and summary["emitted_result_rows"] == 6
    assert summary["fdr_scope"] == "global_across_all_emitted_rows"
    assert list(json.loads(out["qc"].read_text())["per_pc"]) == ["0", "2"]
    genes = content(out["genes"]).splitlines()
    assert len(genes) == 5 and genes[1] == "G1\t2\t10\t3\t0.0\t1.5\tincluded\t"


def edit_json(path, **changes):
    path.write_text(json.dumps({**json.loads(path.read_text()), **changes}))


def edit_genes(path, old, new):
    body = gzip.decompress(path.read_bytes()).decode()
    assert old in body
    path.write_bytes(gzip.compress(body.replace(old, new, 1).encode()))


@pytest.mark.parametrize("change,message", [
    (lambda s: edit_json(s["summary"], pc_grid_mode="explicit"), "incompatible pc_grid_mode"),
    (lambda s: edit_json(s["summary"], selected_pc_counts=[2]), "duplicate PC count"),
    (lambda s: edit_json(s["summary"], selected_pc_counts=[10]), "minus one"),
    (lambda s: edit_json(s["summary"], emitted_result_rows=4), "row count"),
    (lambda s: edit_json(s["summary"], available_pc_count=True), "available_pc_count"),
    (lambda s: edit_json(s["qc"], bed_sample_count=11), "top-level metadata"),
    (lambda s: edit_json(s["qc"], per_pc={}), "per_pc keys"),
    (lambda s: s["results"].write_text(s["results"].read_text().replace("0.02", "1.02")),
     "fisher_p_value"),
    (lambda s: s["results"].write_text(s["results"].read_text().replace("0\t-2.0", "00\t-2.0", 1)),
     "line 2 .*pc_count"),
    (lambda s: s["results"].write_text(s["results"].read_text().replace("\tHC\t", "\tany_lof\t")),
     "duplicate result combinations"),
    (lambda s: s["results"].write_text(s["results"].read_text().replace("n11", "n1")), "schema"),
    (lambda s: edit_genes(s["genes"], "\t10\t", "\t9\t"), "total_observations"),
    (lambda s: edit_genes(s["genes"], "insufficient_dof", "other"), "exclusion counts"),
    (lambda s: edit_genes(s["genes"], "included\t", "included\tother"), "exclusion reason"),
    (lambda s: edit_genes(s["genes"], "G2\t0", "G1\t0"), "duplicate gene-PC"),
])
def test_merge_rejects_inconsistent_shards(merged, shards, change, message):
    change(shards[1])
    with pytest.raises(ValueError, match=message):
        merged()


# ------------------------------------------------------------------ selection

LEVELS = {0: 1.0, 10: 1.9, 20: 2.0}


def results_text(drop=None, na_total=None):
    lines = ["pc_count\tz_threshold\tcarrier_definition\todds_ratio\ttotal_observations"]
    for k, level in LEVELS.items():
        for definition in ("HC", "any_lof"):
            for t in (-2.0, -3.0, -4.0, -5.0, -6.0):
                value = level * (1 if t == -2.0 else 4)
                if drop == (k, definition, t):
                    value = "NA"
                lines.append(f"{k}\t{t}\t{definition}\t{value}\t{na_total if value == 'NA' else 9}")
    return "\n".join(lines) + "\n"


@pytest.fixture
def results(tmp_path):
    path = tmp_path / "results.tsv"
    path.write_text(results_text())
    return path


def test_selection_finds_the_plateau_and_draws_it(spark, results, tmp_path):
    out, plot = tmp_path / "selection.json", tmp_path / "plot.svg"
    selection.analyze(spark, results, out, plot)
    document = json.loads(out.read_text())
    chosen = document["selection"]
    assert chosen["selected_pc_count"] == 10
    assert chosen["minimum_pc_count_within_plateau_by_definition"] == {"HC": 10, "any_lof": 10}
    assert chosen["max_median_log_odds_ratio_by_definition"]["HC"] == pytest.approx(math.log(8))
    assert chosen["excluded_z_thresholds"] == [-2.0]
    assert chosen["included_z_thresholds"] == [-3.0, -4.0, -5.0, -6.0]
    assert [(m["pc_count"], m["carrier_definition"]) for m in document["median_log_or"]][:2] == [
        (0, "HC"), (0, "any_lof")]
    assert document["median_log_or"][0]["included_z_thresholds"] == [-6.0, -5.0, -4.0, -3.0]
    svg = plot.read_text()
    for part in ('data-selection-pc="10"', 'data-median-log-or="HC"',
                 'data-median-log-or="any_lof"', 'data-z-threshold="-3"', "Any LoF / HC_or_LC"):
        assert part in svg


def test_undefined_odds_ratios(spark, results, tmp_path):
    out, plot = tmp_path / "selection.json", tmp_path / "plot.svg"
    results.write_text(results_text(drop=(20, "HC", -4.0), na_total=5))
    with pytest.raises(ValueError, match="selection fields"):
        selection.analyze(spark, results, out, plot)
    results.write_text(results_text(drop=(20, "HC", -4.0), na_total=0))
    selection.analyze(spark, results, out, plot)
    document = json.loads(out.read_text())
    assert (20, "HC") not in [(m["pc_count"], m["carrier_definition"])
                              for m in document["median_log_or"]]


def test_median_uses_all_thresholds(spark):
    rows = spark.createDataFrame(
        [(0, t, "HC", o) for t, o in ((-3.0, 1.0), (-4.0, 2.0), (-5.0, 8.0), (-6.0, 64.0))]
        + [(1, -3.0, "HC", 5.0), (2, -3.0, "HC", 0.0)],
        "pc_count int, z_threshold double, carrier_definition string, odds_ratio double")
    points = plateau.median_log_odds(rows).collect()
    assert [(p.pc_count, p.carrier_definition) for p in points] == [(0, "HC")]
    assert points[0].median_log_odds_ratio == pytest.approx(math.log(4))
    with pytest.raises(ValueError, match="any_lof"):
        selection.select_pc_count(rows)
    with pytest.raises(ValueError, match="plateau_fraction"):
        selection.select_pc_count(rows, fraction=0.0)


def test_sweep_table_and_drawing(spark, results, tmp_path):
    table, plot = tmp_path / "sweep.tsv", tmp_path / "sweep.svg"
    selection.write_sweep(spark, results, table, plot)
    rows = list(csv.DictReader(table.open(), delimiter="\t"))
    assert list(rows[0]) == list(vocab.SWEEP_COLUMNS)
    assert [(r["carrier_definition"], r["pc_count"]) for r in rows] == [
        (d, str(k)) for d in ("HC", "any_lof") for k in LEVELS]
    assert {r["maximum_pc"] for r in rows} == {"20"}
    assert rows[0]["thresholds_present"] == "-3,-4,-5,-6"
    assert float(rows[0]["percent_of_maximum"]) == pytest.approx(50.0)
    assert 'data-maximum-pc="20"' in plot.read_text()
    results.write_text(results_text(drop=(20, "HC", -4.0), na_total=0))
    with pytest.raises(ValueError, match="HC:PC20"):
        selection.write_sweep(spark, results, table, plot)


def test_command_line(spark, tmp_path, results):
    pcs, out = tmp_path / "pcs.tsv", tmp_path / "chunks.json"
    pcs.write_text("ID\tPC1\tPC2\tPC3\tPC4\nbad row")
    assert cli.main(["pc-chunks", "--principal-components", str(pcs), "--pc-counts", "",
                     "--pc-counts-per-job", "3", "--output", str(out)], spark) == 0
    assert json.loads(out.read_text()) == [[0, 1, 2], [3]]
    cli.main(["analyze-lof-pc-enrichment", "--results-input", str(results), "--selection-output",
              str(out), "--plot-output", str(tmp_path / "p.svg"), "--plateau-fraction", "0.5",
              "--selection-z-thresholds=-3,-4"], spark)
    assert json.loads(out.read_text())["selection"]["included_z_thresholds"] == [-3.0, -4.0]
    parser = cli.build_parser()
    for bad in (["calculate"], ["pc-chunks", "--pc-counts", "1,,2"], ["unknown"]):
        with pytest.raises(SystemExit):
            parser.parse_args(bad)
    assert len(cli.COMMANDS) == 14
