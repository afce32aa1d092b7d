"""Command line: one sub-command per step, run with ``spark-submit`` or Python."""

from __future__ import annotations

import argparse
import logging
import math

from tailfold import files, vocab
from tailfold.plans import lof_pc, merge, rare_variant, selection
from tailfold.session import build_session
from tailfold.sources import regions


# ----------------------------------------------------------- value parsers


def strings(value: str) -> list[str]:
    items = [item.strip() for item in value.split(",")]
    if not all(items):
        raise argparse.ArgumentTypeError("expected a non-empty comma-separated list")
    return items


def consequences(value: str) -> list[str]:
    return strings(value) if value else []


def integers(value: str) -> list[int]:
    try:
        return [int(item) for item in strings(value)] if value else []
    except ValueError:
        raise argparse.ArgumentTypeError("expected comma-separated integers") from None


def numbers(value: str) -> list[float]:
    try:
        out = [float(item) for item in strings(value)]
    except ValueError:
        raise argparse.ArgumentTypeError("expected comma-separated numbers") from None
    if not all(map(math.isfinite, out)):
        raise argparse.ArgumentTypeError("expected finite comma-separated numbers")
    return out


def boolean(value: str) -> bool:
    if value not in ("true", "false"):
        raise argparse.ArgumentTypeError("expected true or false")
    return value == "true"


# ------------------------------------------------------------ sub-commands


def _prepare_vat(spark, vat, chromosomes, schema_output, loftee_enabled_output):
    schema = rare_variant.prepare_vat(spark, vat, chromosomes, schema_output)
    files.write_text(loftee_enabled_output, f"{str(schema.loftee_enabled).lower()}\n")


MANY = {"action": "append", "required": True}
FILE = {"required": True}
INTS, FLOATS = {"required": True, "type": integers}, {"required": True, "type": numbers}
NAMES = {"required": True, "type": strings}
TAIL = {"required": True, "choices": vocab.TAILS}
SPAN = {"type": int, "default": regions.SPAN_BP}
STATE = {"choices": rare_variant.PROVENANCE_STATES, "default": "unknown"}
SELECTION = {"type": numbers, "default": list(vocab.SELECTION_THRESHOLDS)}


def inputs(*names: str) -> dict:
    return dict.fromkeys(names, FILE)


# flag name -> argparse options; ``calls`` maps flags to the plan's parameters
COMMANDS = {
    "prepare-protein-coding-genes": (
        lof_pc.prepare_coding_genes,
        {"gtf": FILE, "genes-output": FILE, "qc-output": FILE}, {"gtf": "gtf_path"}),
    "pc-chunks": (
        lof_pc.write_pc_chunks,
        {"principal-components": FILE, "pc-counts": INTS,
         "pc-counts-per-job": {"required": True, "type": int}, "output": FILE},
        {"pc_counts_per_job": "per_job"}),
    "lof-pc-enrichment": (
        lof_pc.run,
        {**inputs("phenotype-bed", "lof-carriers", "principal-components"),
         "additional-covariates": {}, "protein-coding-genes": FILE,
         "negative-z-thresholds": FLOATS, "pc-counts": INTS,
         **inputs("results-output", "summary-output", "gene-pc-qc-output",
                 "analysis-qc-output"),
         "pc-grid-mode": {"choices": ("adaptive", "explicit")},
         "pc-counts-per-job": {"type": int}, "work-folder": {}}, {}),
    "merge-lof-pc-enrichment": (
        merge.run,
        {"results-input": MANY, "summary-input": MANY, "gene-pc-qc-input": MANY,
         "analysis-qc-input": MANY,
         **inputs("results-output", "summary-output", "gene-pc-qc-output",
                 "analysis-qc-output")},
        {f"{n}_input": f"{n}_inputs" for n in ("results", "summary", "gene_pc_qc", "analysis_qc")}),
    "analyze-lof-pc-enrichment": (
        selection.analyze,
        {**inputs("results-input", "selection-output", "plot-output"),
         "selection-z-thresholds": SELECTION,
         "plateau-fraction": {"type": float, "default": vocab.PLATEAU_FRACTION}}, {}),
    "pc-sweep-summary": (
        selection.write_sweep,
        {**inputs("results-input", "summary-output", "plot-output"),
         "selection-z-thresholds": SELECTION}, {}),
    "prepare-phenotypes": (
        rare_variant.prepare_phenotypes,
        {**inputs("phenotype-bed", "vcf-samples"), "chromosomes": NAMES, "z-thresholds": FLOATS,
         "tail": TAIL, **inputs("feature-output", "sample-output", "qc-output")}, {}),
    "prepare-vat": (
        _prepare_vat,
        {"vat": FILE, "chromosomes": NAMES, **inputs("schema-output", "loftee-enabled-output")},
        {}),
    "classify-chromosome": (
        rare_variant.classify_chromosome,
        {**inputs("vcf", "vat", "vat-schema", "features", "shared-samples"),
         "chromosome": {"required": True}, "exact-ac": INTS, "cumulative-ac-max": INTS,
         "consequence-classes": {"required": True, "type": consequences},
         "maximum-gvs-maf": {"required": True, "type": float},
         "max-distance": {"required": True, "type": int},
         "annotation-chunk-size-bp": {"required": True, "type": int},
         **inputs("carrier-output", "regions-output", "qc-output")}, {}),
    "classify-chromosomes": (
        rare_variant.classify_chromosomes,
        {**inputs("vcf", "vat", "vat-schema", "features", "shared-samples"),
         "chromosomes": NAMES, "exact-ac": INTS, "cumulative-ac-max": INTS,
         "consequence-classes": {"required": True, "type": consequences},
         "maximum-gvs-maf": {"required": True, "type": float},
         "max-distance": {"required": True, "type": int},
         "annotation-chunk-size-bp": {"required": True, "type": int},
         **inputs("output-folder")}, {}),
    "index-vcf": (
        regions.index_vcf, {**inputs("vcf", "output"), "span-bp": SPAN}, {}),
    "index-vat": (
        regions.index_vat, {**inputs("vat", "output"), "span-bp": SPAN}, {}),
    "gather": (
        rare_variant.gather,
        {"carrier-input": MANY, "qc-input": MANY, **inputs("carrier-output", "qc-output")},
        {"carrier_input": "carrier_inputs", "qc_input": "qc_inputs"}),
    "calculate": (
        rare_variant.calculate,
        {**inputs("phenotype-bed", "shared-samples", "carriers", "features"),
         "exact-ac": INTS, "cumulative-ac-max": INTS, "z-thresholds": FLOATS,
         "distance-thresholds": INTS, "tail": TAIL, **inputs("output-tsv", "output-json"),
         "phenotype-qc": {}, "chromosome-qc": {},
         "vat-schema": {}, "selected-chromosomes": {"type": strings},
         "container-image": {}, "workflow-version": {"default": "unknown"},
         "max-retries": {"type": int, "default": 0}, "index-provenance": STATE,
         "consequence-classes": {"type": consequences, "default": []},
         "loftee-enabled": {"type": boolean, "default": False},
         "vat-index-provenance": STATE,
         "maximum-gvs-maf": {"type": float, "default": 0.01},
         "annotation-chunk-size-bp": {"type": int, "default": 10_000_000}}, {}),
}


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tailfold")
    commands = parser.add_subparsers(dest="command", required=True)
    for name, (_, flags, _) in COMMANDS.items():
        sub = commands.add_parser(name)
        for flag, options in flags.items():
            sub.add_argument(f"--{flag}", **options)
    return parser


def main(argv=None, spark=None) -> int:
    logging.basicConfig(level=logging.INFO,
                        format="%(asctime)s %(levelname)s %(name)s: %(message)s")
    arguments = vars(build_parser().parse_args(argv))
    plan, _, renamed = COMMANDS[arguments.pop("command")]
    parameters = {renamed.get(k, k): v for k, v in arguments.items()}
    plan(spark or build_session(), **parameters)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
