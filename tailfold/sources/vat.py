"""Transcript annotation tables whose columns are found by header name."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tailfold import vocab
from tailfold.functions import values as V
from tailfold.sources import text

# fixed values: manifest keys of the required columns, in manifest order
MANIFEST_KEYS = {
    "chrom": "chromosome", "pos": "position", "ref": "ref", "alt": "alt",
    "gene_id": "gene_id", "consequence": "consequence", "gvs_max_af": "gvs_max_af",
}


@dataclass(frozen=True)
class VatSchema:
    """Header of an annotation table and where its needed columns are."""

    header: tuple[str, ...]

    def __post_init__(self):
        for kind, test in (("missing", 0), ("duplicate", 2)):
            names = [c for c in vocab.VAT_REQUIRED_COLUMNS
                     if min(self.header.count(c), 2) == test]
            if names:
                raise ValueError(f"{kind} required VAT columns: " + ", ".join(names))
        if self.header.count(vocab.VAT_LOFTEE_COLUMN) > 1:
            raise ValueError(f"duplicate optional VAT column: {vocab.VAT_LOFTEE_COLUMN}")

    @property
    def loftee_enabled(self) -> bool:
        return vocab.VAT_LOFTEE_COLUMN in self.header

    def columns(self) -> dict[str, int]:
        names = list(vocab.VAT_REQUIRED_COLUMNS)
        names += [vocab.VAT_LOFTEE_COLUMN] if self.loftee_enabled else []
        return {n: self.header.index(n) for n in names}

    def manifest(self) -> dict:
        at = self.columns()
        out = {key: at[column] for column, key in MANIFEST_KEYS.items()}
        return {"header": list(self.header), **out, "lof": at.get(vocab.VAT_LOFTEE_COLUMN),
                "lof_enabled": self.loftee_enabled}

    def to_json(self) -> str:
        return json.dumps(self.manifest(), sort_keys=True) + "\n"

    @staticmethod
    def from_json(document: str) -> VatSchema:
        try:
            payload = json.loads(document, object_pairs_hook=unique_object)
        except json.JSONDecodeError:
            raise ValueError("VAT schema JSON is invalid") from None
        if not isinstance(payload, dict):
            raise ValueError("VAT schema JSON must contain an object")
        expected = {"header", "lof", "lof_enabled", *MANIFEST_KEYS.values()}
        absent = sorted(expected - payload.keys())
        if absent:
            raise ValueError("VAT schema JSON is missing fields: " + ", ".join(absent))
        header = payload["header"]
        if not isinstance(header, list) or not all(isinstance(h, str) for h in header):
            raise ValueError("VAT schema JSON contains invalid schema values")
        schema = VatSchema(tuple(header))
        if any(payload[k] != v for k, v in schema.manifest().items()):
            raise ValueError("VAT schema JSON indices do not match its header")
        return schema


def unique_object(pairs) -> dict:
    """``object_pairs_hook`` that refuses repeated JSON keys."""
    out = dict(pairs)
    if len(out) < len(pairs):
        keys = [k for k, _ in pairs]
        raise ValueError(f"JSON contains duplicate key: {max(keys, key=keys.count)}")
    return out


def read_vat(spark: SparkSession, path, schema: VatSchema | None = None):
    """``(schema, rows)``: text columns by name plus ``ord``, ``line`` and field count.

    Without ``schema`` the header of the file is used.  Rows starting with ``#`` and
    header lines are not data.
    """
    lines = text.read_lines(spark, path)
    if schema is None:
        schema = VatSchema(tuple(text.first_line(spark, path, "VAT TSV").split("\t")))
    body = lines.where(
        (F.col("line") != "") & ~F.col("line").startswith("#")
        & (F.col("line") != "\t".join(schema.header)))
    fields = body.select("ord", "line", F.split("line", "\t").alias("f"))
    cells = [F.get("f", F.lit(i)).alias(n) for n, i in schema.columns().items()]
    rows = fields.select("ord", "line", F.size("f").alias("n_fields"), *cells)
    return schema, rows.withColumnRenamed("pos", "pos_text").withColumn(
        "pos", V.to_long(F.col("pos_text")))


def digested(rows: DataFrame) -> DataFrame:
    """The line as a digest, which is all that comparing whole rows needs."""
    return rows.withColumn("digest", F.unhex(F.sha2("line", 256))).drop("line")


def row_problem(schema: VatSchema):
    def blank(name):
        return (F.col(name) == "") | (F.col(name) == ".")

    return F.coalesce(
        F.when(F.col("n_fields") <= max(schema.columns().values()),
               "fewer fields than its header"),
        F.when(blank("chrom"), "a missing chromosome"),
        F.when(blank("ref"), "a missing reference allele"),
        F.when(blank("alt"), "a missing alternate allele"),
        F.when(F.col("pos").isNull() | (F.col("pos") < 1), "an invalid position"),
    )


def require_chromosomes(rows: DataFrame, chromosomes) -> None:
    present = rows.where(F.col("chrom").isin(*chromosomes)).select("chrom").distinct()
    found = {r.chrom for r in present.collect()}
    absent = [c for c in chromosomes if c not in found]
    if absent:
        raise ValueError("requested chromosomes are absent from the VAT: " + ", ".join(absent))
