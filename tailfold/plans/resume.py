"""A work folder from which a broken sweep goes on.

``manifest.json`` names the analysis (inputs with their sizes and times, models, thresholds) and what is
complete.  Tables are written in full before the manifest says so; what a broken run has left half
written is written again: staged tables under a new name, gene rows by overwriting the partitions of
their PC counts.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tailfold import files


class WorkFolder:
    def __init__(self, spark: SparkSession, path, analysis: dict):
        self.spark, self.path = spark, str(path)
        self._manifest = files.join(path, "manifest.json")
        # through JSON, so that it compares with what was read
        analysis = json.loads(json.dumps(analysis))
        if files.exists(self._manifest):
            self.state = json.loads(files.read_text(self._manifest))
            if self.state["analysis"] != analysis:
                raise ValueError(f"the work folder belongs to another analysis: {path}")
        else:
            self.state = {"analysis": analysis, "tables": {}, "pc_counts": []}
            self._save()

    def _save(self) -> None:
        files.write_text(self._manifest, json.dumps(self.state, indent=2, sort_keys=True) + "\n")

    def table(self, name: str, make) -> DataFrame:
        """The table of that name, made unless an earlier run has finished it."""
        if name not in self.state["tables"]:
            place = f"{name}-{uuid.uuid4().hex}"
            made = make()
            made.write.parquet(files.join(self.path, place))
            self.state["tables"][name] = {"place": place, "schema": made.schema.json()}
            self._save()
        entry = self.state["tables"][name]
        return self.spark.read.schema(_schema(entry["schema"])).parquet(files.join(self.path, entry["place"]))

    def missing(self, pc_counts: list[int]) -> list[int]:
        return [k for k in pc_counts if k not in self.state["pc_counts"]]

    def add(self, rows: DataFrame, pc_counts: list[int]) -> None:
        """Write the gene rows of some PC counts, in place of any that were begun."""
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("pc_count").parquet(files.join(self.path, "genes")))
        self.state["pc_counts"] = sorted({*self.state["pc_counts"], *pc_counts})
        self.state["gene_schema"] = rows.schema.json()
        self._save()

    def rows(self, pc_counts: list[int]) -> DataFrame:
        """Finished gene rows of these PC counts; other partitions are not opened."""
        schema = _schema(self.state["gene_schema"])
        found = self.spark.read.schema(schema).parquet(files.join(self.path, "genes"))
        return found.where(F.col("pc_count").isin(*pc_counts)).select(*schema.names)


def _schema(document: str):
    from pyspark.sql.types import StructType
    return StructType.fromJson(json.loads(document))
