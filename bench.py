"""Time the headline queries once each after a warm-up; print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose the data
and the number of local cores.
"""

from __future__ import annotations

import json
import os
import time

from tailfold.plans.queries import QUERIES
from tailfold.session import build_session

HEADLINE = (
    "lof_pc_enrichment", "lof_pc_intercept_only", "residual_exclusions", "gene_min_collapse",
    "phenotype_bed_long", "carrier_definitions", "bh_fdr", "fisher_two_sided",
    "variant_feature_range_join", "variants_in_query_windows", "query_chunks",
    "vcf_alt_alleles", "transcript_collapse", "frequency_consistency",
    "carrier_minimum_distance", "annotation_enrichment",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "tailfold-bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g",
           "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("carrier_definitions")
    run("residual_exclusions")
    seconds = {}
    for name in HEADLINE:
        seconds[name] = round(run(name), 3)
        spark.catalog.clearCache()
    print(json.dumps({
        "metric": "total seconds of the headline queries",
        "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
