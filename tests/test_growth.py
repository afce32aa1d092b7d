"""Steps whose cost must follow what a table holds, on rows made here."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tailfold.functions import values as V
from tailfold.operators import fdr, ranges, residuals
from tailfold.operators.collapse import FLAGS
from tailfold.operators.samples import block_samples
from tailfold.plans import file_queries
from tailfold.sources import regions, text
from tests.test_residuals import brute_force


def test_bed_lines_list_every_column(spark, tmp_path):
    for name, ids in (("supplier", [7, 0, 12, 3, 5]),):
        spark.createDataFrame([(i,) for i in ids], "s_suppkey long").write.parquet(str(tmp_path / f"{name}.parquet"))
    meta = spark.createDataFrame([("a", "c1", 9), ("b", "c1", 4), ("c", "c0", 30)], "feature_id string, chrom string, end long")
    cells = [("a", "3", 1.5), ("a", "12", -2.0), ("a", "99", 4.0), ("a", "5", None), ("b", "0", 1e-5), ("b", "7", 0.1)]
    cells = spark.createDataFrame(cells, "feature_id string, sample_id string, value double")
    path = file_queries._bed_file(spark, str(tmp_path), meta, cells, "feature_id")
    assert [r.line.split("\t") for r in text.read_lines(spark, path).orderBy("ord").collect()] == [
        ["#chr", "start", "end", "feature_id", "0", "3", "5", "7", "12"],
        ["c0", "29", "30", "c", "NA", "NA", "NA", "NA", "NA"],
        ["c1", "3", "4", "b", "1.0E-5", "NA", "NA", "0.1", "NA"],
        ["c1", "8", "9", "a", "NA", "1.5", "NA", "NA", "-2.0"]]
    twice = cells.unionByName(cells.where("value = 1.5"))
    with pytest.raises(Exception, match="two cells of one sample"):
        file_queries._bed_file(spark, str(tmp_path), meta, twice, "feature_id")


def test_bed_lines_take_time_by_their_length(spark):
    plan = spark.range(1).select(F.expr("array(named_struct('at', 1, 'value', 2.0D))").alias("c")).select(
        F.concat_ws("\t", *file_queries._shown("c", 100_000)).alias("line"))
    assert len(plan._jdf.queryExecution().analyzed().toString()) < 20_000
    assert plan.first().line == "\t".join(["NA", "2.0"] + ["NA"] * 99_998)


def test_missing_numbers(spark):
    words = ["NA", "na", "NaN", "N1", "n", "1", "-2.5e3", "", " NA", None, "Infinity", "1f", "0x1"]
    rows = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, w string").select(
        "i", V.to_double(F.col("w")).alias("v"), V.is_bad_phenotype(F.col("w")).alias("bad")).orderBy("i").collect()
    assert [r.v for r in rows] == [None] * 5 + [1.0, -2500.0] + [None] * 6
    assert [r.bad for r in rows] == [False, False, False, True, True, False, False, False, False, None, True, True, True]


def test_sparse_sweep_sends_no_more_design_rows_than_cells(spark):
    rng = np.random.default_rng(5)
    samples, genes, per_gene = 900, 80, 12
    x = rng.normal(size=(samples, 2))
    cells, y = [], np.full((samples, genes), np.nan)
    for g in range(genes):
        for s in rng.choice(samples, per_gene, replace=False):
            y[s, g] = np.nan if g % 7 == 0 and s % 3 == 0 else float(rng.integers(0, 4))
            cells.append((f"G{g:02d}", f"S{int(s):03d}", None if np.isnan(y[s, g]) else float(y[s, g]), *[bool(s % 2)] * 3))
    flagged = spark.createDataFrame(
        cells, "gene_id string, sample_id string, value double, " + ", ".join(f"{f} boolean" for f in FLAGS))
    design = spark.createDataFrame(
        [(f"S{i:03d}", [float(v) for v in row]) for i, row in enumerate(x)], "sample_id string, x array<double>")
    sweep = residuals.plan_sweep(flagged, design, 0, (0, 1, 2), sample_block=50)
    assert (sweep.sample_blocks, sweep.runs, sweep.sparse) == (1, 18, True)
    blocks = block_samples(design, sweep.sample_blocks, sweep.runs)
    assert blocks.select("sb", "pos").distinct().count() == samples
    tiles = residuals._tiles(flagged, blocks, sweep, False)
    assert residuals._design_rows(tiles, blocks, sweep).count() <= len(cells)
    got = {(r.gene_id, r.pc_count): r for r in residuals.gene_sweep(
        flagged, design, 0, (0, 1, 2), [-0.5], sweep).collect()}
    assert len(got) == 3 * genes
    for g in range(genes):
        for k in (0, 1, 2):
            reason, rank, sd, z = brute_force(y[:, g], x, 0, k)
            row = got[f"G{g:02d}", k]
            assert (row.reason, row["rank"]) == (reason, rank)
            if z is not None:
                low = np.isfinite(z) & (z <= -0.5)
                assert row.residual_sd == pytest.approx(sd, rel=1e-9) and row.o0 == low.sum()
                assert row.x0_0 == (low & (np.arange(samples) % 2 == 1)).sum()


def test_results_of_light_values_are_not_repeated(spark, monkeypatch):
    monkeypatch.setattr(fdr, "BROADCAST_VALUES", 10)
    monkeypatch.setattr(fdr, "ROWS_PER_BUCKET", 20)
    monkeypatch.setattr(fdr, "HEAVY_ROWS", 50)
    made = []
    dealt = fdr._dealt
    monkeypatch.setattr(fdr, "_dealt", lambda *a: made.append(dealt(*a)) or made[-1])
    ps = [None] * 40 + [1.0] * 300 + [i / 100 for i in range(1, 100)] * 2
    frame = spark.createDataFrame(list(enumerate(ps)), "i int, p double")
    got = {r.i: r.q for r in fdr.benjamini_hochberg(frame, p="p", out="q").collect()}
    (rows, results), = made
    assert results.count() == 99 + fdr.SALTS
    assert rows.groupBy("p").agg(F.count_distinct("_salt").alias("n")).where("p < 1").agg(F.max("n")).first()[0] == 1
    known = sorted(p for p in ps if p is not None)
    want, low = {}, 1.0
    for rank in range(len(known), 0, -1):
        low = min(low, known[rank - 1] * len(known) / rank)
        want[known[rank - 1]] = low
    assert len(got) == len(ps)
    assert all(got[i] is None if p is None else got[i] == pytest.approx(want[p]) for i, p in enumerate(ps))


def test_layout_of_many_stretches_has_few_folders(spark, tmp_path):
    rows = [(c, p, p + (40_000 if p % 500 == 0 else 3), i) for c in ("a", "b") for i, p in enumerate(range(1, 60_000, 7))]
    frame = spark.createDataFrame(rows, "chrom string, pos long, end_pos long, id int").coalesce(1)
    regions.write_layout(frame, str(tmp_path / "l"), {"samples": []}, 10)
    assert len(list((tmp_path / "l" / "records").glob("chrom=*/span=*"))) <= regions.FOLDERS + 4
    layout = regions.read_layout(spark, str(tmp_path / "l"))
    assert layout.manifest.count() > 10 * regions.FOLDERS
    windows = [("a", 100, 130), ("a", 41_000, 41_040), ("b", 59_000, 59_005)]
    got = layout.near(spark.createDataFrame(windows, "chrom string, start long, end long"))
    found = {(r.chrom, r.id) for r in got.collect()}
    reaching = {(c, i) for c, p, e, i in rows for w, a, b in windows if w == c and p <= b and e >= a}
    assert reaching <= found and len(found) < len(rows) / 2


def test_large_index_is_met_once(spark, monkeypatch):
    monkeypatch.setattr(ranges, "BROADCAST_ROWS", 0)
    variants = spark.createDataFrame([("c", 5 * i) for i in range(50)], "chrom string, pos long")
    features = spark.createDataFrame([("c", 40 * i) for i in range(6)], "chrom string, tss long")
    pairs = ranges.range_join(variants, features, 10)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Generate") == 1
    want = {(5 * i, 40 * j) for i in range(50) for j in range(6) if abs(5 * i - 40 * j) <= 10}
    assert {(r.pos, r.tss) for r in pairs.collect()} == want and pairs.count() == len(want)
