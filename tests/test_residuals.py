"""Blocked QR sweep against per-gene least squares on small random matrices."""

import math

import numpy as np
import pytest

from tailfold.operators import residuals
from tailfold.operators.collapse import FLAGS

EPS = np.finfo(float).eps


def brute_force(y, x, fixed, k):
    """(reason, rank, sd, z) of one gene from a direct least-squares solve."""
    used = np.isfinite(y)
    n = int(used.sum())
    design = np.column_stack([np.ones(n), x[used][:, : fixed + k]])
    if n == 0:
        return "other", None, None, None
    rank = int(np.linalg.matrix_rank(design))
    if n <= rank + 1:
        return "insufficient_dof", rank, None, None
    if rank < design.shape[1]:
        return "rank_deficiency", rank, None, None
    beta = np.linalg.lstsq(design, y[used], rcond=None)[0]
    r = y[used] - design @ beta
    r -= r.mean()
    sd = r.std()
    if not math.isfinite(sd) or sd <= EPS * max(1, np.abs(y[used]).max()) * 16:
        return "invalid_or_zero_residual_sd", rank, sd, None
    z = np.full(len(y), np.nan)
    z[used] = r / sd
    return None, rank, sd, z


def frames(spark, y, x):
    genes, samples = [f"G{g}" for g in range(y.shape[1])], [f"S{i:03d}" for i in range(len(x))]
    obs = [
        (g, s, None if np.isnan(y[i, j]) else float(y[i, j]))
        for j, g in enumerate(genes) for i, s in enumerate(samples)
    ]
    observations = spark.createDataFrame(obs, "gene_id string, sample_id string, value double")
    design = spark.createDataFrame(
        [(s, [float(v) for v in row]) for s, row in zip(samples, x)],
        "sample_id string, x array<double>",
    )
    return genes, samples, observations, design


@pytest.mark.parametrize("blocks,gene_blocks,fan_in", [(1, 1, 32), (5, 3, 2), (9, 2, 4)])
@pytest.mark.parametrize("fixed", [0, 2])
def test_sweep_matches_direct_least_squares(spark, blocks, gene_blocks, fan_in, fixed):
    rng = np.random.default_rng(7)
    n, g, ks = 60, 12, (0, 1, 3, 6)
    x = rng.normal(size=(n, fixed + 6))
    x[:, fixed + 4] = x[:, fixed + 3] if fixed else x[:, fixed + 4]
    y = rng.normal(size=(n, g)) * 10 + 100 + x[:, :1]
    y[:, 1] = 5.0
    y[rng.random((n, g)) < 0.1] = np.nan
    y[:, 2] = np.arange(n)
    y[4:, 3] = np.nan
    y[:, 4] = np.nan
    y[1:, 5] = np.nan
    genes, samples, observations, design = frames(spark, y, x)
    sweep = residuals.Sweep(fixed, ks, blocks, gene_blocks, fan_in)
    thresholds = (-0.5, -1.0, -2.0)
    flags = rng.random((n, g, 3)) < 0.3
    carried = spark.createDataFrame(
        [(gene, s, *map(bool, flags[i, j])) for j, gene in enumerate(genes)
         for i, s in enumerate(samples)],
        "gene_id string, sample_id string, " + ", ".join(f"{f} boolean" for f in FLAGS),
    )
    flagged = observations.join(carried, ["gene_id", "sample_id"])
    got = {
        (r.gene_id, r.pc_count): r
        for r in residuals.gene_sweep(flagged, design, fixed, ks, thresholds, sweep).collect()
    }
    z_rows = {
        (r.gene_id, r.sample_id, r.pc_count): r.z
        for r in residuals.residual_z(observations, design, fixed, ks, sweep).collect()
    }
    assert len(got) == g * len(ks)
    expected_z = 0
    for j, gene in enumerate(genes):
        for k in ks:
            reason, rank, sd, z = brute_force(y[:, j], x, fixed, k)
            row = got[gene, k]
            assert (row.reason, row["rank"]) == (reason, rank), (gene, k)
            if z is None:
                assert row.o0 == 0 and row.c0 == 0
                continue
            assert row.residual_sd == pytest.approx(sd, rel=1e-10)
            assert row.residual_mean == pytest.approx(0, abs=1e-10)
            seen = np.isfinite(z)
            expected_z += int(seen.sum())
            for i in np.flatnonzero(seen):
                assert z_rows[gene, samples[i], k] == pytest.approx(z[i], abs=1e-9)
            for t, threshold in enumerate(thresholds):
                low = seen & (z <= threshold)
                assert row[f"o{t}"] == low.sum()
                for d in range(3):
                    assert row[f"x{t}_{d}"] == (low & flags[:, j, d]).sum()
                    assert row[f"c{d}"] == (seen & flags[:, j, d]).sum()
    assert len(z_rows) == expected_z


def test_hand_checked_residuals(spark):
    y = np.array([[3.0, 0], [1, np.nan], [4, 0], [6, 2], [8, 2]])
    x = np.array([[0.0], [0], [1], [1], [2]])
    _, samples, observations, design = frames(spark, y, x)
    sweep = residuals.Sweep(0, (0, 1), 2, 1)
    z = {(r.gene_id, r.sample_id, r.pc_count): r.z
         for r in residuals.residual_z(observations, design, 0, (0, 1), sweep).collect()}
    half = math.sqrt(5) / 2
    want = [half, -half, -half, half, 0]
    assert [z["G0", s, 1] for s in samples] == pytest.approx(want, abs=1e-12)
    assert [z.get(("G1", s, 0)) for s in samples] == [
        pytest.approx(-1), None, pytest.approx(-1), pytest.approx(1), pytest.approx(1)]


def test_intercept_only_route_agrees_with_the_sweep(spark):
    rng = np.random.default_rng(3)
    y = rng.normal(size=(40, 5))
    y[:, 1] = 7.0
    y[2:, 2] = np.nan
    y[:, 3] = np.nan
    _, _, observations, design = frames(spark, y, np.zeros((40, 0)))
    flagged = observations.selectExpr("*", *[f"sample_id < 'S020' AS {f}" for f in FLAGS])
    one = residuals.gene_baseline(flagged, [-1.0, -2.0]).orderBy("gene_id").collect()
    two = residuals.gene_sweep(
        flagged, design, 0, [0], [-1.0, -2.0], residuals.Sweep(0, (0,), 3, 2)
    ).orderBy("gene_id").collect()
    for a, b in zip(one, two, strict=True):
        a, b = a.asDict(), b.asDict()
        for column in ("residual_mean", "residual_sd"):
            assert a.pop(column) == pytest.approx(b.pop(column), abs=1e-12)
        assert a == b
