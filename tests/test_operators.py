"""Operators on small frames against brute force, with hot keys on purpose."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tailfold import config
from tailfold.functions import tables
from tailfold.functions import values as V
from tailfold.operators import fdr, ranges, vat
from tailfold.operators.collapse import carrier_pairs, collapse_genes


def bh(ps):
    order = sorted(range(len(ps)), key=ps.__getitem__)
    out, best = [0.0] * len(ps), 1.0
    for rank in range(len(ps), 0, -1):
        best = min(best, ps[order[rank - 1]] * len(ps) / rank)
        out[order[rank - 1]] = best
    return out


@pytest.mark.parametrize("rows_per_bucket,small,broadcast", [
    (10**6, True, 10**6), (10**6, False, 10**6), (7, False, 10**6), (7, False, 0)])
def test_fdr_with_ties_and_buckets(spark, monkeypatch, rows_per_bucket, small, broadcast):
    monkeypatch.setattr(fdr, "ROWS_PER_BUCKET", rows_per_bucket)
    monkeypatch.setattr(fdr, "BROADCAST_VALUES", broadcast)  # 0: the salted join
    draw = random.Random(5)
    ps = [1.0 if draw.random() < 0.5 else round(draw.random() ** 3, 2) for _ in range(300)]
    rows = spark.createDataFrame(list(enumerate(ps)), "i int, p double")
    got = {r.i: r.q for r in fdr.benjamini_hochberg(rows, "p", "q", small).collect()}
    assert [got[i] for i in range(len(ps))] == pytest.approx(bh(ps), rel=1e-12)


def test_fdr_golden_values(spark):
    rows = spark.createDataFrame([(0.01,), (0.04,), (0.03,)], "p double")
    got = {r.p: r.q for r in fdr.benjamini_hochberg(rows, "p", "q", True).collect()}
    assert got == pytest.approx({0.01: 0.03, 0.04: 0.04, 0.03: 0.04})


def test_fisher_golden_values(spark):
    assert tables.fisher_two_sided(1, 9, 11, 3) == pytest.approx(0.002759456, rel=1e-6)
    assert tables.fisher_two_sided(1, 19999999, 9, 7979999991) == pytest.approx(
        0.024720616835182417, rel=1e-12)
    assert tables.fisher_two_sided(0, 0, 0, 0) == 1.0
    assert tables.fisher_two_sided(125_000, 125_000, 125_000, 125_000) == 1.0
    with pytest.raises(ValueError):
        tables.fisher_two_sided(-1, 0, 0, 0)
    draw = random.Random(2)
    for _ in range(60):
        cells = [draw.randrange(12) for _ in range(4)]
        a, b, c, d = cells
        row, col, n = a + b, a + c, sum(cells)
        weights = {x: math.comb(row, x) * math.comb(n - row, col - x)
                   for x in range(max(0, row + col - n), min(row, col) + 1)}
        expected = sum(w for w in weights.values() if w <= weights[a]) / math.comb(n, col)
        assert tables.fisher_two_sided(*cells) == pytest.approx(expected, rel=1e-12)
    tables.register(spark)
    assert spark.sql("SELECT fisher_exact(1L, 9L, 11L, 3L) p").first().p == pytest.approx(
        0.002759456, rel=1e-6)


def merged(intervals, closed):
    out = []
    for lo, hi in sorted(intervals):
        if out and (lo <= out[-1][1] if closed else lo < out[-1][1]):
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [tuple(x) for x in out]


@pytest.mark.parametrize("bucket,broadcast", [(1 << 20, 10**6), (64, 0)])
@pytest.mark.parametrize("distance", [0, 3, 20])
def test_windows_chunks_and_lookup(spark, monkeypatch, bucket, broadcast, distance):
    monkeypatch.setattr(ranges, "BUCKET_BP", bucket)
    monkeypatch.setattr(ranges, "BROADCAST_ROWS", broadcast)
    draw = random.Random(distance)
    sites = [5] * 30 + [draw.randrange(1, 3000) for _ in range(60)]
    features = spark.createDataFrame(
        [("c1", t, f"F{i}") for i, t in enumerate(sites)], "chrom string, tss bigint, feature_id string")
    opened = merged([(max(0, t - distance - 1), t + distance) for t in sites], False)
    closed = merged([(max(1, t - distance), t + distance) for t in sites], True)
    got = ranges.tss_windows(features, distance).orderBy("start").collect()
    assert [(r.start, r.end) for r in got] == opened
    windows = ranges.query_windows(features, distance)
    assert [(r.start, r.end) for r in windows.orderBy("start").collect()] == closed
    chunks = ranges.query_chunks(features, distance, 10).orderBy("start").collect()
    assert [(r.start, r.end) for r in chunks] == [
        (s, min(hi, s + 9)) for lo, hi in closed for s in range(lo, hi + 1, 10)]
    positions = [draw.randrange(1, 3100) for _ in range(500)] + [5] * 200
    rows = spark.createDataFrame(
        [("c1", p, i) for i, p in enumerate(positions)], "chrom string, pos bigint, i int")
    located = {r.i: (r.chunk.window, r.chunk.piece)
               for r in ranges.within_windows(rows, windows, distance, 10).collect()}
    expected = {i: (lo, (p - lo) // 10) for i, p in enumerate(positions)
                for lo, hi in closed if lo <= p <= hi}
    assert located == expected


@pytest.mark.parametrize("broadcast", [0, 10**6])
@pytest.mark.parametrize("distance", [0, 1, 40])
def test_range_join_matches_all_pairs_with_a_hot_position(spark, monkeypatch, broadcast, distance):
    monkeypatch.setattr(ranges, "BROADCAST_ROWS", broadcast)
    draw = random.Random(distance)
    sites = [100] * 5 + [draw.randrange(1, 2000) for _ in range(80)]
    positions = [100] * 150 + [draw.randrange(1, 2000) for _ in range(300)]
    features = spark.createDataFrame(
        [(f"c{i % 2}", t, i) for i, t in enumerate(sites)], "chrom string, tss bigint, f int")
    variants = spark.createDataFrame(
        [(f"c{i % 2}", p, i) for i, p in enumerate(positions)], "chrom string, pos bigint, v int")
    got = sorted((r.v, r.f, r.distance) for r in
                 ranges.range_join(variants, features, distance).collect())
    assert got == sorted(
        (v, f, abs(p - t)) for v, p in enumerate(positions) for f, t in enumerate(sites)
        if v % 2 == f % 2 and abs(p - t) <= distance)


def test_windows_reject_bad_parameters(spark):
    features = spark.createDataFrame([("c1", 5, "F")], "chrom string, tss bigint, feature_id string")
    with pytest.raises(ValueError):
        ranges.tss_windows(features, -1)
    for bad in (0, -1, True):
        with pytest.raises(ValueError, match="annotation_chunk_size_bp"):
            ranges.query_chunks(features, 10, bad)


def frequency_by_rule(texts):
    """Status of an allele read row by row."""
    anchor, status = None, None
    for kind, value in texts:
        if status == "inconsistent":
            break
        if kind != "valid":
            status = kind
        elif anchor is None:
            anchor, status = value, status or "valid"
        elif abs(value - anchor) > 1e-12:
            status = "inconsistent"
    return status, anchor


def test_frequency_statuses_follow_row_order(spark):
    draw = random.Random(11)
    kinds = {"NA": ("missing", None), "x": ("non_numeric", None), "1.5": ("out_of_range", None),
             "nan": ("non_numeric", None), "inf": ("non_numeric", None), "0.001": ("valid", 0.001),
             "1e-3": ("valid", 0.001), "0.999": ("valid", 0.999), " 0.02 ": ("valid", 0.02)}
    rows, expected = [], {}
    for pos in range(1, 150):
        texts = [draw.choice(list(kinds)) for _ in range(draw.randrange(1, 4))]
        expected[pos] = frequency_by_rule([kinds[t] for t in texts])
        rows += [("c", pos, "A", "C", "G", "stop_gained", t, i) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(
        rows, "chrom string, pos bigint, ref string, alt string, gene_id string, "
        "consequence string, gvs_max_af string, ord int").repartition(5)
    got = {r.pos: (r.status, r.raw_af) for r in
           vat.allele_frequencies(vat.interpret(frame)).collect()}
    assert got == expected


def test_minor_frequency_is_exact(spark):
    rows = [("c", i, "A", "C", "G", "x", t, 0) for i, t in enumerate(("0.99", "0.01", "9.9e-1"))]
    frame = spark.createDataFrame(
        rows, "chrom string, pos int, ref string, alt string, gene_id string, "
        "consequence string, gvs_max_af string, ord int")
    assert [r.maf for r in vat.allele_frequencies(vat.interpret(frame)).collect()] == [0.01] * 3


def test_transcripts_collapse_to_the_most_severe(spark):
    rows = [("ENSG1.1", "missense_variant&made_up", "LC"), ("ENSG1.2", "stop_gained , NA", " hc "),
            ("ENSG1", "intron_variant,intron_variant", "."), ("GENE.17", "made_up", "?"),
            ("NaN", "stop_lost", "HC")]
    frame = spark.createDataFrame(
        [("c", 1, "A", "C", g, c, "0.1", lof, i) for i, (g, c, lof) in enumerate(rows)],
        "chrom string, pos int, ref string, alt string, gene_id string, consequence string, "
        "gvs_max_af string, LoF string, ord int")
    parsed = vat.interpret(frame)
    assert {r.gene_key: (r.consequence, r.loftee) for r in vat.gene_annotations(parsed).collect()} == {
        "ENSG1": ("stop_gained", "HC"), "GENE.17": (None, None)}
    counters = vat.row_counters(parsed, []).first()
    assert (counters.consequence_terms_parsed, counters.recognized_consequence_terms,
            counters.unknown_consequence_rows) == (6, 4, 2)
    assert (counters.loftee_hc_values, counters.loftee_lc_values, counters.loftee_missing_values,
            counters.loftee_unrecognized_values) == (1, 1, 1, 1)
    assert {r.term: r.row_count for r in vat.unknown_term_counts(parsed, []).collect()} == {"made_up": 2}


def test_collapse_and_carrier_definitions(spark):
    values = spark.createDataFrame(
        [("G", "S", 2.0), ("G", "S", None), ("G", "S", -1.0), ("G", "T", None)],
        "gene_id string, sample_id string, value double")
    assert {r.sample_id: r.value for r in collapse_genes(values).collect()} == {"S": -1.0, "T": None}
    carriers = spark.createDataFrame(
        [("S", "G", True, " hc, x"), ("S", "G", True, ""), ("T", "G", True, "lc"),
         ("U", "G", True, "OS"), ("V", "G", False, "HC")],
        "sample_id string, gene_id string, has_lof boolean, lof_classes string")
    assert {r.sample_id: (r.is_any_lof, r.is_hc, r.is_hc_or_lc)
            for r in carrier_pairs(carriers).collect()} == {
        "S": (True, True, True), "T": (True, False, True), "U": (True, False, False)}


def test_number_text(spark):
    texts = {"1": 1.0, " 2.5 ": 2.5, "-.5e-3": -0.0005, "5.": 5.0, "+1": 1.0, "1d": None, "1F": None,
             "0x1p3": None, "inf": None, "NaN": None, "1e400": None, "": None, "a": None}
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: r.v for r in rows.select("t", V.to_double(F.col("t")).alias("v")).collect()}
    assert got == texts


@pytest.mark.parametrize("available,expected", [
    (0, [0]), (1, [0]), (3, [0, 1, 2]), (12, list(range(12))),
    (105, [*range(11), *range(20, 101, 10), 104]),
    (603, [*range(11), *range(20, 101, 10), *range(150, 501, 50), 600, 602]),
])
def test_adaptive_grid(available, expected):
    assert config.pc_grid([], available) == expected


def test_grids_and_classes():
    assert config.pc_chunks([0, 1, 2, 5], 9, 3) == [[0, 1, 2], [5]]
    for bad in ([1, 1], [2, 1], [9], [-1], [True]):
        with pytest.raises(ValueError):
            config.pc_grid(bad, 9)
    labels = [c.label for c in config.ac_classes([2, 1, 2], [5])]
    assert labels == ["AC=2", "AC=1", "AC<=5"]
    assert config.annotation_classes(["missense_variant", "stop_gained"], True) == [
        ("baseline", "all_rare_variants"), ("consequence", "stop_gained"),
        ("consequence", "missense_variant"), ("loftee", "HC"), ("loftee", "LC")]
    for bad in ([], [0.0], [-1, -1.0], [float("nan")], [True]):
        with pytest.raises(ValueError, match="negative z-score thresholds"):
            config.negative_thresholds(bad)
