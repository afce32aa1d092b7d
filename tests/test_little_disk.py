"""Large texts and layouts are made in slices, on rows made here."""

import gzip
from datetime import datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tailfold import sinks
from tailfold.operators import ranges
from tailfold.plans import file_queries
from tailfold.plans import surrogates as S
from tailfold.session import release
from tailfold.sources import regions


def test_rows_of_a_layout_are_never_on_disk_twice(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(regions, "SLICE_ROWS", 100)
    rows = [(c, p, p + (900 if p % 50 == 0 else 0), i) for i, (c, p) in enumerate(
        [(c, p) for p in range(1, 4000, 9) for c in ("b", "a")] + [("c", 5)] * 400)]
    schema = "chrom string, pos long, end_pos long, id int"
    frame = spark.createDataFrame(rows, schema).repartition(3)
    root, seen = tmp_path / "kept", []
    monkeypatch.setattr(regions, "staging_root", lambda _: str(root))

    def on_disk(*args):
        staged = list(root.glob("region-rows-*/**/*.parquet"))
        laid = list((tmp_path / "l" / "records").glob("**/*.parquet"))
        seen.append(sum(pq.read_metadata(f).num_rows for f in [*staged, *laid]))
        release(*args)

    monkeypatch.setattr(regions, "release", on_disk)
    regions.write_layout(frame, tmp_path / "l", {"samples": []}, 100)
    assert len(seen) > 4 and set(seen) == {len(rows)}
    assert not list(root.glob("region-rows-*"))
    layout = regions.read_layout(spark, tmp_path / "l")
    assert {tuple(r) for r in layout.records.select("chrom", "pos", "end_pos", "id").collect()} == set(rows)
    windows = [("a", 1000, 1010), ("b", 3990, 3999), ("c", 1, 9)]
    got = {r.id for r in layout.near(spark.createDataFrame(windows, "chrom string, start long, end long")).collect()}
    assert {i for c, p, e, i in rows for w, a, b in windows if w == c and p <= b and e >= a} <= got
    with pytest.raises(Exception, match="(?i)already.exists"):
        regions.write_layout(frame, tmp_path / "l", {"samples": []}, 100)
    assert not list(root.glob("region-rows-*"))
    regions.write_layout(frame.limit(0), tmp_path / "none", {"samples": []}, 100)
    assert regions.read_layout(spark, tmp_path / "none").records.count() == 0


def test_slices_of_a_table_are_the_table(spark, tmp_path):
    rows = spark.createDataFrame([(i * 7 % 101, f"v{i}") for i in range(101)] + [(None, "no key")], "k long, v string")
    for name, how in (("one", {}), ("four", {"bounds": [10, 40, 90], "compress": True})):
        sinks.write_table(tmp_path / name, rows, ["k"], ["k", "v"], **how)
    parts = [sorted(p for p in (tmp_path / n).iterdir() if p.name.startswith("part-")) for n in ("one", "four")]
    whole = "".join(p.read_text() for p in parts[0])
    assert whole == "".join(gzip.decompress(p.read_bytes()).decode() for p in parts[1])
    assert whole.startswith("k\tv\n\tno key\n0\tv0\n") and whole.count("k\tv\n") == 1 and len(parts[1]) >= 4
    assert not [p for p in tmp_path.iterdir() if p.name.startswith("_")]


def test_compressed_parts_hold_few_lines(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "GZIP_LINES", 10)
    sinks.write_table(tmp_path / "t", spark.range(95).coalesce(1), ["id"], ["id"], compress=True)
    sizes = [len(gzip.decompress(p.read_bytes()).splitlines()) for p in sorted((tmp_path / "t").glob("part-*"))]
    assert sum(sizes) == 96 and max(sizes) <= 10


@pytest.mark.parametrize("words", [0, 3, 500])
def test_rows_far_from_all_windows_do_not_move(spark, monkeypatch, words):
    monkeypatch.setattr(ranges, "BROADCAST_ROWS", words)
    rows = spark.createDataFrame([(c, p) for c in "ab" for p in range(-500, 90_000, 3)] + [("c", 1)], "chrom string, pos long")
    spans = [("a", 1, 30), ("a", 42_000, 42_900), ("b", 89_000, 89_041), ("b", 70, 100)]
    windows = spark.createDataFrame(spans, "chrom string, start long, end long")
    got = ranges.within_windows(rows, windows, 2, 15)
    want = sorted((c, p, a, (p - a) // 15) for c in "ab" for p in range(-500, 90_000, 3) for w, a, b in spans if w == c and a <= p <= b)
    assert sorted((r.chrom, r.pos, r.chunk.window, r.chunk.piece) for r in got.collect()) == want
    if words < 500:
        index = windows.select("chrom", F.explode(F.sequence(F.floor(F.col("start") / 5), F.floor(F.col("end") / 5))).alias("_bin"))
        left = rows.withColumn("_bin", F.floor(F.col("pos") / 5).cast("bigint"))
        for bins in (36_000, 1):
            kept = {tuple(r) for r in ranges._sifted(left, index, bins).collect()}
            listed = {tuple(r) for r in left.join(index, ["chrom", "_bin"], "left_semi").select(*left.columns).collect()}
            assert {(c, b, p) for c, p, b in listed} <= {(r[0], r[2], r[1]) for r in kept} or listed <= kept
            if bins == 1:
                assert kept == listed


def test_annotation_text_is_compressed_and_gone_before_the_layout_is_read(spark, tmp_path, monkeypatch):
    lines = [(o, o % 7 + 1, o % 5 + 1, n, float(o % 50 + 1), 10.0, 0.01 * (o % 10), 0.01 * (o % 8), "RAN"[o % 3], "FO"[n % 2],
              datetime(1995, 1, 1)) for o in range(1, 200) for n in (1, 2)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                          "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                          "l_shipdate timestamp").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(o, o, "FOP"[o % 3]) for o in range(1, 200)], "o_orderkey long, o_custkey long, o_orderstatus string"
                          ).write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame([(p, p) for p in range(1, 30)], "p_partkey long, p_size int").write.parquet(str(tmp_path / "part.parquet"))
    d, root, seen = str(tmp_path), tmp_path / "kept", []
    monkeypatch.setattr(file_queries, "staging_root", lambda _: str(root))

    def texts():
        return list(root.glob("vat-*/part-*.txt*"))

    opened = regions.open_vat
    monkeypatch.setattr(regions, "open_vat", lambda s, path, schema: seen.append(
        (regions.is_layout(path), [p.suffix for p in texts()])) or opened(s, path, schema))
    monkeypatch.setattr(regions, "SLICE_ROWS", 100)
    got = {(r.source, r.chrom): r.vat_rows for r in file_queries.annotation_file_counters(spark, d).collect()}
    assert [(laid, set(kinds)) for laid, kinds in seen] == [(False, {".gz"}), (True, set())] and len(seen[0][1]) >= 3
    near = {(f"chr{o % 5}", o) for o in range(1, 200) for p in range(1, 30) if p % 5 == o % 5 and abs(o * 7 - p * 50) <= 20}
    want = {c: 2 * sum(x == c for x, _ in near) for c, _ in near}
    assert got == {(s, c): n for s in ("text", "layout") for c, n in want.items()}
    assert "count(distinct" not in S.transcript_rows(spark, d)._jdf.queryExecution().analyzed().toString().lower()
