"""Block gzip by byte ranges, heads of files, and tables laid out by region."""

import gzip
import json
import random
import struct
import zlib

import pytest

from tailfold.plans import rare_variant as R
from tailfold.sources import blocks, regions, text, vcf
from tailfold.sources.vat import VatSchema
from tests.outputs import content
from tests.test_rare_variant_files import FEATURES, RECORDS, VAT_HEADER, VAT_ROWS, vat_row, vcf_text


def bgzf(data: bytes, block: int, level: int = 6) -> bytes:
    """Block gzip by the standard library."""
    out = []
    for i in range(0, len(data), block):
        maker = zlib.compressobj(level, zlib.DEFLATED, -15)
        body = maker.compress(data[i:i + block]) + maker.flush()
        out.append(blocks.HEADER + struct.pack("<H", len(body) + 25) + body + struct.pack(
            "<II", zlib.crc32(data[i:i + block]), len(data[i:i + block])))
    return b"".join([*out, blocks.END])


def some_lines(rng, count):
    return ["".join(rng.choice("ab\t\x1f\x8bé") for _ in range(rng.choice([0, 1, 30, 900]))) for _ in range(count)]


@pytest.mark.parametrize("name", ["x.bgz", "x.vcf.gz"])
@pytest.mark.parametrize("block, split_bytes, last_break, count", [
    (60_000, 1 << 27, True, 900), (500, 3000, True, 400), (500, 3000, False, 400), (7, 400, True, 40), (100, 1 << 27, False, 1)])
def test_block_gzip_of_any_split(spark, tmp_path, monkeypatch, name, block, split_bytes, last_break, count):
    rng = random.Random(block + split_bytes + count)
    lines = [*some_lines(rng, count), "long" * 3000, "", "end"]
    whole = "\n".join(lines) + ("\n" if last_break else "")
    (tmp_path / name).write_bytes(bgzf(whole.encode(), block))
    monkeypatch.setattr(blocks, "RUN_MEMBERS", 4)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    try:
        read = text.read_lines(spark, tmp_path / name)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r.line for r in read.orderBy("ord").collect()] == lines
    if block == 500:
        assert read.select("ord.block").distinct().count() > 5


def test_several_tasks_read_one_file(spark, tmp_path):
    (tmp_path / "x.bgz").write_bytes(bgzf(random.Random(1).randbytes(200_000).hex().encode(), 20_000))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        assert blocks._members(spark, str(tmp_path / "x.bgz"), True).rdd.getNumPartitions() > 8
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("lines", [[], [""], ["a"], ["x" * 200_000, "é", ""], None])
def test_written_block_gzip_is_gzip(spark, tmp_path, lines):
    rng = random.Random(3)
    lines = [rng.randbytes(40).hex() for _ in range(9000)] if lines is None else lines
    frame = spark.createDataFrame([(x,) for x in lines], "line string").coalesce(1)
    blocks.write_block_gzip(frame, str(tmp_path / "out"))
    data = b"".join(p.read_bytes() for p in sorted((tmp_path / "out").glob("part-*")))
    assert gzip.decompress(data).decode() == "".join(x + "\n" for x in lines)
    assert not data or data.endswith(blocks.END)
    got = text.read_lines(spark, tmp_path / "out").orderBy("ord").collect()
    assert [r.line for r in got] == lines


@pytest.mark.parametrize("change, message", [
    (lambda d: d[:len(d) // 2], "ends inside a member"), (lambda d: d[:300] + b"?" + d[301:], "damaged|length|invalid")])
def test_damaged_block_gzip_is_an_error(spark, tmp_path, change, message):
    data = bgzf(random.Random(2).randbytes(3000).hex().encode(), 1000)
    (tmp_path / "x.bgz").write_bytes(change(data))
    with pytest.raises(Exception, match=message):
        text.read_lines(spark, tmp_path / "x.bgz").count()


def test_heads_need_no_job(spark, tmp_path):
    contigs = "".join(f"##contig=<ID=c{i}>\n" for i in range(3000))
    whole = vcf_text(("A", "B"), RECORDS, contigs).encode()
    tracker = spark.sparkContext.statusTracker()
    for name, data in (("a.vcf", whole), ("b.vcf.bgz", bgzf(whole, 2000)), ("c.vcf", gzip.compress(whole))):
        (tmp_path / name).write_bytes(data)
        spark.sparkContext.setJobGroup(name, "head")
        samples, found = vcf.read_header(spark, tmp_path / name)
        assert (samples, len(found)) == (["A", "B"], 3000)
        assert list(tracker.getJobIdsForGroup(name)) == []
    spark.sparkContext.setJobGroup("", "")
    (tmp_path / "blank").write_text("\n  \nfirst\nsecond\n")
    assert text.first_line(spark, tmp_path / "blank", "x") == "first"
    assert text.first_line(spark, tmp_path / "blank", "x", skip_blank=False) == ""
    (tmp_path / "none").write_text("")
    with pytest.raises(ValueError, match="x is empty"):
        text.first_line(spark, tmp_path / "none", "x")
    with pytest.raises(ValueError, match="unable to read"):
        text.first_line(spark, tmp_path / "absent", "x")


def test_record_ends(spark):
    rows = [(5, "ACGT", "AC=1", 8), (5, "A", "END=90;AC=1", 90), (5, "AC", "AC=1;END=5", 5), (5, "AC", "XEND=70", 6),
            (5, "ACG", "END=3", 7), (5, "AC", "END=x", 6), (5, "", ".", 5), (5, "ACG", None, 7)]
    frame = spark.createDataFrame(rows, "pos long, ref string, info string, expected long")
    for r in frame.withColumn("got", vcf.record_end(frame.pos, frame.ref, frame.info)).collect():
        assert r.got == r.expected, r


# -------------------------------------------------------------- layouts


def records_frame(spark, rng, count):
    rows = []
    for i in range(count):
        pos = rng.randrange(1, 50_000)
        rows.append((rng.choice(["1", "01", "chrX"]), pos, pos + rng.choice([0, 3, rng.randrange(9000)]), i, ["g"]))
    return spark.createDataFrame(rows, "chrom string, pos long, end_pos long, id long, samples array<string>"), rows


def test_layout_gives_all_records_near_and_prunes_the_rest(spark, tmp_path):
    rng = random.Random(4)
    frame, rows = records_frame(spark, rng, 3000)
    regions.write_layout(frame, tmp_path / "l", {"samples": ["a"]}, 1000)
    assert regions.is_layout(tmp_path / "l") and not regions.is_layout(tmp_path)
    layout = regions.read_layout(spark, tmp_path / "l")
    assert layout.header == {"samples": ["a"], "span_bp": 1000}
    assert sorted(map(tuple, layout.records.select(*frame.columns).collect())) == sorted(rows)
    windows = [("01", 4100, 4300), ("01", 20_500, 22_500), ("chrX", 1, 10), ("other", 5, 9)]
    near = layout.near(spark.createDataFrame(windows, "chrom string, start long, end long"))
    got = {r.id for r in near.collect()}
    reaching = {i for c, p, e, i, _ in rows for w, a, b in windows if w == c and p <= b and e >= a}
    assert reaching and reaching <= got and set(near.columns) == set(frame.columns)
    assert got <= {i for c, p, e, i, _ in rows if (c == "01" and p <= 22_500 and e >= 4100) or (c == "chrX" and p <= 10)}
    files = {r.f for r in near.select("_metadata.file_path", "id").withColumnRenamed("file_path", "f").collect()}
    assert files and all("chrom=01" in f or "chrom=chrX" in f for f in files)
    plan = near._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PartitionFilters: [" in plan and "chrom=" not in plan.split("PartitionFilters")[0]
    assert "LessThanOrEqual(pos" in plan and "GreaterThanOrEqual(end_pos" in plan
    nothing = layout.near(spark.createDataFrame([], "chrom string, start long, end long"))
    assert nothing.count() == 0


@pytest.fixture
def cohort(spark, tmp_path):
    """Two chromosomes; records that reach query chunks from the left."""
    records = [*RECORDS, (1900, "C" * 150, "A", "AC=2", "0/1\t0/1"), (2398, "A", "C", "AC=1;END=2460", "0/1\t./.")]
    other = [(70, "A" * 45, "T", "AC=1", "0/1\t0/0"), (100, "G", "T", ".", "0/1\t1/1")]
    body = vcf_text(("K1", "K2"), records, "##contig=<ID=chr5>\n##contig=<ID=chr6>\n##contig=<ID=chr7>\n")
    body += "".join(f"chr6\t{p}\t.\t{r}\t{a}\t.\tPASS\t{i}\tGT\t{g}\n" for p, r, a, i, g in other)
    rows = [*VAT_ROWS, vat_row(100, "G", "T", "ENSG9.1", "stop_gained", "HC", "0.001").replace("chr5", "chr6", 1)]
    paths = {n: tmp_path / n for n in ("vcf", "vat", "vat_schema", "features", "shared_samples")}
    paths["vcf"].write_text(body)
    paths["vat"].write_bytes(bgzf(("\n".join([VAT_HEADER, *rows]) + "\n").encode(), 90))
    paths["vat_schema"].write_text(VatSchema(tuple(VAT_HEADER.split("\t"))).to_json())
    paths["features"].write_text("chrom\ttss\tfeature_id\n" + FEATURES + "chr6\t120\tENSG9.3\nchr8\t5\tENSG1.1\n")
    paths["shared_samples"].write_text("K1\nK2\n")
    options = {"exact_ac": [1, 2], "cumulative_ac_max": [3], "consequence_classes": ["stop_gained"],
               "maximum_gvs_maf": 0.01, "max_distance": 60, "annotation_chunk_size_bp": 40}
    return paths, options, records, other


def test_all_chromosomes_at_once_from_texts_and_from_layouts(spark, tmp_path, cohort):
    paths, options, records, other = cohort
    wanted = ["chr5", "chr6", "chr7"]
    R.classify_chromosomes(spark, **paths, **options, chromosomes=wanted, output_folder=tmp_path / "texts")
    regions.index_vcf(spark, paths["vcf"], tmp_path / "vcf-regions", 500)
    regions.index_vat(spark, paths["vat"], tmp_path / "vat-regions", 500)
    laid = {**paths, "vcf": tmp_path / "vcf-regions", "vat": tmp_path / "vat-regions"}
    R.classify_chromosomes(spark, **laid, **options, chromosomes=wanted, output_folder=tmp_path / "layouts")
    names = {f"{c}.{k}" for c in wanted for k in ("carriers.tsv", "regions.bed", "qc.json")}
    for folder in ("texts", "layouts"):
        assert {p.name for p in (tmp_path / folder).iterdir()} == names
    for name in names:
        assert content(tmp_path / "texts" / name) == content(tmp_path / "layouts" / name)
    out = {n: tmp_path / n for n in ("carrier_output", "regions_output", "qc_output")}
    R.classify_chromosome(spark, **paths, **options, chromosome="chr6", **out)
    for name, kind in zip(out, ("carriers.tsv", "regions.bed", "qc.json")):
        assert content(out[name]) == content(tmp_path / "texts" / f"chr6.{kind}")
    # one region query per chunk finds every record that overlaps it
    chunks = {"chr5": [(s, min(s + 39, e)) for a, e in ((1940, 2060), (2340, 2460)) for s in range(a, e + 1, 40)],
              "chr6": [(s, min(s + 39, 180)) for s in range(60, 181, 40)]}
    for chrom, own in (("chr5", records), ("chr6", other)):
        qc = json.loads((tmp_path / "texts" / f"{chrom}.qc.json").read_text())
        ends = [(p, 2460 if "END" in i else p + len(r) - 1) for p, r, _, i, _ in own]
        meetings = [(p, s) for p, q in ends for s, e in chunks[chrom] if p <= e and q >= s]
        assert qc["extracted_records"] == len(meetings) > len(own)
        assert qc["classified_alt_alleles"] == len(meetings)
        assert qc["vat_joined_alt_alleles"] == {"chr5": 5, "chr6": 1}[chrom]
        assert qc["vat_joined_alt_alleles"] + qc["vat_unmatched_alt_alleles"] == len(meetings)
    assert json.loads((tmp_path / "texts" / "chr7.qc.json").read_text())["feature_count"] == 0


def test_layouts_name_bad_records_by_place(spark, tmp_path, cohort):
    paths, options, *_ = cohort
    text_ = paths["vcf"].read_text().replace("AC=2\tGT\t0/1\t0/1", "AC=2,7\tGT\t0/1\t0/1", 1)
    paths["vcf"].write_text(text_)
    regions.index_vcf(spark, paths["vcf"], tmp_path / "vcf-regions")
    with pytest.raises(ValueError, match="VCF has .* at chr5:1955"):
        R.classify(spark, **{**paths, "vcf": tmp_path / "vcf-regions"}, **options, chromosomes=["chr5"])
    paths["vcf"].write_text(text_.replace("chr5\t1955", "chr5\tx"))
    with pytest.raises(ValueError, match="non-integer position"):
        regions.index_vcf(spark, paths["vcf"], tmp_path / "more")
    paths["vat_schema"].write_text(VatSchema(tuple(reversed(VAT_HEADER.split("\t")))).to_json())
    regions.index_vat(spark, paths["vat"], tmp_path / "vat-regions")
    paths["vcf"].write_text(vcf_text(("K1", "K2"), RECORDS))
    with pytest.raises(ValueError, match="another header"):
        R.classify(spark, **{**paths, "vat": tmp_path / "vat-regions"}, **options, chromosomes=["chr5"])
