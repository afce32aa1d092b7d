"""Outputs: one layout at every size, any file system, drafts."""

import json

import pytest

from tailfold import cli, files, sinks
from tailfold.plans import lof_pc, rare_variant
from tailfold.sources import tables, text
from tests.outputs import content


def table(spark, count):
    return spark.range(count, numPartitions=7).selectExpr(
        "id * 7919 % 1000003 AS n", "concat('name ', id) AS `#name`", "nullif(id % 3, 0) AS gap")


@pytest.mark.parametrize("compress", [False, True])
@pytest.mark.parametrize("count", [0, 1, 10, 300_000])
def test_tables_have_the_same_bytes_at_any_size(spark, tmp_path, count, compress):
    frame = table(spark, count)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_table(tmp_path / "t", frame, ["n"], ["#name", "gap", "n"], compress)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    rows = sorted((r["n"], r["#name"], r["gap"]) for r in frame.collect())
    expected = "#name\tgap\tn\n" + "".join(f"{b}\t{'' if c is None else c}\t{a}\n" for a, b, c in rows)
    assert content(tmp_path / "t") == expected
    assert [r.line for r in text.read_lines(spark, tmp_path / "t").orderBy("ord").collect()] == expected.splitlines()
    if count == 300_000:
        assert len(list((tmp_path / "t").glob("part-*"))) > 1
    sinks.write_table(tmp_path / "t", frame.limit(1), ["n"], ["n"], header=False)
    assert len(content(tmp_path / "t").splitlines()) == min(count, 1)


def test_a_failed_write_leaves_what_was_there(spark, tmp_path):
    sinks.write_table(tmp_path / "t", table(spark, 3), ["n"], ["n"])
    before = content(tmp_path / "t")
    with pytest.raises(Exception):
        sinks.write_table(tmp_path / "t", table(spark, 9).selectExpr("raise_error('no') AS n"), ["n"], ["n"])
    assert content(tmp_path / "t") == before


@pytest.fixture
def uris(spark, tmp_path):
    """The folder by three spellings; the second has an authority that only Hadoop knows."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    name = f"shared{abs(hash(tmp_path))}"  # file systems are cached by authority
    conf.set(f"fs.viewfs.mounttable.{name}.link./data", f"file://{tmp_path}")
    return [f"file://{tmp_path}", f"viewfs://{name}/data", str(tmp_path)]


def test_documents_by_uri(spark, tmp_path, uris):
    for i, root in enumerate(uris):
        files.write_text(f"{root}/d{i}.txt", f"é {i}\n")
        files.write_text(f"{root}/d{i}.txt", f"é {i}!\n")
        assert files.read_text(f"{root}/d{i}.txt") == f"é {i}!\n"
        assert (tmp_path / f"d{i}.txt").read_text() == f"é {i}!\n"
        sinks.write_table(f"{root}/t{i}", table(spark, 5), ["n"], ["n"])
        assert tables.read_samples(spark, f"{root}/t{i}").count() == 6
    assert not [p for p in tmp_path.iterdir() if p.name.startswith("_")]
    with pytest.raises(ValueError, match="unable to read"):
        files.read_text(f"{uris[1]}/absent")


def test_commands_take_uris(spark, tmp_path, uris):
    (tmp_path / "genes.gtf").write_text(
        'c\tx\tgene\t1\t2\t.\t+\t.\tgene_id "ENSG2.1"; gene_type "protein_coding";\n')
    (tmp_path / "pcs.tsv").write_text("ID\tPC1\tPC2\tPC3\tPC4\nA\t1\t2\t3\t4\n")
    for i, root in enumerate(uris):
        assert cli.main(["prepare-protein-coding-genes", "--gtf", f"{root}/genes.gtf", "--genes-output",
                         f"{root}/genes{i}", "--qc-output", f"{root}/qc{i}.json"], spark) == 0
        assert content(tmp_path / f"genes{i}") == "gene_id\nENSG2\n"
        assert json.loads((tmp_path / f"qc{i}.json").read_text())["total_lines"] == 1
        lof_pc.write_pc_chunks(spark, f"{root}/pcs.tsv", [0, 1, 2], 2, f"{root}/chunks{i}.json")
        assert json.loads((tmp_path / f"chunks{i}.json").read_text()) == [[0, 1], [2]]


def test_annotation_schema_by_uri(spark, tmp_path, uris):
    header = "chrom\tpos\tref\talt\tgene_id\tconsequence\tgvs_max_af"
    (tmp_path / "vat.tsv").write_text(f"{header}\nchr1\t5\tA\tC\tENSG1\tstop_gained\t0.1\n")
    schema = rare_variant.prepare_vat(spark, f"{uris[1]}/vat.tsv", ["chr1"], f"{uris[1]}/schema.json")
    assert schema.header == tuple(header.split("\t")) and (tmp_path / "schema.json").read_text() == schema.to_json()
