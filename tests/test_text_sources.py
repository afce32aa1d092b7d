"""Gzip members, headers and quoting of the text readers."""

import gzip
import zlib

import pytest

from tailfold.sources import tables, text


def bgz(path, lines, members):
    """A gzip file under a name that Spark does not know, in so many members."""
    step = -(-len(lines) // members)
    path.write_bytes(b"".join(
        gzip.compress("".join(f"{x}\n" for x in lines[i:i + step]).encode(), 1)
        for i in range(0, len(lines), step)))
    return path


@pytest.mark.parametrize("members", [1, 2, 50, 1000])
def test_gzip_of_any_number_of_members_is_read_whole(spark, tmp_path, members):
    lines = [f"row {i} {i * 7919 % 104729}" for i in range(20_000)]
    path = bgz(tmp_path / "x.bgz", lines, members)
    got = [r.line for r in text.read_lines(spark, path).orderBy("ord").collect()]
    assert got == lines


def test_large_member_then_small_ones_and_padding(spark, tmp_path):
    first = "".join(f"{i:07d}" for i in range(900_000))
    path = tmp_path / "x.bgz"
    path.write_bytes(gzip.compress(f"{first}\nb\n".encode(), 0) + gzip.compress(b"c\n")
                     + gzip.compress(b"") + gzip.compress(b"d") + b"\0" * 40)
    got = [r.line for r in text.read_lines(spark, path).orderBy("ord").collect()]
    assert got == [first, "b", "c", "d"]


def test_pieces_agree_with_whole_decompression_at_any_piece_size():
    members = [bytes([65 + i % 26]) * (i * 37 % 900) for i in range(60)]
    data = b"".join(gzip.compress(m) for m in members)
    for size in (1, 7, 100, 1 << 20):
        assert b"".join(text._pieces(memoryview(data), size)) == b"".join(members)


@pytest.mark.parametrize("cut", [0.5, 0.999])
def test_cut_gzip_is_an_error(spark, tmp_path, cut):
    path = bgz(tmp_path / "x.bgz", [f"{i} {zlib.crc32(b'%d' % i)}" for i in range(50_000)], 3)
    path.write_bytes(path.read_bytes()[:int(path.stat().st_size * cut)])
    with pytest.raises(Exception, match="ends inside a member"):
        text.read_lines(spark, path).count()


def test_header_that_comes_again_is_an_error(spark, tmp_path):
    path = tmp_path / "pcs.tsv"
    path.write_text("ID\tPC1\nA\t1\nID\tPC1\nB\t2\n")
    with pytest.raises(ValueError, match="line 3 has the header again"):
        tables.read_pcs(spark, path)
    path.write_text("ID\tPC1\nA\t1\nB\t2\n")
    assert tables.read_pcs(spark, path).sample_count == 2


def test_every_file_of_a_folder_has_its_header(spark, tmp_path):
    folder = tmp_path / "genes"
    folder.mkdir()
    (folder / "a.tsv").write_text("gene_id\nG1\n")
    (folder / "b.tsv").write_text("gene_id\nG2\nG3\n")
    assert tables.read_coding_genes(spark, folder)[1] == 3


def test_long_quoted_field(spark, tmp_path):
    path = tmp_path / "carriers.tsv"
    header = "sample_id\tgene_id\tgene_symbol\thas_lof_variant\tn_lof_variants\tvariant_ids\tlof_classes"
    long = '"' + 'v""x,' * 200_000 + '"'
    path.write_text(f"{header}\nS\tG\tg\ttrue\t1\t{long}\t\"HC\"\n")
    table, rows, truthy = tables.read_lof_carriers(spark, path)
    assert (rows, truthy) == (1, 1)
    assert table.first().lof_classes == "HC"
