"""Quoted records over line breaks and splits, against the csv module."""

import csv
import io
import random

import pytest

from tailfold.sources import quoting, tables, text


def random_text(rng, count):
    out = []
    for _ in range(count):
        cells = []
        for _ in range(rng.randrange(1, 4)):
            kind = rng.randrange(8)
            plain = "".join(rng.choice("ab é") for _ in range(rng.randrange(6)))
            if kind == 0:
                cells.append('"' + "".join(rng.choice(["x", "\n", '""', "\t", " "]) for _ in range(rng.randrange(9))) + '"')
            elif kind == 1:
                cells.append(plain + 'q"' + plain)  # a quote inside opens nothing
            elif kind == 2:
                cells.append(f'"{plain}"')
            else:
                cells.append(plain or "z")
        out.append("\t".join(cells))
    return "\n".join(out) + "\n"


def test_open_after_agrees_with_csv():
    rng = random.Random(2)
    for _ in range(4000):
        line = "".join(rng.choice('a"\t') for _ in range(rng.randrange(9)))
        for inside in (False, True):
            start = '"' if inside else ""
            # if the field is still open, the reader takes the next line into the same record
            rows = list(csv.reader(io.StringIO(f"{start}{line}\nnext\n"), delimiter="\t"))
            assert quoting.open_after(line, inside) == (len(rows) == 1), (line, inside)


@pytest.mark.parametrize("seed, split", [(1, 1 << 20), (2, 60), (3, 17), (4, 200)])
def test_records_over_lines_and_splits(spark, tmp_path, seed, split):
    body = random_text(random.Random(seed), 150)
    if seed == 2:
        body += '"' + "\n".join("far" for _ in range(60)) + '"\tend\n'  # over many splits
    if seed == 4:
        body += 'a\t"never closed\n\nlast\n'
    (tmp_path / "t").write_text(body)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        records = quoting.joined_records(text.read_lines(spark, tmp_path / "t")).orderBy("ord").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    got = [next(csv.reader(io.StringIO(r.line), delimiter="\t"), []) for r in records]
    expected = list(csv.reader(io.StringIO(body), delimiter="\t"))
    if seed == 4:
        expected[-1][-1] = expected[-1][-1].removesuffix("\n")
    assert got == expected and len(expected) < body.count("\n")


def test_files_without_open_quotes_are_left_alone(spark, tmp_path):
    (tmp_path / "t").write_text('a\t"b"\nc"\td\n')
    lines = text.read_lines(spark, tmp_path / "t")
    assert quoting.joined_records(lines) is lines


def test_carrier_table_with_line_breaks(spark, tmp_path):
    header = "sample_id\tgene_id\tgene_symbol\thas_lof_variant\tn_lof_variants\tvariant_ids\tlof_classes"
    (tmp_path / "t").write_text(
        f'{header}\nS1\tG1\t"two\n\nlines ""x"""\ttrue\t1\tv\tHC\nS2\tG2\tg\tno\t1\t"v\n{header}\n"\t"LC\nHC"\n')
    table, rows, truthy = tables.read_lof_carriers(spark, tmp_path / "t")
    assert (rows, truthy) == (2, 1)
    assert {(r.sample_id, r.gene_id, r.lof_classes) for r in table.collect()} == {("S1", "G1", "HC"), ("S2", "G2", "LC\nHC")}
