"""Steps that parse, move or hold the same cells no more often than needed, on rows made here."""

import itertools
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tailfold import sinks, vocab
from tailfold.functions import values as V
from tailfold.llm import quality
from tailfold.plans import queries
from tailfold.sources import quoting, tables, text


def plan_of(frame, part="optimizedPlan"):
    return getattr(frame._jdf.queryExecution(), part)().toString()


def test_pooling_holds_few_vectors_at_a_time(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, function, schema: function)
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(quality.BUCKETS, quality.WIDTH)).astype(np.float32)
    pooled = quality.pooled(docs, vectors)
    words = ["w%d" % i for i in range(500)]
    texts = [" ".join(rng.choice(words, 200)) for _ in range(2000)] + ["", None, "one"]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], ["id", "text"])

    def run():
        return {i: f for part in pooled(iter([batch])) for i, f in zip(*(c.to_pylist() for c in part.columns))}

    run()  # tables that stay
    tracemalloc.start()
    got = run()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(got) == len(texts) and peak < 40e6
    monkeypatch.setattr(quality, "SLICE_BYTES", 1 << 21)
    assert run() == got


def test_violations_parse_a_line_once(spark, tmp_path, monkeypatch):
    rows = [("s1", "f1", "AC=1", "baseline", "all", "5"), ("s2", "f1", "AC=1", "baseline", "all", "0")]

    def write(*more):
        lines = ["\t".join(vocab.MINIMA_COLUMNS), *("\t".join(r) for r in rows), *more]
        (tmp_path / "t").write_text("\n".join(lines) + "\n")
        return tmp_path / "t"

    plans, kind = [], type(spark.range(1))
    agg = kind.agg
    monkeypatch.setattr(kind, "agg", lambda self, *a: plans.append(agg(self, *a)) or plans[-1])
    got = tables.read_minima(spark, write())
    assert sorted(map(tuple, got.collect())) == [(*r[:5], int(r[5])) for r in rows]
    parsed = [p for p in map(plan_of, plans) if "split(" in p]
    assert len(parsed) == 1 and parsed[0].count("split(") == 1
    for line, said in ((" \t\t\t\t\t ", "no content"), ("a\tb", "not six columns"),
                       ("s\t\ta\tb\tc\t4", "empty key fields"), ("s\tf\ta\tb\tc\t-1", "non-negative integer"),
                       ("s\tf\ta\tb\tc\tx", "non-negative integer")):
        with pytest.raises(ValueError, match=f"line 4 has .*{said}"):
            tables.read_minima(spark, write(line, "z"))


def test_a_cell_is_sorted_once(spark, tmp_path, monkeypatch):
    frame = spark.createDataFrame(
        [("b", 2, None), ("a", 10, 1.5), ("a", 9, 2.0), (None, 3, 0.1)], "k string, n int, v double")
    sorted_columns, kind = [], type(frame)
    order_by = kind.orderBy
    monkeypatch.setattr(kind, "orderBy", lambda self, *a: sorted_columns.append(self.columns) or order_by(self, *a))
    sinks.write_table(tmp_path / "t", frame, ["k", "n"], ["k", "v", "k"])
    assert len(sorted_columns[0]) == 1 + len(frame.columns)
    monkeypatch.undo()
    lines = text.read_lines(spark, tmp_path / "t").orderBy("ord").collect()
    assert [r.line for r in lines] == ["k\tv\tk", "\t0.1\t", "a\t2.0\ta", "a\t1.5\ta", "b\t\tb"]


def test_genes_of_a_bed_meet_once(spark, tmp_path):
    lines = [(i % 5 + 1 if i % 11 else None, i % 3 + 1, i % 4, 10.0 + i, i / 50 if i % 6 else 0.0,
              None if i % 7 == 0 or i % 5 == 4 else 0.01 * i) for i in range(60)]
    spark.createDataFrame(
        lines, "l_partkey long, l_linenumber int, l_suppkey long, l_quantity double, "
        "l_discount double, l_tax double").withColumn("l_extendedprice", F.col("l_quantity") * 2).write.parquet(
        str(tmp_path / "lineitem.parquet"))
    found = queries.phenotype_bed_long(spark, str(tmp_path))
    keys = re.findall(r"keys=\[([^\]]*)\]", found._jdf.queryExecution().executedPlan().toString())
    assert keys and not [k for k in keys if "sample_id" in k and "gene_id" in k]
    bed = queries.S.bed(spark, str(tmp_path))
    long = bed.long(bed.rows.withColumn("gene_id", V.single_gene(F.col("feature"))), bed.sample_table())
    want = long.groupBy("sample_id", "chrom").agg(
        F.count(F.lit(1)), F.count("value"), F.count_if("bad"), F.count_distinct("gene_id"), F.min("value"), F.max("value"))
    got = sorted(map(tuple, found.collect()))
    assert got == sorted(map(tuple, want.collect())) and len({row[5] for row in got}) > 1


def test_single_genes(spark):
    cases = {"ENSG1": "ENSG1", "P7_ENSG00012.4": "ENSG00012", " ENSG5.1  ": "ENSG5", "xENSG5": None, "ENSG": None,
             "ENSG1|ENSG2": None, "ENSG1|ENSGx": "ENSG1", "aENSG1|ENSG2.3": "ENSG2", "ENSG1ENSG2": "ENSG1",
             "": None, None: None, "gene": None, "ENSG1 ENSG2 ENSG3": None}
    rows = spark.createDataFrame([(c,) for c in cases], "c string").select("c", V.single_gene(F.col("c")).alias("g"))
    assert {r.c: r.g for r in rows.collect()} == cases
    assert "lambda" not in plan_of(rows)


def test_closed_lines(spark):
    lines = ["".join(p) for n in range(8) for p in itertools.product('"\ta', repeat=n)]
    lines += ['"a\nb"\tc', '"a\nb', "\r", 'x"\t"y"z\t"', "\t".join(['"a ""b"" c"'] * 5000)]
    frame = spark.createDataFrame([(x,) for x in lines], "line string")
    got = {r.line: r.closed for r in frame.select("line", F.col("line").rlike(quoting.CLOSED).alias("closed")).collect()}
    assert got == {x: not quoting.open_after(x) for x in lines}


def test_quoted_carriers_are_parsed_once(spark, tmp_path):
    header = "\t".join(vocab.LOF_CARRIER_COLUMNS)
    at = vocab.LOF_CARRIER_COLUMNS.index

    def line(**cells):
        row = ["x"] * len(vocab.LOF_CARRIER_COLUMNS)
        for name, value in cells.items():
            row[at(name)] = value
        return "\t".join(row)

    rows = [line(sample_id=' "s', gene_id='"g ""1"" .7"', has_lof_variant='" Yes"', lof_classes='"HC,\nLC"'),
            line(sample_id="s2", gene_id="ENSG1.2", has_lof_variant="0", lof_classes='""'),
            line(sample_id="s3", gene_id="g", has_lof_variant="1", lof_classes="HC")]
    (tmp_path / "t").write_text("\n".join([header, *rows]) + "\n")
    carriers, count, truthy = tables.read_lof_carriers(spark, tmp_path / "t")
    assert "regexp_extract_all" not in plan_of(carriers) and (count, truthy) == (3, 2)
    assert sorted(map(tuple, carriers.collect())) == [
        ('"s', 'g "1" ', True, "HC,\nLC"), ("s2", "ENSG1", False, ""), ("s3", "g", True, "HC")]
    (tmp_path / "t").write_text("\n".join([header, rows[1], rows[2].replace("1\t", "maybe\t", 1)]) + "\n")
    with pytest.raises(ValueError, match="line 3 has an invalid has_lof_variant"):
        tables.read_lof_carriers(spark, tmp_path / "t")
