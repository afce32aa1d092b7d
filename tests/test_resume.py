"""Sweeps that break and go on, and the log lines of long steps."""

import json
import logging
import time

import numpy as np
import pytest

from tailfold import progress
from tailfold.plans import lof_pc
from tests.outputs import content

NAMES = ("results_output", "summary_output", "gene_pc_qc_output", "analysis_qc_output")
OPTIONS = {"negative_z_thresholds": [-1.0, -1.5], "pc_counts": [0, 1, 2, 4], "pc_counts_per_job": 2}


@pytest.fixture
def cohort(tmp_path):
    rng = np.random.default_rng(8)
    samples = [f"S{i:02d}" for i in range(14)]
    (tmp_path / "bed").write_text("#chr\tstart\tend\tid\t" + "\t".join(samples) + "\n" + "".join(
        f"chr1\t{g}\t{g + 1}\tENSG{g}.1\t" + "\t".join(
            "NA" if rng.random() < 0.05 else f"{v:.4f}" for v in rng.normal(size=14)) + "\n" for g in range(1, 31)))
    (tmp_path / "carriers").write_text(
        "sample_id\tgene_id\tgene_symbol\thas_lof_variant\tn_lof_variants\tvariant_ids\tlof_classes\n" + "".join(
            f"S{i % 14:02d}\tENSG{1 + i * 7 % 30}\tg\ttrue\t1\tv\tHC\n" for i in range(40)))
    (tmp_path / "pcs").write_text("ID\t" + "\t".join(f"PC{i}" for i in range(1, 7)) + "\n" + "".join(
        s + "\t" + "\t".join(f"{v:.5f}" for v in rng.normal(size=6)) + "\n" for s in samples))
    (tmp_path / "genes").write_text("gene_id\n" + "".join(f"ENSG{g}\n" for g in range(1, 28)))
    return {"phenotype_bed": tmp_path / "bed", "lof_carriers": tmp_path / "carriers",
            "principal_components": tmp_path / "pcs", "protein_coding_genes": tmp_path / "genes"}


def run(spark, cohort, folder, **options):
    folder.mkdir()
    out = {n: folder / n for n in NAMES}
    lof_pc.run(spark, **cohort, **{**OPTIONS, **options}, **out)
    return [content(p) for p in out.values()]


def test_a_broken_sweep_goes_on(spark, tmp_path, cohort, monkeypatch, caplog):
    whole = run(spark, cohort, tmp_path / "whole", work_folder=tmp_path / "work-whole")
    made, original = [], lof_pc.gene_table

    def breaking(flagged, design, fixed, pc_counts, *rest, **more):
        made.append(list(pc_counts))
        if pc_counts == [2, 4] and len(made) == 2:
            raise RuntimeError("broken")
        return original(flagged, design, fixed, pc_counts, *rest, **more)

    monkeypatch.setattr(lof_pc, "gene_table", breaking)
    with pytest.raises(RuntimeError, match="broken"):
        run(spark, cohort, tmp_path / "first", work_folder=tmp_path / "work")
    assert not any((tmp_path / "first").iterdir())
    assert json.loads((tmp_path / "work" / "manifest.json").read_text())["pc_counts"] == [0, 1]
    # a batch that was begun and not finished is written again
    spark.read.parquet(str(tmp_path / "work" / "genes")).where("pc_count = 1").selectExpr(
        "* EXCEPT (pc_count)", "2 AS pc_count").write.partitionBy("pc_count").mode("append").parquet(
        str(tmp_path / "work" / "genes"))
    with caplog.at_level(logging.INFO, "tailfold.plans.lof_pc"):
        again = run(spark, cohort, tmp_path / "second", work_folder=tmp_path / "work")
    assert again == whole and made == [[0, 1], [2, 4], [2, 4]]
    said = [r.getMessage() for r in caplog.records]
    assert "PC counts [0, 1] were finished before" in said
    done = [i for i, m in enumerate(said) if m.startswith("Completed PC count")]
    assert len(done) == 2 and max(done) < next(i for i, m in enumerate(said) if m.startswith("Wrote"))
    assert run(spark, cohort, tmp_path / "third", work_folder=tmp_path / "work") == whole and len(made) == 3


def test_batches_agree_with_one_sweep(spark, tmp_path, cohort):
    batches = run(spark, cohort, tmp_path / "a")
    whole = run(spark, cohort, tmp_path / "b", pc_counts_per_job=None)
    for one, other in zip(batches[:1] + batches[2:3], whole[:1] + whole[2:3]):
        for x, y in zip(one.splitlines()[1:], other.splitlines()[1:], strict=True):
            for p, q in zip(x.split("\t"), y.split("\t"), strict=True):
                assert p == q or abs(float(p) - float(q)) < 1e-9
    assert json.loads(batches[3]) == json.loads(whole[3])


def test_another_analysis_is_refused(spark, tmp_path, cohort):
    run(spark, cohort, tmp_path / "a", work_folder=tmp_path / "work", pc_counts=[0, 1])
    with pytest.raises(ValueError, match="another analysis"):
        run(spark, cohort, tmp_path / "b", work_folder=tmp_path / "work", pc_counts=[0, 2])
    with cohort["lof_carriers"].open("a") as handle:
        handle.write("S01\tENSG3\tg\ttrue\t1\tv\tLC\n")
    with pytest.raises(ValueError, match="another analysis"):
        run(spark, cohort, tmp_path / "c", work_folder=tmp_path / "work", pc_counts=[0, 1])


def test_progress_is_logged_while_a_step_runs(spark, caplog):
    def slow(batches):
        for batch in batches:
            time.sleep(0.25)
            yield batch

    with caplog.at_level(logging.INFO, "tailfold.progress"):
        with progress.reported(spark, "Rows", 1000, 500, seconds=0.05):
            spark.range(24, numPartitions=24).mapInArrow(slow, "id long").count()
            while_running = len(caplog.records)
    assert while_running >= 1
    assert {r.getMessage() for r in caplog.records} <= {"Rows: about 500 of 1000", "Rows: about 1000 of 1000"}
    assert spark.sparkContext.getLocalProperty("spark.jobGroup.id") is None
