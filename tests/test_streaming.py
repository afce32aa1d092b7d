import pytest

from tailfold import vocab
from tailfold.streaming.minima import arriving_minima, gathered_minima


def test_minima_follow_arriving_files(spark, tmp_path):
    folder = tmp_path / "arriving"
    folder.mkdir()
    header = "\t".join(vocab.MINIMA_COLUMNS)
    key = "S{}\tG1\tAC=1\tbaseline\tall_rare_variants\t{}"
    for i, rows in enumerate([[(1, 9), (2, 5)], [(1, 4)], [(1, 9), (2, 7)]]):
        body = "\n".join([header, *[key.format(*r) for r in rows]]) + "\n"
        (folder / f"{i}.tsv").write_text(body)
    query = (
        gathered_minima(arriving_minima(spark, folder, files_per_trigger=1))
        .writeStream.outputMode("complete").format("memory").queryName("minima")
        .option("checkpointLocation", str(tmp_path / "state")).start())
    query.processAllAvailable()
    query.stop()
    got = {r.sample_id: r.minimum_distance_bp for r in spark.table("minima").collect()}
    assert got == {"S1": 4, "S2": 5}


@pytest.mark.parametrize("row,problem", [
    ("S1\tG1\tAC=1\tbaseline\tx\tfar", "non-negative integer"),
    ("S1\tG1\tAC=1\tbaseline\tx", "not six columns"),
    ("S1\t\tAC=1\tbaseline\tx\t1", "empty key fields"),
])
def test_malformed_row_ends_the_stream(spark, tmp_path, row, problem):
    folder = tmp_path / "arriving"
    folder.mkdir()
    (folder / "0.tsv").write_text("\t".join(vocab.MINIMA_COLUMNS) + "\n" + row + "\n")
    query = (
        gathered_minima(arriving_minima(spark, folder)).writeStream.outputMode("complete")
        .format("memory").queryName("broken").option("checkpointLocation", str(tmp_path / "s")).start())
    with pytest.raises(Exception, match=problem):
        query.processAllAvailable()
