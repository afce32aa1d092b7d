"""Quoted tab-separated records that go on over line breaks, on files of many splits.

A line either leaves a quoted field open or not, and that depends on whether it began inside one: a map
from two states to two states.  Every split composes the maps of its lines; the maps of the splits, one
row each, are followed in file order; then each split is read from its known state.  Records that cross
splits are put together from their pieces.  Files without such lines, nearly all, are left as they are
after one look at the lines that hold a quote.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tailfold.session import stage

_WHOLE, _HEAD, _THROUGH, _TAIL = range(4)
_KEY = "file_path string, block bigint"


def open_after(line: str, inside: bool = False) -> bool:
    """Whether a quoted field is open at the end of a line that began inside one or not.

    A quote opens a field only as its first character; a doubled quote inside stands for one.
    """
    at = 0
    while True:
        if not inside:
            inside = line.startswith('"', at)
            at += inside
        if inside:
            at = line.find('"', at)
            if at < 0:
                return True
            at += 1
            if line.startswith('"', at):
                at += 1
                continue
            inside = False
        at = line.find("\t", at) + 1
        if not at:
            return False


# fixed value: a line whose quoted fields are all closed, as ``open_after`` reads it; no step backtracks
_FIELD = r'(?:"[^"]*+(?:""[^"]*+)*+"[^\t]*+|(?!")[^\t]*+)'
CLOSED = rf"\A{_FIELD}(?:\t{_FIELD})*+\z"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows of one split after another, a batch at a time: ``(file, block), rows``."""
    for batch in batches:
        key, rows = None, []
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[:2] != key and rows:
                yield key, rows
                rows = []
            key = row[:2]
            rows.append(row)
        if rows:
            yield key, rows


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def emit(key, ends):
        return pa.RecordBatch.from_arrays(
            [pa.array([key[0]], pa.string()), pa.array([key[1]], pa.int64()),
             pa.array([ends[0]], pa.bool_()), pa.array([ends[1]], pa.bool_())],
            ["file_path", "block", "from_outside", "from_inside"])

    at, ends = None, (False, True)
    for key, rows in _runs(batches):
        if at is not None and key != at:
            yield emit(at, ends)
            ends = (False, True)
        at = key
        for _, _, _, line in rows:
            ends = tuple(open_after(line, inside) if inside or '"' in line else False for inside in ends)
    if at is not None:
        yield emit(at, ends)


def _pieced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole records, and the pieces of those that cross the ends of a split."""
    def emit(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), (
                pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int32()))],
            ["file_path", "block", "n", "line", "kind"])

    def rest():
        kind = _THROUGH if begun is None else _TAIL
        return [(*at, held_n, "\n".join(held), kind)]

    at, held, held_n, begun, inside = None, [], None, None, False
    for key, rows in _runs(batches):
        done = []
        if key != at:
            if held:
                done += rest()
            at, held, held_n, begun, inside = key, [], None, None, rows[0][4]
        for _, _, n, line, _ in rows:
            if not held:
                held_n, begun = n, None if inside else n
            held.append(line)
            inside = open_after(line, inside)
            if not inside:
                done.append((*key, held_n, "\n".join(held), _HEAD if begun is None else _WHOLE))
                held = []
        if done:
            yield emit(done)
    if held:
        yield emit(rest())


def joined_records(lines: DataFrame) -> DataFrame:
    """``line, ord`` with the lines of every quoted record as one, under the place of its first line."""
    if lines.where(F.contains("line", F.lit('"')) & ~F.col("line").rlike(CLOSED)).select("line").isEmpty():
        return lines
    flat = lines.select("ord.file_path", "ord.block", "ord.n", "line")
    order = ("file_path", "block", "n")
    maps = stage(flat.repartition("file_path", "block").sortWithinPartitions(*order).mapInArrow(
        _composed, f"{_KEY}, from_outside boolean, from_inside boolean"), "quote-states")
    # a split whose end is the same from either state settles what comes after it, others pass it on
    before = Window.partitionBy("file_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    maps = maps.withColumn("_turn", (F.col("from_outside") & ~F.col("from_inside")).cast("int"))
    settled = F.col("from_outside") == F.col("from_inside")
    known = maps.withColumn("_last", F.max(F.when(settled, F.struct("block", "from_outside"))).over(before))
    since = Window.partitionBy("file_path", "_last").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    turns = F.coalesce(F.sum("_turn").over(since), F.lit(0))
    inside = F.coalesce(F.col("_last.from_outside"), F.lit(False)).cast("int") + turns
    states = known.select("file_path", "block", (inside % 2 == 1).alias("inside"))
    pieces = stage(
        flat.join(states, ["file_path", "block"]).repartition("file_path", "block")
        .sortWithinPartitions(*order).select("file_path", "block", "n", "line", "inside")
        .mapInArrow(_pieced, f"{_KEY}, n bigint, line string, kind int"), "quoted-records")
    parts = pieces.where(F.col("kind") != _WHOLE)
    upto = Window.partitionBy("file_path").orderBy("block", "kind")
    record = parts.select("file_path", "block", "kind").withColumn(
        "record", F.sum((F.col("kind") == _TAIL).cast("int")).over(upto))
    crossing = parts.join(record, ["file_path", "block", "kind"]).groupBy("file_path", "record").agg(
        F.sort_array(F.collect_list(F.struct("block", "kind", "n", "line"))).alias("p")).select(
        "file_path", F.col("p")[0]["block"].alias("block"), F.col("p")[0]["n"].alias("n"),
        F.array_join("p.line", "\n").alias("line"))
    columns = ("file_path", "block", "n", "line")
    records = pieces.where(F.col("kind") == _WHOLE).select(*columns).unionByName(crossing.select(*columns))
    return records.select("line", F.struct("file_path", "block", "n").alias("ord"))
