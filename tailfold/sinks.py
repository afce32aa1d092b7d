"""Outputs on any Hadoop file system: small documents, bounded grids, and tables of any size."""

from __future__ import annotations

import json
import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tailfold import files
from tailfold.session import release

#: Lines of a compressed part file at most.
GZIP_LINES = 250_000


def write_json(path, payload) -> None:
    files.write_text(path, json.dumps(payload, indent=2, sort_keys=True) + "\n")


def cell_text(value) -> str:
    """Shortest round-trip text of a value; undefined statistics print NA."""
    if value is None or (isinstance(value, float) and not math.isfinite(value)):
        return "NA"
    return str(value)


def write_grid(path, rows: DataFrame, columns, order: list[str]) -> list:
    """Write a result grid, whose size the parameters bound, as one ordered TSV."""
    collected = rows.orderBy(*order).collect()
    lines = ["\t".join(columns)]
    lines += ["\t".join(cell_text(row[c]) for c in columns) for row in collected]
    files.write_text(path, "\n".join(lines) + "\n")
    return collected


@F.pandas_udf(T.StringType())
def double_text(values: pd.Series) -> pd.Series:
    """``cell_text`` for columns written by executors (Spark prints 1.0E-5)."""
    return values.map(lambda v: cell_text(float(v)))


def write_table(path, rows: DataFrame, order: list[str], columns, compress: bool = False,
                header: bool = True, bounds=()) -> None:
    """Write a table that grows with the data: a folder of sorted part files, whatever its size.

    Executors write the parts; put one after another in the order of their names they are the table,
    with one header, which sorts before all rows.  The folder takes its place when all of it is written.
    ``bounds``, rising values of the first column of ``order``, cut the rows into slices that are sorted
    one after another, so that the shuffle files of one slice are on disk at a time.
    """
    # lines are put together after the sort, so that a cell moves once and not again in its line
    spark = rows.sparkSession
    moved = list(dict.fromkeys([*order, *columns]))
    at = {c: f"_cell{i}" for i, c in enumerate(moved)}
    line = F.concat_ws("\t", *[F.coalesce(F.col(at[c]).cast("string"), F.lit("")) for c in columns])
    if header:
        top = spark.createDataFrame([(0,)], "_place int")
        line = F.when(F.col("_place") == 0, F.lit("\t".join(columns))).otherwise(line)
    draft = files.draft_of(path)
    # a gzip file is one task to its readers
    settings = {"compression": "gzip", "maxRecordsPerFile": GZIP_LINES} if compress else {"compression": "none"}
    for i, own in enumerate(_slices(rows, order[0], bounds) if bounds else [rows]):
        cells = own.select(F.lit(1).alias("_place"), *[F.col(c).alias(n) for c, n in at.items()])
        if header and i == 0:
            cells = cells.unionByName(top, allowMissingColumns=True)
        written = files.draft_of(path) if bounds else draft
        cells.orderBy("_place", *[at[c] for c in order]).select(line.alias("value")).write.options(
            **settings).text(written)
        if bounds:
            del own, cells
            files.move_parts(written, draft, f"part-{i:05d}-")
            release(spark)
    files.replace(draft, path)


def _slices(rows: DataFrame, column: str, bounds):
    """Rows up to the first bound, from each bound to the next one, and from the last one on."""
    at = F.col(column)
    yield rows.where(at.isNull() | (at < bounds[0]))
    for low, high in zip(bounds, [*bounds[1:], None]):
        yield rows.where((at >= low) if high is None else (at >= low) & (at < high))
