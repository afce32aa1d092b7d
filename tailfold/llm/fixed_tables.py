"""Counting into a table of fixed size over all rows: one array per task, summed by parts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

PART_ENTRIES = 1 << 13


def parts_of(table: np.ndarray) -> tuple[list[int], list[bytes]]:
    """The parts of a task's int32 table that hold anything."""
    numbers, data = [], []
    for part in range(-(-len(table) // PART_ENTRIES)):
        own = table[part * PART_ENTRIES:(part + 1) * PART_ENTRIES]
        if own.any():
            numbers.append(part)
            data.append(own.tobytes())
    return numbers, data


def table_sum(parts: DataFrame, entries: int) -> np.ndarray:
    """The int64 table of ``entries`` entries from rows ``part int, data binary``.

    Every part belongs to one task, which adds its rows as they come; the driver gets the table,
    whose size depends on nothing but ``entries``.
    """
    def summed(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in source:
            for part, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = np.frombuffer(data.as_py(), np.int32)
                if part in sums:
                    sums[part] += own
                else:
                    sums[part] = own.astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()),
             pa.array([s.tobytes() for s in sums.values()], pa.binary())], ["part", "data"])

    table = np.zeros(entries, np.int64)
    rows = parts.repartition("part").mapInArrow(summed, "part int, data binary").collect()
    for row in rows:
        own = np.frombuffer(row["data"], np.int64)
        table[row["part"] * PART_ENTRIES:row["part"] * PART_ENTRIES + len(own)] = own
    return table
