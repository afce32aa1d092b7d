"""Joins against lists of ids: broadcast behind a check of the list's size, else shuffled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of up to three numbers; some 50 MB as a hash table.
BROADCAST_ROWS = 1_000_000


def checked(rows: DataFrame) -> DataFrame:
    """``rows`` of a few numbers each, marked for broadcast if they are BROADCAST_ROWS at most.

    ``rows`` should be staged: counting reads it.
    """
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows
