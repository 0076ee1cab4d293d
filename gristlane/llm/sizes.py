"""Broadcasts behind a check of size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: rows that are sent to every executor at most; a larger side is joined by a shuffle
ROWS = 1_000_000


def small(table: DataFrame, rows: int = ROWS, weight: str | None = None) -> DataFrame:
    """table (a written one, so that counting is cheap) marked for broadcast if it has no more than so many rows.

    ``weight``: an expression for the rows that a row counts as, for tables with arrays.
    """
    if weight is None:
        size = table.limit(rows + 1).count()
    else:
        size = table.agg(F.sum(F.expr(weight))).first()[0] or 0
    return F.broadcast(table) if size <= rows else table
