"""Rows dealt to tasks by how many there are."""

from __future__ import annotations

from pyspark.sql import DataFrame


def dealt(rows: DataFrame, most: int, *by: str) -> DataFrame:
    """The rows, dealt by the columns `by` to tasks of about `most` rows each, but to no fewer tasks than the session has cores.

    The number of tasks grows with the rows and adaptive execution does not merge them, so what a task holds stays the same. Sums by `by` and
    further columns need no other shuffle. Counting a stored table reads its files' footers.
    """
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // most))
    return rows.repartition(tasks, *by)
