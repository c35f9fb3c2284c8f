"""Rows dealt over as many tasks as their number calls for."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Rows of a task that makes much more of each than it reads, and of one that sorts them or gathers them in a table of its own.
ROWS_A_TASK, ROWS_A_SORT = 20_000, 400_000


def spread(df: DataFrame, *keys: str, rows: int = ROWS_A_TASK) -> DataFrame:
    """``df`` in parts of some ``rows`` by the hash of ``keys``, which few rows should share.

    A small columnar file is read by one task however many rows it holds, and where they grow from there on (to records, texts or
    pairs) all of that would be this task's work.
    """
    return df.repartition(max(1, -(-df.count() // rows)), *keys)


def dealt(df: DataFrame, most: int, *keys: str, rows: int = ROWS_A_SORT) -> DataFrame:
    """``df``, of ``most`` rows at most, in parts of some ``rows`` by the hash of ``keys``, for an operator that holds a part of it.

    The parts of other exchanges grow with the table where their number is fixed, and neighbours are merged up to a size in bytes as
    they are written, which is many times as much in memory where rows repeat each other.
    """
    return df.repartition(max(1, -(-most // rows)), *keys)


def ranged(df: DataFrame, most: int, *keys: str, rows: int = ROWS_A_SORT) -> DataFrame:
    """``df``, of ``most`` rows at most, sorted by ``keys`` within parts of some ``rows`` that follow each other."""
    return df.repartitionByRange(max(1, -(-most // rows)), *keys).sortWithinPartitions(*keys)
