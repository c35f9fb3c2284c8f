"""Joins of documents with tables of ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bibweave.plans.scratch import materialize

#: Rows of a table of ids that may be broadcast (16 MB of ids).
BROADCAST_ROWS = 1 << 21


def bounded_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a written table if it has at most ``rows`` rows, else leave the join to Spark."""
    return F.broadcast(df) if df.count() <= rows else df


def without(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` without the rows whose id is in the one column of ``ids``; rows with a null id stay."""
    name = "bad"
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    bad = materialize(ids.toDF(name).distinct(), "rejected")
    return docs.join(bounded_broadcast(bad), F.col(id_col) == F.col(name), "left_anti")
