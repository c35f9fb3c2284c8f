"""Dense numbers for the rows of a frame, without a window over all of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bibweave.plans.scratch import materialize

_PLACE = (1 << 33) - 1


def numbered(df: DataFrame, *order: str, name: str = "number", start: int = 0) -> DataFrame:
    """``df`` with a column ``name``: ``start``, ``start + 1`` and so on in the order of some columns.

    Rows are dealt into sorted ranges and written with their place there; the sizes of the ranges before a row's own, one
    number for each range, make the rest. Rows equal in ``order`` get their numbers in an order that the run fixes, nulls come first, and
    an empty frame gives none.
    """
    at = "place"
    while at.lower() in {c.lower() for c in df.columns}:
        at += "_"
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(at, F.monotonically_increasing_id())
    dealt = materialize(dealt, "numbered")
    part = F.shiftright(at, 33)
    before, total = [], start
    for p, n in sorted(dealt.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()):
        before.append((p, total))
        total += n
    offsets = df.sparkSession.createDataFrame(before, "of_part long, offset long")
    out = dealt.join(F.broadcast(offsets), part == F.col("of_part"))
    return out.select(*(F.col(f"`{c}`") for c in df.columns), (F.col("offset") + F.col(at).bitwiseAND(F.lit(_PLACE))).alias(name))
