"""A stored dictionary: strings get dense numbers once and keep them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bibweave.plans.numbers import numbered
from bibweave.plans.scratch import discard, materialize
from bibweave.plans.stored import BROADCAST_ROWS, Loads


class Dictionary:
    """Strings and their numbers from 1 on, in a folder.

    Every load adds the strings that are not there yet, numbered in their order behind all earlier ones, so numbers are
    dense, unique and never change. A load that fails leaves the dictionary as it was.
    """

    def __init__(self, spark: SparkSession, path: str, value: str = "str", number: str = "str_id"):
        self.value, self.number = value, number
        self.loads = Loads(spark, path, f"`{value}` string, `{number}` long")

    def entries(self) -> DataFrame:
        """``value, number, load``."""
        return self.loads.read()

    def insert(self, values: DataFrame, load: int | None = None) -> int:
        """Add the strings of column ``value`` that are new and return how many were; nulls are none.

        ``load`` numbers the load; one that was made before adds nothing again.
        """
        done = self.loads.numbers()
        load = max(done, default=-1) + 1 if load is None else load
        if load in done:
            return 0
        asked = materialize(values.select(self.value).where(F.col(self.value).isNotNull()).distinct(), "asked")
        # the table only grows, so its many rows are met by the load's, not the other way round
        held = self.entries()
        few = asked.count() <= BROADCAST_ROWS
        known = held.join(F.broadcast(asked) if few else asked, self.value, "left_semi").select(self.value)
        new = materialize(asked.join(known, self.value, "left_anti"), "new")
        count = new.count()
        top = held.agg(F.max(self.number)).first()[0] or 0
        rows = numbered(new, self.value, name=self.number, start=top + 1)
        self.loads.write(rows, load)
        discard(asked, new)
        return count

    def encode(self, df: DataFrame) -> DataFrame:
        """``df`` with the number of its strings; null where there is none."""
        return df.join(self.entries().drop("load"), self.value, "left")

    def decode(self, df: DataFrame) -> DataFrame:
        """``df`` with the strings of its numbers; null where there is none."""
        return df.join(self.entries().drop("load"), self.number, "left")
