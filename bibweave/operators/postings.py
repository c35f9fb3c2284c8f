"""Posting lists: the records of every value, kept so that a question reads little more than its answer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bibweave.plans.scratch import discard, materialize
from bibweave.plans.spread import dealt, ranged
from bibweave.plans.stored import BROADCAST_ROWS

#: Parts of a value whose records are counted apart.
SALTS = 64


class Postings:
    """The values of an attribute table (``gd_id, attr, str``) in a folder, by attribute and a hash of the value.

    A question opens only the folders of the values that it names, and starts from the rarest of them.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 16):
        self.spark, self.path, self.buckets = spark, path, buckets

    def _bucket(self, value) -> F.Column:
        return F.pmod(F.xxhash64(value), F.lit(self.buckets)).cast("int")

    def write(self, attrs: DataFrame) -> None:
        """Keep the postings and the number of records of every value. A value of many records lies in as many files as its rows call for.

        Rows are dealt in parts of bounded size wherever they are sorted or gathered, in all as many as they call for.
        """
        given = materialize(attrs.select(F.col("gd_id").cast("long").alias("gd_id"), "attr", "str"), "attributes")
        held = materialize(dealt(given, given.count(), "gd_id").distinct(), "postings")
        discard(given)
        n = held.count()
        # dealt within a folder by range, so a hot value is many tasks' work
        rows = ranged(held.withColumn("bucket", self._bucket(F.col("str"))), n, "attr", "bucket", "str", "gd_id")
        rows.write.partitionBy("attr", "bucket").parquet(f"{self.path}/rows")
        # by salted values first, so that a hot one is not one task's work
        salted = dealt(held.select("attr", "str", F.pmod("gd_id", F.lit(SALTS)).alias("salt")), n, "attr", "str", "salt")
        parts = materialize(salted.groupBy("attr", "str", "salt").agg(F.count("*").alias("n")), "counts")
        kept = dealt(parts, parts.count(), "attr", "str").groupBy("attr", "str").agg(F.sum("n").alias("n")).withColumn("bucket", self._bucket(F.col("str")))
        kept = materialize(kept, "counts")
        discard(held, parts)
        ranged(kept, kept.count(), "attr", "bucket", "str").write.partitionBy("attr", "bucket").parquet(f"{self.path}/counts")
        discard(kept)

    def rows(self) -> DataFrame:
        return self.spark.read.schema("gd_id long, str string, attr string, bucket int").parquet(f"{self.path}/rows")

    def counts(self) -> DataFrame:
        """``attr, str, n``: every value and the number of its records."""
        return self.spark.read.schema("str string, n long, attr string, bucket int").parquet(f"{self.path}/counts").drop("bucket")

    def _of(self, table: DataFrame, attr: str, value: str) -> DataFrame:
        return table.where((F.col("attr") == attr) & (F.col("bucket") == self._bucket(F.lit(value))) & (F.col("str") == value))

    def size(self, attr: str, value: str) -> int:
        """How many records hold a value."""
        counts = self.spark.read.schema("str string, n long, attr string, bucket int").parquet(f"{self.path}/counts")
        found = self._of(counts, attr, value).first()
        return found["n"] if found else 0

    def holders(self, attr: str, value: str) -> DataFrame:
        """``gd_id`` of the records that hold a value."""
        return self._of(self.rows(), attr, value).select("gd_id")

    def find(self, clauses: list[tuple[str, str]], without: list[tuple[str, str]] = ()) -> DataFrame:
        """``gd_id`` of the records that hold every clause, and none of ``without``; no clause finds nothing.

        The rarest value's records are met by those of the next one and so on. What is left goes to the executors whole only while it is small.
        """
        sizes = {c: self.size(*c) for c in set(clauses)}
        order = sorted(sizes, key=lambda c: (sizes[c], c))
        if not order or not sizes[order[0]]:
            return self.rows().where("false").select("gd_id")
        left, bound = self.holders(*order[0]), sizes[order[0]]
        for c in order[1:]:
            some = F.broadcast(left) if bound <= BROADCAST_ROWS else left
            left = self.holders(*c).join(some, "gd_id", "left_semi")  # never more than there were
        for c in without:
            gone = self.holders(*c)
            left = left.join(F.broadcast(gone) if self.size(*c) <= BROADCAST_ROWS else gone, "gd_id", "left_anti")
        return left

    def strings(self, attr: str) -> DataFrame:
        """The distinct strings of an attribute in order, from the counts alone."""
        return self.counts().where(F.col("attr") == attr).select("str").orderBy("str")


def kept_postings(attrs: DataFrame, path: str) -> Postings:
    """Postings of an attribute table in a new folder."""
    out = Postings(attrs.sparkSession, path)
    out.write(attrs)
    return out
