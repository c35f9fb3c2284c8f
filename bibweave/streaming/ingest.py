"""Incremental ingest of extracted records with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bibweave.operators.catalog import content_hash, new_records
from bibweave.plans.scratch import discard, materialize
from bibweave.plans.stored import BROADCAST_ROWS, Loads


def new_lines(spark: SparkSession, path: str, schema: str, columns: list[str], delay: str = "1 hour") -> DataFrame:
    """A stream of records from JSON files that arrive in a folder, each content once within the watermark.

    Lines that are no JSON object are left out. The hash is of ``columns`` in that order.
    """
    lines = spark.readStream.text(path).where(F.col("value").startswith("{"))
    rows = lines.select(F.from_json("value", schema).alias("r")).select("r.*", F.current_timestamp().alias("read_at"))
    hashed = rows.withColumn("hashsum", content_hash(columns))
    return hashed.withWatermark("read_at", delay).dropDuplicatesWithinWatermark(["hashsum"])


class Store:
    """Records that were loaded, each content once and for ever, with the load that brought it first."""

    def __init__(self, spark: SparkSession, path: str, schema: str, content: list[str], order: list[str]):
        """``content`` are the columns that make a record what it is; of equal ones in a load the first in ``order`` stays."""
        self.content, self.order = content, order
        self.loads = Loads(spark, path, f"{schema}, hashsum string")

    def read(self) -> DataFrame:
        return self.loads.read()

    def insert(self, rows: DataFrame, load: int) -> int:
        """Add the records of a load whose content is not there yet and return how many were.

        The same load given again changes nothing, whether it had ended or died half-way.
        """
        if load in self.loads.numbers():
            return 0
        hashed = rows.withColumn("hashsum", content_hash(self.content))
        first = materialize(new_records(hashed, None, self.order), "first")
        keys = first.select("hashsum")
        known = self.read().select("hashsum").join(F.broadcast(keys) if first.count() <= BROADCAST_ROWS else keys, "hashsum", "left_semi")
        new = first.join(known, "hashsum", "left_anti")
        self.loads.write(new.select(*rows.columns, "hashsum"), load)
        discard(first)
        return self.loads.read().where(F.col("load") == load).count()

    def follow(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        """Load all that a stream has to give now, a load for each of its batches; call it again for what arrives later.

        A batch that is run again after a failure has its number, so it is not loaded twice.
        """

        def load(rows: DataFrame, number: int) -> None:
            self.insert(rows, number)

        return stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def lines_of(spark: SparkSession, path: str, schema: str, **options) -> DataFrame:
    """A stream of the objects of JSON files that arrive in a folder; other lines are left out."""
    lines = spark.readStream.options(**options).text(path).where(F.col("value").startswith("{"))
    return lines.select(F.from_json("value", schema).alias("r")).where("r is not null").select("r.*")
