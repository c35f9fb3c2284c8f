"""Tables that are kept in a folder and grow by loads, each of which is there as a whole or not at all."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

#: Rows of a written frame that may be broadcast against a stored table.
BROADCAST_ROWS = 1 << 21


class Loads:
    """The loads of one table: folders ``load=N`` of Parquet files.

    A load counts once its writer has put its mark of success beside the files, the last thing that it does. What a load
    that died has left behind is not read, and is replaced when the load is made again. One writer at a time is meant.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def _folder(self, path: str):
        target = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return target, target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def numbers(self) -> list[int]:
        """The loads that are there, in order."""
        target, files = self._folder(self.path)
        if not files.exists(target):
            return []
        names = [m[1] for s in files.listStatus(target) if (m := re.fullmatch(r"load=(\d+)", s.getPath().getName()))]
        return sorted(int(n) for n in names if files.exists(self._folder(f"{self.path}/load={n}/_SUCCESS")[0]))

    def read(self) -> DataFrame:
        """All rows of all loads, with ``load``."""
        found = [f"{self.path}/load={n}" for n in self.numbers()]
        whole = f"{self.schema}, load int"
        if not found:
            return self.spark.createDataFrame([], whole)
        return self.spark.read.schema(whole).option("basePath", self.path).parquet(*found)

    def write(self, rows: DataFrame, number: int) -> bool:
        """Write a load; one that is there already stays as it is. Returns whether it was written."""
        if number in self.numbers():
            return False
        rows.write.mode("overwrite").parquet(f"{self.path}/load={number}")
        return True
