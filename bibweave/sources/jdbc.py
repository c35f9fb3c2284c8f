"""Tables of a relational database, and statements prepared once and run with values."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def bounds_of(spark: SparkSession, url: str, table: str, key: str, **options) -> tuple[int, int] | None:
    """The smallest and largest ``key`` of a table, asked of the database; None if there is none."""
    asked = f"(SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM {table}) bounds_of"
    lo, hi = spark.read.format("jdbc").options(url=url, dbtable=asked, **options).load().first()
    return None if lo is None else (int(lo), int(hi))


def read_table(spark: SparkSession, url: str, table: str, key: str | None = None, bounds: tuple[int, int] | None = None, parts: int = 32, **options) -> DataFrame:
    """A table, or a query in brackets with a name, over JDBC; filters and columns are pushed down to it.

    With a numeric ``key`` it is read in ``parts`` ranges at a time, between ``bounds`` or else those that the database tells;
    rows outside of the bounds are read as well, and so are rows without a key.
    """
    given = {"url": url, "dbtable": table, **options}
    if key is not None:
        bounds = bounds or bounds_of(spark, url, table, key, **options)
    if key is not None and bounds is not None:
        given |= {"partitionColumn": key, "lowerBound": str(bounds[0]), "upperBound": str(bounds[1] + 1), "numPartitions": str(parts)}
    return spark.read.format("jdbc").options(**given).load()


def prepare(spark: SparkSession, sql: str, **tables: DataFrame) -> Callable[..., DataFrame]:
    """A statement with ``?`` for values and names in braces for tables, as a function of the values.

    Values are bound as literals and never become part of the statement's text.
    """
    return lambda *values: spark.sql(sql, args=list(values), **tables)
