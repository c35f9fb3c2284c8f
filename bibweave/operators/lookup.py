"""Conjunctive exact-match queries and displays over the attribute table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ATTRIBUTES = ("oclc", "lccn", "issn", "isbn", "title", "enumc", "pubdate", "publisher", "sudoc")


def parse_query(text: str) -> tuple[list[tuple[str, str]], list[str]]:
    """Clauses ``attr=value`` and projected attributes ``!attr`` up to ``;`` or a blank line.

    A value may hold ``=``. An unknown attribute or a line of another form raises.
    """
    clauses, shown = [], []
    for line in text.splitlines():
        line = line.strip()
        if line in (";", ""):
            break
        attr, mark, value = line.partition("=")
        name = attr.removeprefix("!").strip()
        if name not in ATTRIBUTES:
            raise ValueError(f"unknown attribute: {name}")
        if line.startswith("!"):
            shown.append(name)
        elif mark:
            clauses.append((name, value))
        else:
            raise ValueError(f"neither a clause nor a projection: {line}")
    return clauses, shown


def find_records(attrs: DataFrame, clauses: list[tuple[str, str]]) -> DataFrame:
    """``gd_id`` of records that hold every clause; all are found in one scan and one aggregate."""
    wanted = sorted(set(clauses))
    if not wanted:
        return attrs.select("gd_id").where("false")
    any_of = F.lit(False)
    for attr, value in wanted:
        any_of |= (F.col("attr") == attr) & (F.col("str") == value)
    hits = attrs.where(any_of).groupBy("gd_id").agg(F.count_distinct("attr", "str").alias("k"))
    return hits.where(F.col("k") == len(wanted)).select("gd_id")


def format_records(ids: DataFrame, attrs: DataFrame, shown=ATTRIBUTES) -> DataFrame:
    """One row per record with a sorted list of strings for each attribute shown."""
    rows = ids.join(attrs.where(F.col("attr").isin(*shown)), "gd_id", "left")
    return rows.groupBy("gd_id").agg(*(F.array_sort(F.collect_set(F.when(F.col("attr") == a, F.col("str")))).alias(a) for a in shown))


def display_records(ids: DataFrame, records: DataFrame, attrs: DataFrame) -> DataFrame:
    """Header fields and attribute rows of the chosen records."""
    return ids.join(records, "gd_id").join(attrs, "gd_id").select("gd_id", "file_path", "record_id", "attr", "marc_field", "str")


def inspect_solos(solos: DataFrame, attrs: DataFrame, attr: str, threshold: int = 1) -> DataFrame:
    """Values of an attribute and the solo records that hold them, for ``threshold`` records or more."""
    rows = solos.select("gd_id").join(attrs.where(F.col("attr") == attr), "gd_id")
    return rows.groupBy("str").agg(F.array_sort(F.collect_set("gd_id")).alias("ids")).where(F.size("ids") >= threshold)
