"""Tab-separated catalog dumps, newest-file selection, word lists and pair files."""

from __future__ import annotations

import gzip
import shutil
import urllib.request
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns of a dump that are used, by their place from 0.
COLUMNS = {"htid": 0, "record_id": 3, "enum_chron": 4, "oclc": 7, "isbn": 8, "issn": 9, "lccn": 10, "title": 11, "imprint": 12, "gov_doc": 15, "pubdate": 16}


def read_dump(spark: SparkSession, path: str, columns: dict[str, int] | None = None) -> DataFrame:
    """Chosen columns of a dump; quotes mean nothing in it."""
    parts = F.split("value", "\t", -1)
    return spark.read.text(path).select(*(F.get(parts, F.lit(i)).alias(n) for n, i in (columns or COLUMNS).items()))


def government_documents(dump: DataFrame) -> DataFrame:
    return dump.where("gov_doc = '1'")


def as_lists(dump: DataFrame) -> DataFrame:
    """Every value in an array of its own, as the JSON form of a dump has it."""
    return dump.select(*(F.array(c).alias(c) for c in dump.columns))


def newest(paths: DataFrame, column: str = "path", pattern: str = r"full_\d+\.txt(\.gz)?$") -> DataFrame:
    """The last of the paths that match a pattern, in order of their text."""
    return paths.where(F.col(column).rlike(pattern)).agg(F.max(column).alias(column))


def listed_files(pages: DataFrame, pattern: str = r"full_\d+\.txt\.gz", column: str = "body") -> DataFrame:
    """``path``: the quoted links of listing pages that end in a file of a pattern."""
    found = F.regexp_extract_all(F.col(column), F.lit(rf'"([^"\s]*{pattern})"'), F.lit(1))
    return pages.select(F.explode(found).alias("path")).distinct()


def fetch_newest(pages: DataFrame, folder: str, name: str = "", pattern: str = r"full_\d+\.txt\.gz") -> str:
    """Download the newest listed file (of those whose link holds ``name``), inflate it and return its path.

    Any URL that Python opens will do. A file that is there already is not fetched again; none listed raises.
    """
    path = newest(listed_files(pages, pattern).where(F.col("path").contains(name)), pattern=pattern + "$").first()["path"]
    if path is None:
        raise FileNotFoundError(f"no listed file matches {name or pattern}")
    target = Path(folder) / path.rsplit("/", 1)[-1]
    if not target.exists():
        with urllib.request.urlopen(path) as response, open(target, "wb") as out:
            shutil.copyfileobj(response, out)
    if target.suffix != ".gz":
        return str(target)
    with gzip.open(target) as packed, open(target.with_suffix(""), "wb") as out:
        shutil.copyfileobj(packed, out)
    return str(target.with_suffix(""))


def read_words(spark: SparkSession, path: str) -> list[str]:
    """A short list of one word or phrase a line, for patterns."""
    return [r["value"].strip() for r in spark.read.text(path).collect() if r["value"].strip()]


def names_in_yaml(lines: DataFrame, key: str = "name") -> DataFrame:
    """Distinct upper-case values of a key in YAML lines."""
    found = F.upper(F.trim(F.regexp_extract("value", rf"^\s*-?\s*{key}:\s*['\"]?([^'\"]*)", 1)))
    return lines.select(found.alias("name")).where("name <> ''").distinct()


def classified_numbers(bibs: DataFrame, numbers: DataFrame, kind: str = "sudoc") -> DataFrame:
    """``htid, num`` of a table of items joined with one of numbers of a kind."""
    return bibs.join(numbers.where(F.col("type") == kind), "bibid").select(F.trim("htid").alias("htid"), F.trim("num").alias("num"))


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """``id, other_id, score`` of a pair file; lines of another form (a negative score too) are left out."""
    rx = r"^(\d+)\t(\d+)\t(\d\.\d+)"
    part = lambda i: F.regexp_extract("value", rx, i)
    rows = spark.read.text(path).where(F.col("value").rlike(rx))
    return rows.select(part(1).cast("bigint").alias("id"), part(2).cast("bigint").alias("other_id"), part(3).cast("double").alias("score"))


def write_relations(lines: DataFrame, path: str) -> None:
    """Lines ``relation<TAB>[score<TAB>]ids``."""
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    lines.select(F.concat_ws("\t", "relation", F.col("score").cast("string"), ids).alias("value")).write.text(path)


def read_relations(spark: SparkSession, path: str) -> DataFrame:
    """``relation, score, ids`` of such lines."""
    p = F.split("value", "\t")
    score = F.when(F.size(p) > 2, F.get(p, F.lit(1)).cast("double"))
    return spark.read.text(path).select(F.get(p, F.lit(0)).alias("relation"), score.alias("score"), F.split(F.element_at(p, -1), ",").cast("array<bigint>").alias("ids"))
