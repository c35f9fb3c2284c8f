"""From extracted records to a record table and a long attribute table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bibweave.functions.text import fold_spaces
from bibweave.plans.numbers import numbered


def split_holdings(records: DataFrame, enumc: str = "enumc", item: str = "item_id") -> DataFrame:
    """One row per enumeration, items matched by place; surplus items go.

    Records that lack either list (null or empty) stay one row with their first item.
    """
    both = (F.size(F.coalesce(enumc, F.array())) > 0) & (F.size(F.coalesce(item, F.array())) > 0)
    first = F.get(F.coalesce(item, F.array()), F.lit(0))
    alone = F.struct(F.lit(0).alias("pos"), F.get(F.coalesce(enumc, F.array()), F.lit(0)).alias("enumc_value"), first.alias("item_value"))
    zipped = F.transform(F.coalesce(enumc, F.array()), lambda e, i: F.struct(i.alias("pos"), e.alias("enumc_value"), F.get(F.col(item), i).alias("item_value")))
    return records.withColumn("_h", F.explode(F.when(both, zipped).otherwise(F.array(alone)))).select(*[c for c in records.columns if c not in (enumc, item)], "_h.*")


def split_enumerations(records: DataFrame, enumc: str = "enumc") -> DataFrame:
    """One row per distinct enumeration in order; no list passes as it is, an empty list gives no row."""
    values = F.when(F.col(enumc).isNull(), F.array(F.lit(None).cast("string"))).otherwise(F.array_sort(F.array_distinct(enumc)))
    return records.withColumn(enumc, F.explode(values))


def clean_attributes(attrs: DataFrame) -> DataFrame:
    """Attribute rows as they are indexed: strings folded, empty ones and an ISSN of ``1`` dropped."""
    folded = attrs.withColumn("str", fold_spaces("str"))
    return folded.where((F.col("str") != "") & ~((F.col("attr") == "issn") & (F.col("str") == "1")))


def string_id(s) -> F.Column:
    """The dictionary id of a string: a number of its MD5, the same in every run and table."""
    return F.conv(F.substring(F.md5(s), 1, 15), 16, 10).cast("bigint")


def dictionary(attrs: DataFrame) -> DataFrame:
    """``str_id, str`` of every distinct string."""
    return attrs.select("str").distinct().select(string_id(F.col("str")).alias("str_id"), "str")


def content_hash(columns: list[str]) -> F.Column:
    """SHA-256 of the named columns as JSON, in the order given."""
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def new_records(incoming: DataFrame, existing: DataFrame | None, order: list[str], key: str = "hashsum") -> DataFrame:
    """Of incoming rows with equal keys the first in ``order``; keys that exist already go."""
    w = Window.partitionBy(key).orderBy(*order)
    first = incoming.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
    return first if existing is None else first.join(existing.select(key).distinct(), key, "left_anti")


def last_wins(rows: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Of rows with equal keys the last in ``order``."""
    w = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def file_ids(paths: DataFrame, column: str = "file_path") -> DataFrame:
    """A dense id for every input file in order of its path, from 1 on; a :class:`~bibweave.operators.dictionary.Dictionary` keeps ids from load to load."""
    return numbered(paths.select(column).distinct(), column, name="file_id", start=1)


def rewrite_values(attrs: DataFrame, attr: str, pattern: str, to: str, where: str = "true") -> DataFrame:
    """Attribute rows with a pattern replaced in the values of ``attr`` that a condition picks; rows made equal are one."""
    chosen = (F.col("attr") == attr) & F.expr(where)
    changed = attrs.withColumn("str", F.when(chosen, F.regexp_replace("str", pattern, to)).otherwise(F.col("str")))
    return changed.groupBy("gd_id", "attr", "str").agg(F.max("marc_field").alias("marc_field"))


def delete_file(records: DataFrame, attrs: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both tables without the records of some input files (``file_id``)."""
    gone = records.join(files.select("file_id").distinct(), "file_id", "left_semi").select("gd_id")
    return records.join(gone, "gd_id", "left_anti"), attrs.join(gone, "gd_id", "left_anti")


#: Tables that a wipe leaves as they are.
LASTING = ("strings", "input_files")


def wipe(tables: dict[str, DataFrame], lasting=LASTING) -> dict[str, DataFrame]:
    """The tables of a catalog with all rows taken out, but for the lasting ones; write them over the old ones."""
    return {name: df if name in lasting else df.where("false") for name, df in tables.items()}


def unused_strings(strings: DataFrame, attrs: DataFrame) -> DataFrame:
    """Dictionary entries that no attribute row holds."""
    return strings.join(attrs.select("str").distinct(), "str", "left_anti")
