"""Field profiles: which tags of a record give which attribute."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bibweave.functions.marc import publication_date, single_008, values_of
from bibweave.functions.text import unicode_fold

#: Normalised lists that replace what was extracted, by attribute.
OVERRIDES = {"isbn": "isbns_normalized", "issn": "issn_normalized", "lccn": "lccn_normalized", "oclc": "oclc_resolved", "sudoc": "sudocs"}


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    """``profile, ord, spec, label`` of files of ``tag<TAB>label`` lines, named by file.

    A label keeps what follows it on its line, so a comment makes it another label. Of a tag listed twice the last label counts.
    """
    lines = spark.read.text(path).select(F.regexp_extract("_metadata.file_path", r"([^/]+)\.tsv$", 1).alias("profile"), "value", F.monotonically_increasing_id().alias("ord"))
    parts = lines.where(F.col("value").rlike(r"^\d{3}[0-9a-z]?\t")).select("profile", "ord", F.split("value", "\t", 2).alias("p"))
    rows = parts.select("profile", "ord", F.get("p", F.lit(0)).alias("spec"), F.trim(F.get("p", F.lit(1))).alias("label"))
    return rows.groupBy("profile", "spec").agg(F.max_by("label", "ord").alias("label"), F.min("ord").alias("ord"))


def _tagged(values: Column, spec: str) -> Column:
    return F.transform(values, lambda v: F.struct(F.lit(spec).alias("marc_field"), v.alias("value")))


def _rows(label: str) -> Column:
    held = F.coalesce(label, F.array().cast("array<struct<marc_field:string,value:string>>"))
    return F.transform(held, lambda x, i: F.struct(F.lit(label).alias("attr"), x["marc_field"].alias("marc_field"), x["value"].alias("str"), i.alias("at")))


def extract(records: DataFrame, profile: list[tuple[str, str]], fold=("title", "publisher"), keep=("infile",)) -> DataFrame:
    """Attributes of records as arrays of ``marc_field, value``, one column for each label of a profile.

    ``profile`` are (spec, label) pairs in order. Publication dates begin with the one of a single 008. Values of
    ``fold`` are brought to plain lower-case Latin. Columns named in :data:`OVERRIDES` replace what they stand for, an empty list clears it.
    """
    specs: dict[str, list[str]] = {}
    for spec, label in dict(profile).items():
        specs.setdefault(label, []).append(spec)
    specs.setdefault("pubdate", [])
    out: dict[str, Column] = {}
    for label, tags in specs.items():
        parts = [_tagged(values_of(t), t) for t in tags]
        if label == "pubdate":
            date = publication_date(single_008(values_of("008")))
            parts.insert(0, F.array(F.struct(F.lit("008").alias("marc_field"), date.alias("value"))))
        out[label] = F.concat(*parts)
    frame = records.withColumns(out)
    for label in fold:
        if label in out:
            rest = F.transform(label, lambda x: x["value"])
            folded = frame.withColumn("_j", F.array_join(rest, "\x1e", "\x1f")).withColumn("_j", unicode_fold("_j"))
            values = F.split("_j", "\x1e")
            frame = folded.withColumn(label, F.when(F.size(label) > 0, F.transform(F.arrays_zip(F.col(label), values.alias("v")), lambda z: F.struct(z[label]["marc_field"].alias("marc_field"), F.trim(z["v"]).alias("value")))).otherwise(F.col(label))).drop("_j")
    for label, given in OVERRIDES.items():
        if given in records.columns:
            new = _tagged(F.col(given), "999x")
            old = F.col(label) if label in out else F.array().cast("array<struct<marc_field:string,value:string>>")
            frame = frame.withColumn(label, F.when(F.col(given).isNotNull(), new).otherwise(old))
            out.setdefault(label, frame[label])
    return frame.select(*[c for c in keep if c in records.columns], *out)


def to_attributes(extracted: DataFrame, id_col: str, labels: list[str]) -> DataFrame:
    """The long table ``gd_id, attr, marc_field, str``; of equal values of a record the last field wins."""
    each = F.concat(*(_rows(label) for label in labels))
    rows = extracted.select(F.col(id_col).alias("gd_id"), F.explode(each).alias("x")).select("gd_id", "x.*").where("str is not null and str <> ''")
    return rows.groupBy("gd_id", "attr", "str").agg(F.max_by("marc_field", "at").alias("marc_field"))
