"""Exact dedup by a content sort, with DataFrame operations only.

Texts with white space normalised are dealt into ranges by sampled splitters and sorted by their bytes,
on disk if need be, so equal texts stand side by side; a window over the text compares each
with its neighbour in full and keeps the smallest id of the run.

Splitters are the first ``HEAD`` characters, so the sample that the driver takes is short. Beginnings that
more than 1 / ``HOT_SHARE`` of all rows share are hot and are dealt into sub-ranges by a number of the
digest, in which texts stand in the order of their bytes again. Texts of which there are more than that get salts as
well, and so several runs in several ranges; the first rows of those runs, with their texts, are
compared and merged in a second grouping by the full text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bibweave.plans.scratch import materialize

#: A text or beginning is hot when it holds more than 1 / HOT_SHARE of all rows; so at most HOT_SHARE of each are.
HOT_SHARE = 1000
#: Least rows that make a text or beginning hot.
LEAST_HOT = 200
#: Characters of a text that splitters are made of.
HEAD = 32


def normalised(text) -> F.Column:
    """Runs of ASCII white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot_share: int = HOT_SHARE, least_hot: int = LEAST_HOT) -> DataFrame:
    """Groups of equal normalised texts.

    Returns one row per input row: ``doc_id, keep_id`` (the group's smallest id),
    ``group_size`` (rows), ``kept`` and ``text_sha256`` (of the normalised text). Null and empty
    texts are one group. Null ids count in sizes, are never the smallest unless alone and are not
    kept beside other ids. Of rows that share the smallest id all are kept. Other columns are ignored, an empty table gives no rows.
    """
    text = normalised(F.col(text_col))
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("norm"), F.unhex(F.sha2(text, 256)).alias("sha"))
    base = base.withColumn("head", F.substring("norm", 1, HEAD)).withColumn("start", F.unhex(F.md5("head")))
    limit = max(least_hot, docs.count() // hot_share)
    # digests of texts and of beginnings, told apart by their lengths; at most hot_share of each are hot
    counts = base.select(F.explode(F.array("sha", "start")).alias("digest")).groupBy("digest").agg(F.count("*").alias("n")).where(F.col("n") > limit)
    counts = materialize(counts, "hot")
    hot = F.broadcast(counts.where(F.length("digest") == 32).select(F.col("digest").alias("sha"), F.ceil(F.col("n") / limit).cast("int").alias("salts")))
    crowded = F.broadcast(counts.where(F.length("digest") == 16).select(F.col("digest").alias("start"), F.lit(True).alias("crowded")))
    # rows of one id, or of none, spread over the salts too
    dealt = base.withColumn("at", F.monotonically_increasing_id()).join(hot, "sha", "left").join(crowded, "start", "left")
    salt = F.coalesce(F.pmod(F.xxhash64("doc_id", "at"), F.col("salts")).cast("int"), F.lit(0))
    dealt = dealt.withColumns({"salt": salt, "sub": F.when(F.col("crowded"), F.xxhash64("sha")).otherwise(F.lit(0).cast("long"))})
    dealt = dealt.select("doc_id", "norm", "sha", "salts", "head", "sub", "salt").repartitionByRange("head", "sub", "salt")
    run = Window.partitionBy("head", "sub", "salt", "norm")
    up = run.orderBy(F.col("doc_id").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = run.orderBy(F.col("doc_id").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    runs = dealt.select("doc_id", "sha", "salts", "salt", "norm", F.first("doc_id").over(up).alias("keep_id"), F.count("*").over(up).alias("nth"), F.count("*").over(whole).alias("group_size"))
    first = F.col("salts").isNotNull() & (F.col("nth") == 1)
    runs = materialize(runs.select("doc_id", "sha", "salts", "salt", "keep_id", "group_size", F.when(first, F.col("norm")).alias("text")), "runs")
    # a row per run of a hot text: at most twice hot_share of them
    each = F.struct("sha", "salt", F.col("keep_id").alias("run_id"))
    merged = runs.where("text is not null").groupBy("text").agg(F.min("keep_id").alias("least"), F.sum("group_size").alias("total"), F.collect_list(each).alias("each"))
    merged = F.broadcast(merged.select("least", "total", F.explode("each").alias("x")).select("least", "total", F.col("x.sha").alias("of_sha"), F.col("x.salt").alias("of_salt"), "x.run_id"))
    own = (F.col("sha") == F.col("of_sha")) & (F.col("salt") == F.col("of_salt")) & F.col("keep_id").eqNullSafe(F.col("run_id")) & F.col("salts").isNotNull()
    out = runs.drop("text").join(merged, own, "left")
    keep = F.when(F.col("salts").isNotNull(), F.col("least")).otherwise(F.col("keep_id"))
    return out.select(
        "doc_id", keep.alias("keep_id"), F.coalesce("total", "group_size").alias("group_size"),
        keep.eqNullSafe(F.col("doc_id")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"),
    )
