"""Line dedup by site-relative frequency, with DataFrame operations only.

For every host the share of its pages that contain a line is known from one grouped
count of (host, line hash, page); lines above a ratio are boilerplate and go. Counts are
pre-aggregated on the map side, so a hot host or line costs a row per task. Each page
then meets the short list of its host's boilerplate hashes; texts are not shuffled
when those lists are small enough to be broadcast, and else hot hosts are salted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bibweave.plans.scratch import materialize

#: A line goes if it is on more than RATIO of its host's pages. One page repeats nothing, so it must be on LEAST of them.
RATIO, LEAST = 0.05, 2
#: Boilerplate lines that may be broadcast (8 bytes each); with more, hosts are joined by a shuffle.
BROADCAST_LINES = 1 << 20
#: There, a host with over 1 / HOT_SHARE of all pages is hot (so at most HOT_SHARE of them are) and is dealt over a salt for each such share.
HOT_SHARE = 1000


def _lines(text) -> F.Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _key(line) -> F.Column:
    """Hash of a line without the ASCII white space around it; null for a blank line."""
    bare = F.regexp_replace(line, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    return F.when(bare != "", F.xxhash64(bare))


def boilerplate_lines(docs: DataFrame, host, text_col: str = "text", ratio: float = RATIO, least: int = LEAST) -> DataFrame:
    """``host, line`` (hash), ``pages`` and ``of`` (all pages of the host) of every line above the ratio."""
    base = docs.select(host.alias("host"), F.col(text_col).alias("text"))
    totals = base.groupBy("host").agg(F.count("*").alias("of"))
    keys = F.array_distinct(F.filter(F.transform(_lines(F.col("text")), _key), lambda k: k.isNotNull()))
    counts = base.select("host", F.explode(keys).alias("line")).groupBy("host", "line").agg(F.count("*").alias("pages")).where(F.col("pages") >= least)
    found = counts.join(totals, counts["host"].eqNullSafe(totals["host"])).select(counts["host"], "line", "pages", "of")
    return found.where(F.col("pages") > F.lit(ratio) * F.col("of"))


def _lists_of(docs: DataFrame, found: DataFrame, hot_share: int) -> tuple[DataFrame, DataFrame]:
    """``docs`` (with ``at``, the host) and the lists of lines by host, with a ``salt`` to join them on as well."""
    lists = found.groupBy("host").agg(F.collect_set("line").alias("dull"))
    if found.count() <= BROADCAST_LINES:
        return docs.withColumn("salt", F.lit(0)), F.broadcast(lists.withColumn("salt", F.lit(0)))
    totals = materialize(docs.groupBy("at").agg(F.count("*").alias("of")), "hosts")
    share = max(1, totals.agg(F.sum("of")).first()[0] // hot_share)
    hot = F.broadcast(totals.where(F.col("of") > share).select(F.col("at").alias("hot"), F.ceil(F.col("of") / share).cast("int").alias("salts")))
    salt = F.pmod(F.xxhash64("row", F.monotonically_increasing_id()), F.coalesce("salts", F.lit(1))).cast("int")
    docs = docs.join(hot, F.col("at").eqNullSafe(F.col("hot")), "left").withColumn("salt", salt)
    each = F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))
    return docs, lists.join(hot, F.col("host").eqNullSafe(F.col("hot")), "left").select("host", "dull", each.alias("salt"))


def drop_boilerplate(
    docs: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = RATIO, least: int = LEAST, url: bool = False, hot_share: int = HOT_SHARE,
) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text_col``; adds ``n_lines`` and ``n_dropped``.

    The host is ``host_col``, or the host of that URL (without user, port and case). Rows with
    a null host form a host of their own. Lines are compared without white space at their
    ends; blank lines stay and a line repeated within a page counts once there. A null text
    stays null with no lines, a text may become empty, repeated rows are pages of their own. All rows and
    other columns stay, whatever their names; columns of ``docs`` named ``n_lines`` or ``n_dropped`` (in any case) are replaced.
    """
    host = F.lower(F.regexp_extract(F.col(host_col), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1)) if url else F.col(host_col)
    found = materialize(boilerplate_lines(docs, host, text_col, ratio, least), "boilerplate")
    kept = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    # the caller's columns are held apart, so none can clash with one of this function
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("row"), host.alias("at"))
    # a host has at most (lines of a page) / ratio such lines
    rows, lists = _lists_of(rows, found, hot_share)
    both = rows.join(lists.withColumnRenamed("salt", "of_salt"), F.col("at").eqNullSafe(F.col("host")) & (F.col("salt") == F.col("of_salt")), "left")
    text = F.col("row").getField(text_col)
    lines = _lines(text)
    good = F.filter(lines, lambda x: ~F.coalesce(F.array_contains("dull", _key(x)), F.lit(False)))
    size = F.when(text.isNull(), 0).otherwise(F.size(lines)).cast("long")
    both = both.select("row", size.alias("n_lines"), F.when(F.col("dull").isNull(), lines).otherwise(good).alias("rest"))
    dropped = F.when(text.isNull(), 0).otherwise(F.col("n_lines") - F.size("rest")).cast("long")
    left = F.when(text.isNotNull(), F.array_join("rest", "\n"))
    return both.select(*(left.alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in kept), "n_lines", dropped.alias("n_dropped"))
