"""Clusters of records: shared identifiers, checksums, duplicates, relations and scores."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bibweave.plans.components import connected_components
from bibweave.plans.scratch import materialize
from bibweave.plans.spread import dealt

IDENTIFIERS = ("oclc", "sudoc", "lccn", "issn")
CHECKSUM = ("pubdate", "sudoc", "oclc", "lccn", "issn")


def frequent_values(attrs: DataFrame, skip: int, kinds=IDENTIFIERS) -> DataFrame:
    """The ``skip`` most frequent values of each attribute (ties in order of the value)."""
    counts = attrs.where(F.col("attr").isin(*kinds)).groupBy("attr", "str").agg(F.count_distinct("gd_id").alias("c"))
    w = Window.partitionBy("attr").orderBy(F.desc("c"), "str")
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= skip)


def identifier_keys(attrs: DataFrame, skip: int = 10, kinds=IDENTIFIERS) -> DataFrame:
    """``gd_id, attr, str`` of identifiers but for the most frequent values."""
    keys = attrs.where(F.col("attr").isin(*kinds)).select("gd_id", "attr", "str").distinct()
    return keys if not skip else keys.join(F.broadcast(frequent_values(attrs, skip, kinds).select("attr", "str")), ["attr", "str"], "left_anti")


def identifier_clusters(attrs: DataFrame, skip: int = 10, kinds=IDENTIFIERS) -> DataFrame:
    """``gd_id, cluster_id`` (smallest member) of records linked by shared identifiers.

    Records whose identifiers are all missing or skipped are not in it (see :func:`cluster_relations`).
    Each value is a star around its smallest record, so a value held by many records is as many edges.
    """
    keys = identifier_keys(attrs, skip, kinds)
    centre = keys.groupBy("attr", "str").agg(F.min("gd_id").alias("centre"))
    edges = keys.join(centre, ["attr", "str"]).select("gd_id", "centre")
    return connected_components(edges, "gd_id", "centre").select(F.col("node").alias("gd_id"), F.col("component").alias("cluster_id"))


def traverse(keys: DataFrame) -> DataFrame:
    """``cluster_id, records, values``: the parts of the graph of records and the values (``attr, str``) that they hold.

    Every value is tied to its smallest record, so a path from record to value to record is one edge.
    """
    centre = keys.groupBy("attr", "str").agg(F.min("gd_id").alias("centre"))
    labels = connected_components(keys.join(centre, ["attr", "str"]), "gd_id", "centre")
    records = labels.groupBy(F.col("component").alias("cluster_id")).agg(F.count("*").alias("records"))
    values = centre.join(labels, F.col("centre") == F.col("node")).groupBy(F.col("component").alias("cluster_id")).agg(F.count("*").alias("values"))
    return records.join(values, "cluster_id")


def cluster_relations(records: DataFrame, clusters: DataFrame, gate: int = 25_000) -> DataFrame:
    """Every record's ``relation``: solo, cluster, huge (more than ``gate`` members) or unkeyed."""
    sizes = clusters.groupBy("cluster_id").agg(F.count("*").alias("n"))
    kind = F.when(F.col("n").isNull(), "unkeyed").when(F.col("n") == 1, "solo").when(F.col("n") > gate, "huge").otherwise("cluster")
    return records.select("gd_id").distinct().join(clusters, "gd_id", "left").join(sizes, "cluster_id", "left").select("gd_id", "cluster_id", kind.alias("relation"))


#: Ids of one list; longer groups go on in further lists.
LIST_IDS = 100_000


def group_lists(rows: DataFrame, keys: list[str], least: int = 1, most: int = LIST_IDS) -> DataFrame:
    """The sorted ids (``gd_id``) of every group of equal ``keys``, null equal to null: ``keys, n, part, ids``.

    ``n`` is the size of the group, of ``least`` or more. A group of up to ``most`` ids is one list, ``part`` 0. A larger
    one is dealt into ranges of ids that are sorted apart, and its lists, of at most ``most`` ids each, follow each other by ``part``. So no
    task and no row holds a whole group, however large it is. Repeated rows count once, rows without an id do not count.
    """
    rows = materialize(rows.select(*keys, "gd_id").where("gd_id is not null").distinct(), "group-rows")
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") >= least)
    large = materialize(sizes.where(F.col("n") > most).select(*(F.col(k).alias(f"of_{k}") for k in keys), "n"), "large-groups")
    n_large = large.count()
    ids = F.array_sort(F.collect_list("gd_id")).alias("ids")
    if not n_large:
        small = rows.groupBy(*keys).agg(ids).withColumn("n", F.size("ids").cast("long")).where(F.col("n") >= least)
        return small.select(*keys, "n", F.lit(0).alias("part"), "ids")
    of = F.broadcast(large) if n_large <= LIST_IDS else large
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"of_{k}")) for k in keys))
    small = rows.join(of, same, "left_anti").groupBy(*keys).agg(ids).withColumn("n", F.size("ids").cast("long")).where(F.col("n") >= least)
    dealt = rows.join(of, same).select(*keys, "gd_id", "n").repartitionByRange(*keys, "gd_id").sortWithinPartitions(*keys, "gd_id")
    dealt = materialize(dealt.withColumn("at", F.monotonically_increasing_id()), "large-rows")
    # a range holds neighbours only, so what lies between two multiples of `most` is a stretch of one group or of several
    piece = F.floor(F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) / most)
    pieces = dealt.groupBy(*keys, "n", F.shiftright("at", 33).alias("range"), piece.alias("piece")).agg(ids, F.min("gd_id").alias("lo"))
    part = F.row_number().over(Window.partitionBy(*keys).orderBy("lo")) - 1
    return small.select(*keys, "n", F.lit(0).alias("part"), "ids").unionByName(pieces.select(*keys, "n", part.alias("part"), "ids"))


def list_lines(lists: DataFrame, keys: list[str]) -> DataFrame:
    """``line``: keys, part and ids of lists with tabs between; write them sorted by keys and part."""
    shown = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return lists.select(F.concat_ws("\t", *shown, F.col("part").cast("string"), F.array_join(F.col("ids").cast("array<string>"), ",")).alias("line"))


def duplicate_sets(sets: DataFrame, attrs: DataFrame) -> DataFrame:
    """Members of a set with the same enumeration: ``set_id, enumc, n, part, ids`` (:func:`group_lists`) for two or more records.

    Records without an enumeration share the null one; a record with several joins several sets.
    """
    enumc = attrs.where("attr = 'enumc'").select("gd_id", F.col("str").alias("enumc")).distinct()
    return group_lists(sets.join(enumc, "gd_id", "left"), ["set_id", "enumc"], 2)


def score_of(n, total, distinct) -> F.Column:
    """The score of ``n`` records that hold ``total`` values, ``distinct`` different ones; null without values.

    The mean over values of 1 - (n - occurrences) / total, cubed, in closed form.
    """
    s = 1 - n / F.nullif(total, F.lit(0)) + 1 / F.nullif(distinct, F.lit(0))
    return s * s * s


def score_sets(members: DataFrame, attrs: DataFrame, key: str = "set_id", whole_lists: bool = True, most: tuple[int, int] | None = None) -> DataFrame:
    """``score`` of every set of records (``set_id, gd_id``) by the values they share.

    With ``whole_lists`` the sorted list of an attribute's values is one value and a missing
    enumeration counts as one; otherwise the greatest value of each attribute but
    enumeration and date counts. Equal values of different attributes are one value.

    ``most`` are bounds of the members and of the values that they hold, if known: both are then dealt in parts of bounded size
    before they are counted. ``attrs`` should be dealt by record then.
    """
    rows = attrs.select("gd_id", "attr", "str")
    if most:
        members = dealt(members.select(key, "gd_id"), most[0], key, "gd_id")
    if whole_lists:
        values = rows.groupBy("gd_id", "attr").agg(F.concat_ws("\x1f", F.array_sort(F.collect_set("str"))).alias("value"))
        plain = members.select("gd_id").distinct().join(values.where("attr = 'enumc'").select("gd_id"), "gd_id", "left_anti")
        values = values.unionByName(plain.select("gd_id", F.lit("enumc").alias("attr"), F.lit("").alias("value")))
    else:
        values = rows.where(~F.col("attr").isin("enumc", "pubdate")).groupBy("gd_id", "attr").agg(F.max("str").alias("value"))
    held = members.join(values, "gd_id").select(key, "value")
    if most:
        held = dealt(held, most[1], key, "value")
    counts = held.groupBy(key, "value").agg(F.count("*").alias("v"))
    sums = counts.groupBy(key).agg(F.sum("v").alias("total"), F.count("*").alias("distinct"))
    sizes = members.groupBy(key).agg(F.count_distinct("gd_id").alias("n"))
    return sizes.join(sums, key, "left").select(key, "n", score_of(F.col("n"), F.col("total"), F.col("distinct")).alias("score"))


def checksums(attrs: DataFrame, records: DataFrame, kinds=CHECKSUM) -> DataFrame:
    """``gd_id, checksum``: the MD5 of every combination of a record's values of ``kinds``; missing ones are empty."""
    lists = records.select("gd_id").distinct()
    wide = attrs.where(F.col("attr").isin(*kinds)).groupBy("gd_id").agg(*(F.collect_set(F.when(F.col("attr") == k, F.col("str"))).alias(k) for k in kinds))
    out = lists.join(wide, "gd_id", "left")
    for k in kinds:
        out = out.withColumn(k, F.explode_outer(k))
    return out.select("gd_id", F.md5(F.concat_ws(",", *(F.coalesce(k, F.lit("")) for k in kinds))).alias("checksum")).distinct()


def checksum_groups(sums: DataFrame) -> DataFrame:
    """``checksum, n, part, ids`` of :func:`group_lists`."""
    return group_lists(sums, ["checksum"])


def key_groups(wide: DataFrame, keys: list[str], least: int = 2) -> DataFrame:
    """Records with equal keys, null equal to null, as ``n, part, ids`` of at least ``least`` records.

    Records that form a group under several combinations of keys form it once, unless it is longer than a list.
    """
    return _once(group_lists(wide, keys, least).select("n", "part", "ids"))


def _once(lists: DataFrame) -> DataFrame:
    """Equal rows of groups that are one list are one; lists of longer groups stay as they are."""
    whole = F.col("n") == F.size("ids")
    return lists.where(whole).distinct().unionByName(lists.where(~whole))


def classify_groups(members: DataFrame, attrs: DataFrame, key: str = "set_id") -> DataFrame:
    """Relations of groups by the enumerations of their records: ``set_id, relation, n, part, ids`` (:func:`group_lists`).

    One record is solo; one enumeration for all means duplicates; as many enumerations as
    records means related; else every enumeration with several records gives ``duplicates*`` and the
    group is ``related*``, or ``unclear`` without any. A missing enumeration counts as one.
    """
    enumc = attrs.where("attr = 'enumc'").select("gd_id", F.col("str").alias("enumc")).distinct()
    rows = materialize(members.select(key, "gd_id").distinct().join(enumc, "gd_id", "left"), "enumerated")
    by_enum = rows.groupBy(key, "enumc").agg(F.count("*").alias("c"))
    stats = by_enum.groupBy(key).agg(F.count("*").alias("e"), F.max("c").alias("c"))
    sizes = rows.select(key, "gd_id").distinct().groupBy(key).agg(F.count("*").alias("k"))
    relation = (
        F.when(F.col("k") == 1, "solo").when(F.col("e") == 1, "duplicates").when(F.col("e") == F.col("k"), "related")
        .when(F.col("c") > 1, "related*").otherwise("unclear")
    )
    judged = sizes.join(stats, key).select(key, relation.alias("relation"))
    whole = group_lists(rows, [key]).join(judged, key).select(key, "relation", "n", "part", "ids")
    starred = judged.where("relation = 'related*'").select(key)
    again = group_lists(rows.join(starred, key, "left_semi"), [key, "enumc"], 2)
    return whole.unionByName(again.select(key, F.lit("duplicates*").alias("relation"), "n", "part", "ids"))


def final_relations(lines: DataFrame) -> DataFrame:
    """Lines as they are filed: stars dropped, a score only for duplicates, ``unclear`` kept apart; equal short lists are one line."""
    relation = F.regexp_replace("relation", r"\*$", "")
    out = lines.select(relation.alias("relation"), F.when(relation == "duplicates", F.col("score")).alias("score"), "n", "part", "ids")
    return _once(out)


def resolve_canonical(links: DataFrame, volume: str = "volume_id", value: str = "oclc") -> DataFrame:
    """``old, new``: values and the smallest one that shares a volume with them, where it differs.

    One hop, not transitive: the smallest value of each volume is one aggregate, so no pairs are made.
    """
    least = links.groupBy(volume).agg(F.min(value).alias("least"))
    found = links.join(least, volume).groupBy(F.col(value).alias("old")).agg(F.min("least").alias("new"))
    return found.where("old <> new")


def apply_resolution(attrs: DataFrame, mapping: DataFrame, attr: str = "oclc") -> DataFrame:
    """Attribute rows with values of ``attr`` replaced by what they resolve to; rows made equal are one."""
    m = mapping.select(F.col("old").cast("string").alias("str"), F.col("new").cast("string").alias("_new"), F.lit(attr).alias("attr"))
    out = attrs.join(m, ["attr", "str"], "left").withColumn("str", F.coalesce("_new", "str"))
    return out.groupBy("gd_id", "attr", "str").agg(F.max("marc_field").alias("marc_field"))
