"""Clusters that are kept up to date as records arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bibweave.operators.clusters import IDENTIFIERS
from bibweave.plans.components import connected_components
from bibweave.plans.scratch import discard, materialize
from bibweave.plans.stored import BROADCAST_ROWS, Loads


def _few(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A written frame, broadcast if it has few rows."""
    return F.broadcast(df) if df.count() <= rows else df


class Components:
    """Components of a graph whose edges come in loads: a label for each node, the smallest node that it reaches.

    A node's label is written once, when the node first comes. Where a load joins components, only their old labels and
    the new ones are written (``merged``), so nodes of components that a load does not touch, and even those of a large one that
    grows, stay as they are. Rounds of stars run over the load's edges between labels alone.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.labels = Loads(spark, f"{path}/labels", "node long, first long")
        self.merged = Loads(spark, f"{path}/merged", "old long, new long")

    def _merges(self) -> DataFrame:
        """What each label that is gone has become, by the last load that says so."""
        rows = self.merged.read().select("load", "old", "new")
        return rows.groupBy("old").agg(F.max_by("new", "load").alias("new"))

    def read(self) -> DataFrame:
        """``node, component``."""
        last = max(self.merged.numbers(), default=-1)
        both = self.labels.read().where(F.col("load") <= last).join(self._merges(), F.col("first") == F.col("old"), "left")
        return both.select("node", F.coalesce("new", "first").alias("component"))

    def insert(self, edges: DataFrame, load: int, left: str = "u", right: str = "v") -> None:
        """Add edges; both ends equal make a node of its own. A load that was made before is left as it is."""
        if load in self.merged.numbers():  # the last that a load writes
            return
        edges = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).where("u is not null and v is not null")
        if not any(n < load for n in self.labels.numbers()):  # nothing to tie the load to
            parts = connected_components(edges)
            self.labels.write(parts.select("node", F.col("component").alias("first")), load)
            self.merged.write(parts.sparkSession.createDataFrame([], "old long, new long"), load)
            discard(parts)
            return
        edges = materialize(edges, "arrived")
        nodes = materialize(edges.select(F.col("u").alias("node")).union(edges.select("v")).distinct(), "touched")
        # labels of the load itself are those of a try that died
        held = self.labels.read().where(F.col("load") < load)
        merges = materialize(self._merges(), "merges")
        known = held.join(_few(nodes), "node", "left_semi").join(_few(merges), F.col("first") == F.col("old"), "left")
        known = materialize(known.select("node", F.coalesce("new", "first").alias("label")), "known")
        # a node that is new is its own label, which no node had before
        now = _few(known)
        ends = edges.join(now.select(F.col("node").alias("u"), F.col("label").alias("a")), "u", "left")
        ends = ends.join(now.select(F.col("node").alias("v"), F.col("label").alias("b")), "v", "left")
        parts = connected_components(ends.select(F.coalesce("a", "u").alias("a"), F.coalesce("b", "v").alias("b")), "a", "b")
        found = materialize(parts.select(F.col("node").alias("label"), F.col("component").alias("new")), "contracted")
        discard(parts)
        old = known.select("label").distinct()
        fresh = found.join(old, "label", "left_anti").select(F.col("label").alias("node"), F.col("new").alias("first"))
        # a label that was a component before this load, and all labels that had become it
        changed = materialize(old.join(found, "label").where("label <> new"), "changed")
        again = merges.select("old", F.col("new").alias("label")).join(changed, "label").select("old", "new")
        self.labels.write(fresh, load)
        self.merged.write(changed.select(F.col("label").alias("old"), "new").unionByName(again), load)
        discard(edges, nodes, merges, known, found, changed)


class Clusters:
    """Clusters of records on shared identifiers, kept up to date: :func:`identifier_clusters` of all records so far, without skipped values."""

    def __init__(self, spark: SparkSession, path: str, kinds=IDENTIFIERS):
        self.kinds = kinds
        self.components = Components(spark, path)
        self.centres = Loads(spark, f"{path}/centres", "attr string, str string, centre long")

    def read(self) -> DataFrame:
        """``gd_id, cluster_id`` (smallest member)."""
        return self.components.read().select(F.col("node").alias("gd_id"), F.col("component").alias("cluster_id"))

    def insert(self, attrs: DataFrame, load: int) -> None:
        """Add records. Each value ties its records to the first one that had it, so one that comes later needs that one only."""
        made = self.centres.numbers()
        if load in made:  # the last that a load writes
            return
        keys = attrs.where(F.col("attr").isin(*self.kinds)).select(F.col("gd_id").cast("long").alias("gd_id"), "attr", "str")
        own = keys.groupBy("attr", "str").agg(F.min("gd_id").alias("least"))
        if any(n < load for n in made):
            own = materialize(own, "values")
            held = self.centres.read().where(F.col("load") < load).drop("load")
            if own.count() <= BROADCAST_ROWS:  # else both are dealt by the join anyway
                held = held.join(F.broadcast(own.select("attr", "str")), ["attr", "str"], "left_semi")
            tied = own.join(held, ["attr", "str"], "left").select("attr", "str", F.coalesce("centre", "least").alias("centre"), F.col("centre").isNull().alias("fresh"))
        else:
            tied = own.select("attr", "str", F.col("least").alias("centre"), F.lit(True).alias("fresh"))
        centre = materialize(tied, "tied")
        self.components.insert(keys.join(centre, ["attr", "str"]), load, "gd_id", "centre")
        self.centres.write(centre.where("fresh").drop("fresh"), load)
        discard(own, centre)
