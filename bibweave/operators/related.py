"""Separation of clusters into related sets by the values their records share."""

from __future__ import annotations

import heapq
import sys

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bibweave.plans.scratch import discard, materialize

#: Attributes in the order they are tried.
ORDER = ("oclc", "sudoc", "lccn", "issn", "title")


class DrillDown:
    """Repeated splits of one cluster by the value that most records share.

    ``values`` maps each record to its values by attribute. A set in which all share a value is
    related. Else the holders of the most common value are split off and tried with other
    attributes, and the rest is tried afresh; a part in which nothing was settled
    is taken as it is. Ties go to the earlier attribute, then the value of the smallest record, then the value.
    """

    def __init__(self, values: dict[int, dict[str, list[str]]]):
        self.values = values
        self.sets: list[tuple[int, ...]] = []

    def _holders(self, ids: list[int], attr: str) -> list[tuple[str, list[int]]]:
        found: dict[str, list[int]] = {}
        for i in ids:
            for v in self.values[i].get(attr, ()):
                found.setdefault(v, []).append(i)
        return [(v, held) for v, held in found.items() if len(held) > 1]

    def run(self, ids: list[int], tried: list[str] | None = None) -> bool:
        """Whether the last step settled something, which decides if the caller takes ``ids`` whole."""
        tried = [] if tried is None else tried
        rests: list[list[int]] = []
        while True:
            settled, rest = self._split(ids, tried)
            if len(rest) < 2:
                break
            rests.append(rest)
            ids, tried = rest, []
        for rest in reversed(rests):
            if not settled:
                self.sets.append(tuple(rest))
            settled = not settled
        return settled

    def _split(self, ids: list[int], tried: list[str]) -> tuple[bool, list[int]]:
        """One step: whether all of ``ids`` were settled, and what is left for the next."""
        if len(ids) < 2:
            return False, []
        best: list[int] = []
        best_attr = ""
        for attr in [a for a in ORDER if a not in tried]:
            for _, held in self._holders(ids, attr):
                if len(held) == len(ids):
                    tried.append(attr)
                    self.sets.append(tuple(ids))
                    return True, []
                if len(held) > len(best):
                    best, best_attr = held, attr
        if not best:
            return False, []
        tried.append(best_attr)
        if not self.run(best, tried):
            self.sets.append(tuple(best))
        inside = set(best)
        return False, [i for i in ids if i not in inside]

    def shares(self, ids: tuple[int, ...]) -> bool:
        """Whether one value is held by all of ``ids``."""
        return any(len(held) == len(ids) for attr in ORDER for _, held in self._holders(list(ids), attr))


def drill_down(values: dict[int, dict[str, list[str]]], prune: bool = True, witness: bool = True) -> list[tuple[int, ...]]:
    """Related sets of one cluster.

    ``prune`` drops repeated sets and those within another, ``witness`` those whose records share no
    value. Both off gives every set that the splitting comes upon, in that order.
    """
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 4 * len(values) + 1000))
    walk = DrillDown(values)
    walk.run(sorted(values))
    sets = walk.sets
    if witness:
        sets = [s for s in sets if walk.shares(s)]
    if prune:
        sets = sorted(_outermost(sets))
    return sets


def _outermost(sets: list[tuple[int, ...]]) -> list[tuple[int, ...]]:
    """Distinct sets that lie within no other; a set is only held against those that hold its rarest member."""
    kept: list[set[int]] = []
    of: dict[int, list[int]] = {}
    out = []
    for s in sorted(dict.fromkeys(sets), key=len, reverse=True):
        rarest = min(s, key=lambda i: len(of.get(i, ())))
        if not any(kept[k].issuperset(s) for k in of.get(rarest, ())):
            for i in s:
                of.setdefault(i, []).append(len(kept))
            kept.append(set(s))
            out.append(s)
    return out


#: Rounds in which all clusters are split together, before what is left of each is split alone.
ROUNDS = 12


def _first_picks(rows: DataFrame) -> DataFrame:
    """One row for every record that shares a value: its best value, and whether the value is ``picked``.

    Values rank by their number of holders, then by attribute, smallest holder and the value itself. One that is the best of
    all its holders is taken before any other value of theirs, whatever happens elsewhere, so all such values can be picked at once.
    """
    of_value = Window.partitionBy("cluster_id", "o", "str")
    held = rows.withColumns({"n": F.count("*").over(of_value), "m": F.min("gd_id").over(of_value)}).where("n > 1")
    held = held.withColumn("rank", F.struct((-F.col("n")).alias("n"), "o", "m", "str"))
    best = held.withColumn("best", F.min("rank").over(Window.partitionBy("cluster_id", "gd_id"))).where("rank = best")
    return best.withColumn("picked", F.count("*").over(of_value) == F.col("n")).select("cluster_id", "o", "str", "gd_id", "picked")


def _pick_alone(table: pa.Table) -> pa.Table:
    """The same picks for what is left of one cluster, one after another."""
    holders: dict[tuple, list[int]] = {}
    for o, s, gd in sorted(zip(*(table.column(c).to_pylist() for c in ("o", "str", "gd_id"))), key=lambda x: x[2]):
        holders.setdefault((o, s), []).append(gd)
    of: dict[int, list[tuple]] = {}
    for v, ids in holders.items():
        for i in ids:
            of.setdefault(i, []).append(v)
    size, first, gone, out = {v: len(ids) for v, ids in holders.items()}, dict.fromkeys(holders, 0), set(), []

    def rank(v: tuple) -> tuple:
        while first[v] < len(holders[v]) and holders[v][first[v]] in gone:
            first[v] += 1
        return -size[v], v[0], holders[v][min(first[v], len(holders[v]) - 1)], v[1]

    heap = [(rank(v), v) for v in holders]
    heapq.heapify(heap)
    while heap:
        was, v = heapq.heappop(heap)
        if size[v] < 2:
            continue
        if (now := rank(v)) != was:  # ranks only fall
            heapq.heappush(heap, (now, v))
            continue
        for i in [i for i in holders[v] if i not in gone]:
            out.append((*v, i))
            gone.add(i)
            for other in of[i]:
                size[other] -= 1
    columns = [pa.array([x[k] for x in out], kind) for k, kind in enumerate((pa.int32(), pa.string(), pa.int64()))]
    cluster = table.column("cluster_id")
    return pa.table([pa.array([cluster[0].as_py()] * len(out), cluster.type), *columns], names=["cluster_id", "o", "str", "gd_id"])


def _picked_sets(members: DataFrame, attrs: DataFrame) -> DataFrame:
    order = F.create_map(*(F.lit(x) for k, a in enumerate(ORDER) for x in (a, k)))
    rows = attrs.where(F.col("attr").isin(*ORDER)).select("gd_id", order[F.col("attr")].alias("o"), "str").distinct()
    rows = materialize(members.select("cluster_id", "gd_id").distinct().join(rows, "gd_id").select("cluster_id", "gd_id", "o", "str"), "worklist")
    found, more = [], True
    for _ in range(ROUNDS):
        judged = materialize(_first_picks(rows), "picks")
        found.append(judged.where("picked").drop("picked"))
        open_ = judged.where("not picked").select("cluster_id", "gd_id")
        more = not open_.isEmpty()
        if not more:
            break
        # a record that shares nothing any more, or is picked, drops out; the others are split anew without them
        left = materialize(rows.join(open_, ["cluster_id", "gd_id"], "left_semi"), "worklist")
        discard(rows)
        rows = left
    if more:
        kind = rows.schema["cluster_id"].dataType.simpleString()
        found.append(rows.groupBy("cluster_id").applyInArrow(_pick_alone, f"cluster_id {kind}, o int, str string, gd_id bigint"))
    else:
        discard(rows)
    picks = found[0].withColumn("gd_id", F.col("gd_id").cast("bigint"))
    for part in found[1:]:
        picks = picks.unionByName(part.withColumn("gd_id", F.col("gd_id").cast("bigint")))
    # a set has at most as many members as the gate lets through
    return picks.groupBy("cluster_id", "o", "str").agg(F.array_sort(F.collect_list("gd_id")).alias("ids")).select("cluster_id", "ids")


def related_sets(clusters: DataFrame, attrs: DataFrame, gate: int = 25_000, prune: bool = True, witness: bool = True) -> DataFrame:
    """``cluster_id, ids`` of the related sets of clusters with 2 to ``gate`` records.

    The sets that stay are those that the splitting takes by a shared value from what is left of a cluster, so they are found for
    all clusters at once, from a worklist of records and the values they still share. In every round each value that outranks
    all others of its holders is taken. Values that wait for each other in a row need a round each; what ``ROUNDS`` rounds
    leave of a cluster is taken one value after another.

    With ``prune`` or ``witness`` off all sets that the splitting comes upon are wanted, in the order of its steps; then
    each cluster is split alone by :func:`drill_down`.
    """
    sizes = clusters.groupBy("cluster_id").agg(F.count_distinct("gd_id").alias("n")).where(F.col("n").between(2, gate))
    members = clusters.join(sizes, "cluster_id")
    if prune and witness:
        return _picked_sets(members, attrs)
    rows = members.join(attrs.where(F.col("attr").isin(*ORDER)).select("gd_id", "attr", "str").distinct(), "gd_id", "left")

    def split(pdf: pd.DataFrame) -> pd.DataFrame:
        values: dict[int, dict[str, list[str]]] = {}
        for gd, attr, s in pdf.sort_values(["gd_id", "attr", "str"])[["gd_id", "attr", "str"]].itertuples(index=False):
            own = values.setdefault(int(gd), {})
            if isinstance(attr, str):
                own.setdefault(attr, []).append(s)
        sets = drill_down(values, prune, witness)
        return pd.DataFrame({"cluster_id": pd.Series([int(pdf["cluster_id"].iloc[0])] * len(sets), dtype="int64"), "ids": pd.Series([list(s) for s in sets], dtype=object)})

    kind = members.schema["cluster_id"].dataType.simpleString()
    return rows.select("cluster_id", "gd_id", "attr", "str").groupBy("cluster_id").applyInPandas(split, f"cluster_id {kind}, ids array<bigint>")


def leftovers(clusters: DataFrame, sets: DataFrame) -> DataFrame:
    """Clustered records that are in no related set, with their cluster."""
    placed = sets.select(F.explode("ids").alias("gd_id")).distinct()
    shared = clusters.groupBy("cluster_id").agg(F.count("*").alias("n")).where("n > 1").select("cluster_id")
    return clusters.join(shared, "cluster_id").join(placed, "gd_id", "left_anti")
