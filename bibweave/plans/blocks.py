"""Pairs of the members of classes, made in blocks of bounded size however large a class is."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bibweave.plans.scratch import materialize

#: Members of a class that meet as many others in one block, pairs that are held against each other in a task, and the most tasks.
MEMBERS, PAIRS_A_TASK, MOST_TASKS = 4000, 10_000_000, 10_000


def block_pairs(members: DataFrame, links: DataFrame | None = None, size: int | None = None, pairs_a_task: int | None = None) -> DataFrame:
    """Every member of a class with every greater one of a linked class: their columns, those of the greater begin with ``o_``.

    ``members`` are ``cls, id`` and more, ``links`` ``a, b`` (classes of the lower and the greater ``id``) and more; without links each class
    meets itself. Members are dealt into chunks by their hash and each chunk goes once to every chunk it meets. The classes are
    ``a`` and ``b`` in the result. Nothing is left out, so there are as many rows as pairs. ``size`` are the members of a chunk and
    ``pairs_a_task`` the pairs of a task, fewer where much is done with each.
    """
    size, pairs_a_task = size or MEMBERS, pairs_a_task or PAIRS_A_TASK
    members = materialize(members, "members")
    sizes = materialize(members.groupBy("cls").agg(F.count("*").alias("size")), "sizes")
    if links is None:
        links = sizes.select(F.col("cls").alias("a"), F.col("cls").alias("b"))
    links = materialize(links, "links")
    of = lambda k: sizes.select(F.col("cls").alias(k), F.col("size").alias(f"size_{k}"))
    met = links.join(of("a"), "a").join(of("b"), "b")
    met = met.where("a <> b or size_a > 1")
    total = met.agg(F.sum(F.col("size_a").cast("double") * F.col("size_b")).alias("n")).first()["n"] or 0
    parts = max(1, min(MOST_TASKS, int(total / pairs_a_task) + 1))
    chunks = lambda k: F.ceil(F.col(f"size_{k}") / size).cast("int")
    met = met.withColumns({"of_a": chunks("a"), "of_b": chunks("b")})
    own = [c for c in members.columns if c != "cls"]
    more = [c for c in links.columns if c not in ("a", "b")]
    at = lambda k: F.pmod(F.xxhash64("id"), F.col(f"of_{k}")).cast("int")
    left = met.join(members.withColumnRenamed("cls", "a"), "a").select("a", "b", *more, *own, at("a").alias("i"), F.explode(F.sequence(F.lit(0), F.col("of_b") - 1)).alias("j"))
    right = met.join(members.withColumnRenamed("cls", "b"), "b").select("a", "b", *(F.col(c).alias(f"o_{c}") for c in own), at("b").alias("j"), F.explode(F.sequence(F.lit(0), F.col("of_a") - 1)).alias("i"))
    keys = ["a", "b", "i", "j"]
    out = left.repartition(parts, *keys).join(right.repartition(parts, *keys), keys).where("id < o_id").drop("i", "j")
    out._bibweave_tasks = parts
    return out
