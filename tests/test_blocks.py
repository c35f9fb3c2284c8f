from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from bibweave.operators import rules as ru
from bibweave.operators import titles as tt
from bibweave.plans import blocks


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(blocks, "MEMBERS", 3)
    monkeypatch.setattr(blocks, "PAIRS_A_TASK", 20)


def test_block_pairs_are_all_pairs_once(spark, small_blocks):
    r = random.Random(1)
    rows = [(r.choice("aaaabc"), i, f"n{i}") for i in range(60)]
    df = spark.createDataFrame(rows, "cls string, id long, name string")
    want = sorted((x[0], x[1], y[1], x[2], y[2]) for x in rows for y in rows if x[0] == y[0] and x[1] < y[1])
    assert sorted(tuple(p) for p in blocks.block_pairs(df).select("a", "id", "o_id", "name", "o_name").collect()) == want
    links = spark.createDataFrame([("a", "b", 7), ("b", "a", 8), ("c", "c", 9)], "a string, b string, w int")
    held = {("a", "b"): 7, ("b", "a"): 8, ("c", "c"): 9}
    want = sorted((x[1], y[1], held[x[0], y[0]]) for x in rows for y in rows if (x[0], y[0]) in held and x[1] < y[1])
    assert sorted(tuple(p) for p in blocks.block_pairs(df, links).select("id", "o_id", "w").collect()) == want
    assert blocks.block_pairs(df.where("false")).count() == 0


def test_a_group_of_equal_titles_is_dealt_in_blocks(spark, small_blocks):
    rows = spark.createDataFrame([(i, w) for i in range(40) for w in ("x", "y", "z")], "id long, word string")
    found = tt.shared_words(rows)
    assert sorted(tuple(p) for p in found.collect()) == [(i, j, 3) for i in range(40) for j in range(i + 1, 40)]
    assert found.groupBy(F.spark_partition_id().alias("p")).count().count() > 1  # one word's pairs are many tasks' work


def test_pairs_of_one_rule_key_are_dealt_in_blocks(spark, small_blocks):
    df = spark.createDataFrame([(i, ["o"], ["t"], [f"p{i % 2}"]) for i in range(40)], "id int, oclc array<string>, title array<string>, publisher array<string>")
    found = ru.decided_pairs(df, (("oclc",), ("title", "publisher")))
    assert sorted((p["id"], p["o_id"]) for p in found.collect()) == [(i, j) for i in range(40) for j in range(i + 1, 40)]
    plan = found._jdf.queryExecution().toString()
    assert "HashAggregate" not in plan and "_before" in plan  # pairs of both keys are told apart without gathering them


def test_classes_that_share_a_word_are_compared_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(tt, "CLASSES", 3)
    monkeypatch.setattr(tt, "COMPARED", 20)
    found = tt._meeting(spark.createDataFrame([(i, w) for i in range(40) for w in ("x", "y")], "a long, word string"))
    assert sorted(tuple(p) for p in found.collect()) == [(i, j) for i in range(40) for j in range(i + 1, 40)]
    assert found.groupBy(F.spark_partition_id().alias("p")).count().count() > 4
