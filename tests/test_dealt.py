"""Work that grows with a table is dealt over tasks whose number grows with it."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from bibweave.operators.postings import kept_postings
from bibweave.plans.spread import dealt, ranged
from tests.conftest import DATA


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["flt6_marc_grep", "src1_json_records", "mrc10_json_round_trip", "prj5_attributes", "mrc13_dublin_core"])
def test_records_are_parsed_after_parts_are_dealt(spark, name):
    """A condition on records is not moved into the scan of a small file."""
    plan = optimized(entry.queries()[name](spark, DATA))
    assert plan.rindex("from_json") < plan.index("Repartition")


def test_records_carry_columns_of_their_part(spark):
    """They need not be joined to the parts that they were made of."""
    assert "Join" not in optimized(entry.queries()["mrc13_dublin_core"](spark, DATA))


@pytest.mark.parametrize("name", ["agg1_value_counts", "dml5_rewrite_values"])
def test_rows_that_a_task_holds_are_bounded(spark, monkeypatch, name):
    """The parts of a table that is sorted or gathered are as many as its rows call for, and nothing is moved ahead of them."""
    monkeypatch.setitem(dealt.__kwdefaults__, "rows", 1000)
    plan = optimized(entry.queries()[name](spark, DATA))
    assert any(int(n) >= 6 for n in re.findall(r"RepartitionByExpression \[.*?\], (\d+)", plan))
    assert "LeftSemi" not in plan[plan.index("Repartition") :]


@pytest.mark.parametrize("name, keys", [
    ("sco1_cluster_scores", ["set_id", "value"]), ("agg16_checksum_scores", ["set_id", "value"]), ("flt8_in_list", ["gd_id"]),
    ("rul1_equal_lists", ["id", "o_id"]), ("rul2_overlapping_lists", ["l_orderkey"]), ("rul2_overlapping_lists", ["id", "o_id"]),
])
def test_tables_are_dealt_before_they_are_grouped_or_joined(spark, monkeypatch, name, keys):
    """What a task sorts or gathers of them does not grow with the tables."""
    monkeypatch.setitem(dealt.__kwdefaults__, "rows", 1000)
    plan = optimized(entry.queries()[name](spark, DATA))
    assert any(int(n) >= 3 for n in re.findall(rf"RepartitionByExpression \[{', '.join(rf'{k}#\d+L?' for k in keys)}\], (\d+)", plan))


def test_postings_are_dealt_in_parts_of_bounded_size(spark, monkeypatch, tmp_path):
    """The files of a table that grows are more, not larger; a value of many records is counted over several parts."""
    monkeypatch.setitem(dealt.__kwdefaults__, "rows", 1000)
    monkeypatch.setitem(ranged.__kwdefaults__, "rows", 1000)
    attrs = spark.range(20_000).selectExpr("id as gd_id", "'a' as attr", "if(id % 2 = 0, 'hot', cast(id as string)) as str")
    index = kept_postings(attrs.union(attrs), str(tmp_path / "p"))
    assert max(r["count"] for r in index.rows().groupBy(F.input_file_name()).count().collect()) < 3000
    assert max(r["count"] for r in index.counts().groupBy(F.input_file_name()).count().collect()) < 3000
    assert index.size("a", "hot") == 10_000 and index.counts().count() == 10_001
