from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from bibweave.operators import rules as ru

RULES = ((ru.cascade, ru.CASCADE), (ru.cascade_with_review, ru.CASCADE_WITH_REVIEW))


def all_pairs(df, rule):
    pairs = df.crossJoin(df.select(*(F.col(c).alias(f"o_{c}") for c in df.columns))).where("id < o_id")
    return sorted(tuple(p) for p in rule(pairs).where("verdict <> 'unr'").select("id", "o_id", "verdict").collect())


@pytest.mark.parametrize("most, seed", [(1, 2), (2, 4), (3, 5)])
def test_verdicts_of_all_pairs_come_without_the_others(spark, monkeypatch, most, seed):
    monkeypatch.setattr(ru, "BLOCK", 3)
    monkeypatch.setattr(ru, "TASK_PAIRS", 20)
    r = random.Random(seed)
    some = lambda n: [r.choice([None, "x0", *(f"x{i}" for i in range(n))]) if most > 2 else f"x{r.randrange(n)}" for _ in range(r.randint(0, most))]
    rows = [(None if i == 7 else i // 2 if i < 6 else i, *(None if r.random() < 0.1 else some(n) for n in (9, 8, 8, 5, 3, 3, 2, 2, 3))) for i in range(70)]
    df = spark.createDataFrame(rows, "id int, " + ", ".join(f"{f} array<string>" for f in ru.FIELDS))
    for columns in (df.columns, [c for c in df.columns if c not in ("lccn", "enum_chron")]):
        part = df.select(*columns)
        for rule, lines in RULES:
            want = all_pairs(part, rule)
            assert sorted(tuple(p) for p in ru.verdict_pairs(part, lines).collect()) == want
            assert len(want) > 5 or "oclc" not in columns


@pytest.mark.parametrize("name", ["rul3_cascade", "rul4_cascade_with_review"])
def test_pairs_of_single_values_are_made_of_strings(spark, name):
    plan = entry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "arrays_overlap" not in plan and "array<string>" not in plan and "Join Inner" in plan
    assert "least(" in plan  # two blocks meet once
