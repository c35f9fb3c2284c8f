"""The pipeline's stages on small tables, each against a plain version over what it was given."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from bibweave.llm import decontaminate as dc
from bibweave.llm.quality import score_quality
from bibweave.plans.scratch import materialize
from tests.compare import frame_rows, sql_rows
from tests.conftest import DATA
from tests.llm import brute


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, DATA), name)
        kept.append(docs)
        if name != "packing":
            assert docs.columns == columns
    raw = spark.read.parquet(f"{DATA}/documents.parquet")
    good, lined, unique, clean, packed = kept
    low = {r["doc_id"] for r in score_quality(raw, spark.read.parquet(f"{DATA}/labels.parquet")).where("score < 0.3").collect()}
    assert set(texts(good)) == set(texts(raw)) - low and low
    dull = brute.boilerplate([(r["source"], r["text"]) for r in good.collect()], 0.05, 2)
    for r in good.collect():
        want = "\n".join(x for x in r["text"].split("\n") if x.strip(" \t\n\x0b\x0c\r") not in dull.get(r["source"], ()))
        assert texts(lined)[r["doc_id"]] == want
    assert lined.where(F.col("n_chars") != F.length("text")).count() == 0
    groups, _ = brute.near_duplicates(texts(lined), 5)
    assert set(texts(unique)) == {i for i, g in groups.items() if i == g}
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()}
    leaks = {d for d, _ in brute.contaminated(texts(unique), items, set(dc.UNITS.split()))}
    assert set(texts(clean)) == set(texts(unique)) - leaks
    assert {r["doc_id"] for r in packed.collect()} == set(texts(clean))
    whole = corpus_pipeline.run(spark, DATA)
    assert frame_rows(whole.select("doc_id", "start", "length", "ids_crc32")) == frame_rows(packed.select("doc_id", "start", "length", "ids_crc32"))


ODD = [
    (1, None, "en", "a", None), (2, "", "en", None, 0), (None, "no id " * 40, None, "a", 1), (None, None, None, None, None), (3, "hello", "en", "a", 5), (4, "# Heading", "en", "a", 9),
    (5, "same text of a few words " * 30, "en", "b", 1), (5, "same text of a few words " * 30, "en", "b", 1), (6, "same text of a few words " * 30, "en", "b", 1), (7, "long " * 100_000, "en", "c", 500_000), (8, "Dr.Müller", "de", "c", 9),
]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_odd_rows_and_empty_tables(spark, name):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = spark.createDataFrame(ODD, schema)
    extra = docs.select("*", *(F.lit("x").alias(c) for c in ("bad", "row", "at", "host", "salt", "n_lines", "h", "rep", "start", "length")))
    want = {"quality": None, "lines": 11, "near_duplicate": 10, "decontamination": 11}.get(name)
    for df in (docs, extra):
        got = stage(spark, df, DATA).collect()
        if name == "packing":
            assert sorted(r["doc_id"] or 0 for r in got if r["start"] == 0) == sorted(r[0] or 0 for r in ODD)
        else:
            assert len(got) == want if want else len(got) >= 2
            assert [r["doc_id"] for r in got].count(None) == 2
            assert all(r["n_chars"] is None or r["n_chars"] == len(r["text"] or "") for r in got) if name == "lines" else True
        assert stage(spark, df.where("false"), DATA).count() == 0


@pytest.mark.parametrize("names", [("n_lines", "n_dropped"), ("N_LINES", "N_Dropped"), ("row", "at"), ("Rest", "dull")])
def test_lines_keep_the_callers_columns(spark, names):
    rows = [(i, f"menu\nown {i}", "en", "s", 9, i + 77, f"x{i}") for i in range(8)]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {names[0]} long, {names[1]} string")
    got = corpus_pipeline.lines(spark, docs, DATA)
    assert got.columns == docs.columns
    assert sorted(tuple(r) for r in got.collect()) == [(i, f"own {i}", "en", "s", 5, i + 77, f"x{i}") for i in range(8)]


@pytest.mark.parametrize("name", ["op1_near_duplicates", "op3_exact_duplicates", "op10_site_lines", "op11_phrases", "op12_hard_negatives"])
def test_query_agrees_with_its_sql(spark, name):
    assert frame_rows(entry.queries()[name](spark, DATA)) == sql_rows(DATA, entry.oracle_sql()[name])
