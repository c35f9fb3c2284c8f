"""Dictionaries, stores and numbers that are kept from load to load."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from bibweave.operators import growing
from bibweave.operators.catalog import file_ids
from bibweave.operators.clusters import identifier_clusters
from bibweave.operators.dictionary import Dictionary
from bibweave.operators.growing import Clusters, Components
from bibweave.operators.lookup import find_records
from bibweave.operators.postings import Postings, kept_postings
from bibweave.plans.components import connected_components
from bibweave.plans.numbers import numbered
from bibweave.plans.stored import Loads
from bibweave.streaming.ingest import Store, lines_of


def test_numbers_are_dense_and_in_order(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("place"), F.lit("x").alias("number_"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = [(r["place"], r["n"]) for r in numbered(df, "place", name="n", start=10).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(got) == [(p, 10 + i) for i, p in enumerate(sorted(p for p, _ in got))]
    assert numbered(df.where("false"), "place").collect() == []
    ties = numbered(spark.createDataFrame([(None,), ("a",), ("a",), ("b",)], "s string"), "s").orderBy("number").collect()
    assert [tuple(r) for r in ties] == [(None, 0), ("a", 1), ("a", 2), ("b", 3)]


def test_file_ids(spark):
    df = spark.createDataFrame([(x,) for x in ("b", "a", "c", "a", "b")], "file_path string")
    assert sorted(tuple(r) for r in file_ids(df).collect()) == [("a", 1), ("b", 2), ("c", 3)]


def test_dictionary_over_several_loads(spark, tmp_path):
    words = Dictionary(spark, str(tmp_path / "d"))
    frame = lambda values: spark.createDataFrame([(v,) for v in values], "str string")
    assert words.entries().collect() == [] and words.insert(frame([])) == 0
    assert words.insert(frame(["b", "a", "b", None, ""])) == 3
    before = {r["str"]: r["str_id"] for r in words.entries().collect()}
    assert before == {"": 1, "a": 2, "b": 3}
    assert words.insert(frame(["c", "a", "A", "é"] * 50), 7) == 3
    assert words.insert(frame(["zz"]), 7) == 0  # the load is there
    words = Dictionary(spark, str(tmp_path / "d"))  # opened anew
    after = {r["str"]: r["str_id"] for r in words.entries().collect()}
    assert after == before | {"A": 4, "c": 5, "é": 6}
    coded = words.encode(frame(["a", "c", "none", None]))
    assert {(r["str"], r["str_id"]) for r in coded.collect()} == {("a", 2), ("c", 5), ("none", None), (None, None)}
    assert {r["str"] for r in words.decode(coded.select("str_id").where("str_id is not null")).collect()} == {"a", "c"}


def test_a_load_that_died_is_not_read_and_made_again(spark, tmp_path):
    loads = Loads(spark, str(tmp_path / "t"), "x long")
    assert loads.write(spark.range(3).toDF("x"), 0) and not loads.write(spark.range(9).toDF("x"), 0)
    half = tmp_path / "t" / "load=1"
    spark.range(5).toDF("x").write.parquet(str(half))
    (half / "_SUCCESS").unlink()
    assert loads.numbers() == [0] and loads.read().count() == 3
    assert loads.write(spark.range(2).toDF("x"), 1)
    assert sorted((r["load"], r["x"]) for r in loads.read().collect()) == [(0, 0), (0, 1), (0, 2), (1, 0), (1, 1)]


def test_store_takes_each_content_once_for_ever(spark, tmp_path):
    schema = "id long, title string"
    store = Store(spark, str(tmp_path / "s"), schema, ["title"], ["id"])
    rows = lambda *x: spark.createDataFrame(list(x), schema)
    assert store.insert(rows((3, "a"), (1, "a"), (2, None), (4, None)), 0) == 2
    assert store.insert(rows((9, "a"), (5, "b")), 1) == 1
    assert store.insert(rows((9, "a"), (6, "c")), 1) == 0  # the same load again
    assert store.insert(rows(), 2) == 0
    assert sorted((r["id"], r["title"], r["load"]) for r in store.read().collect()) == [(1, "a", 0), (2, None, 0), (5, "b", 1)]


def test_stream_is_loaded_as_files_arrive(spark, tmp_path):
    source, schema = tmp_path / "in", "id long, title string"
    source.mkdir()
    store = Store(spark, str(tmp_path / "s"), schema, ["title"], ["id"])
    for n, rows in enumerate(([(1, "a"), (2, "b")], [(3, "b"), (4, "c")], [], [(5, "a"), (6, "d")])):
        if rows:
            (source / f"{n}.json").write_text("no object\n" + "\n".join(json.dumps({"id": i, "title": t}) for i, t in rows))
        store.follow(lines_of(spark, str(source), schema), str(tmp_path / "progress")).awaitTermination()
    assert sorted((r["id"], r["title"]) for r in store.read().collect()) == [(1, "a"), (2, "b"), (4, "c"), (6, "d")]
    assert len(store.loads.numbers()) == 3


@pytest.mark.parametrize("key", [None, "ID"])
def test_table_of_a_database(spark, tmp_path, key):
    from bibweave.sources import jdbc

    url = f"jdbc:derby:{tmp_path}/db"
    spark.range(100).selectExpr("id as ID", "concat('t', id) as TITLE").write.format("jdbc").options(url=url + ";create=true", dbtable="BIBS", driver="org.apache.derby.iapi.jdbc.AutoloadedDriver").save()
    given = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    read = jdbc.read_table(spark, url, "BIBS", key, parts=4, **given)
    assert read.rdd.getNumPartitions() == (4 if key else 1)
    some = read.where("ID >= 90").select("TITLE")
    assert "PushedFilters: [*IsNotNull(ID), *GreaterThanOrEqual(ID,90)]" in some._jdf.queryExecution().toString()
    assert sorted(r["TITLE"] for r in some.collect()) == [f"t{i}" for i in range(90, 100)]
    if key:
        assert jdbc.bounds_of(spark, url, "BIBS", key, **given) == (0, 99)
        sizes = [len(x) for x in read.rdd.glom().collect()]
        assert min(sizes) >= 20


def test_components_in_loads_match_a_full_run(spark, tmp_path):
    r = random.Random(5)
    kept, so_far = Components(spark, str(tmp_path / "c")), []
    for load in range(4):
        edges = [(a, a if r.random() < 0.1 else r.randrange(120 * (load + 1))) for a in (r.randrange(120 * (load + 1)) for _ in range(45))] + [(None, 3)]
        so_far += edges
        df = spark.createDataFrame(edges, "u long, v long")
        kept.insert(df, load)
        if load == 2:
            kept.insert(df, load)  # given twice
        full = connected_components(spark.createDataFrame(so_far, "u long, v long"))
        assert {tuple(x) for x in kept.read().collect()} == {tuple(x) for x in full.collect()}
    before = kept.labels.read().count()
    kept.insert(spark.createDataFrame([(5000, 5001)], "u long, v long"), 4)  # touches no cluster
    assert kept.labels.read().count() == before + 2 and kept.merged.read().where("load = 4").count() == 0
    # a load that died between its two tables is made again as a whole
    (tmp_path / "c" / "merged" / "load=4" / "_SUCCESS").unlink()
    (tmp_path / "c" / "labels" / "load=4" / "_SUCCESS").unlink()
    kept.insert(spark.createDataFrame([(5000, 5001), (5000, 1)], "u long, v long"), 4)
    full = connected_components(spark.createDataFrame([*so_far, (5000, 5001), (5000, 1)], "u long, v long"))
    assert {tuple(x) for x in kept.read().collect()} == {tuple(x) for x in full.collect()}


def test_clusters_in_loads_match_a_full_run(spark, tmp_path):
    r = random.Random(6)
    rows = [(r.randrange(300), r.choice(["oclc", "sudoc", "lccn", "issn", "title"]), f"v{r.randrange(260)}") for _ in range(420)]
    df = spark.createDataFrame(rows, "gd_id long, attr string, str string")
    kept = Clusters(spark, str(tmp_path / "c"))
    for load in range(3):
        kept.insert(df.where(F.col("gd_id") % 3 == 2 - load), load)  # the smallest member may come last
    assert {tuple(x) for x in kept.read().collect()} == {tuple(x) for x in identifier_clusters(df, 0).collect()}


def test_clusters_of_a_load_given_again_are_not_made_again(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(1, "oclc", "a"), (2, "oclc", "a"), (3, "lccn", "b")], "gd_id long, attr string, str string")
    kept = Clusters(spark, str(tmp_path / "c"))
    kept.insert(df, 0)
    monkeypatch.setattr(growing, "materialize", lambda *a, **k: pytest.fail("a load that is there was read again"))
    kept.insert(df, 0)
    assert sorted(tuple(x) for x in kept.read().collect()) == [(1, 1), (2, 1), (3, 3)]


def test_postings_answer_as_a_scan_does(spark, tmp_path):
    r = random.Random(7)
    rows = [(i, a, f"{a}{min(9, int(r.expovariate(0.5)))}") for i in range(400) for a in ("oclc", "title", "enumc") for _ in range(r.randrange(3))]
    attrs = spark.createDataFrame(rows + rows[:50], "gd_id long, attr string, str string")
    index = kept_postings(attrs, str(tmp_path / "p"))
    ids = lambda df: sorted(x["gd_id"] for x in df.collect())
    for clauses in ([("oclc", "oclc0")], [("oclc", "oclc0"), ("title", "title1")], [("oclc", "oclc2"), ("title", "title0"), ("enumc", "enumc0")], [("oclc", "none"), ("title", "title0")], []):
        assert ids(index.find(clauses)) == ids(find_records(attrs, clauses))
    gone = {i for i, a, v in rows if (a, v) == ("title", "title0")}
    assert ids(index.find([("oclc", "oclc0")], [("title", "title0")])) == [i for i in ids(find_records(attrs, [("oclc", "oclc0")])) if i not in gone]
    assert [x["str"] for x in index.strings("title").collect()] == sorted({v for _, a, v in rows if a == "title"})
    assert index.size("oclc", "oclc0") == len({i for i, a, v in rows if v == "oclc0"})
    plan = Postings(spark, str(tmp_path / "p")).holders("oclc", "oclc0")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(attr" in plan and "(bucket" in plan.split("PartitionFilters")[1].split("]")[0]
