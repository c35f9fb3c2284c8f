from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from bibweave.operators import clusters as cl
from bibweave.operators import rules as ru
from bibweave.operators import titles as tt
from bibweave.operators.catalog import split_enumerations, split_holdings
from bibweave.operators.related import drill_down, leftovers, related_sets
from bibweave.plans import components
from bibweave.plans.components import connected_components
from bibweave.plans.scratch import materialize

ATTRS = "gd_id bigint, attr string, str string, marc_field string"


def attrs(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], ATTRS)


def test_components_match_union_find(spark):
    rng = random.Random(5)
    for n, m in ((1, 0), (40, 30), (60, 200)):
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] + [(i, i + 1) for i in range(100, 130)] + [(None, 3), (7, None)]
        parent = {x: x for e in edges if None not in e for x in e}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in edges:
            if a is not None and b is not None:
                a, b = find(a), find(b)
                parent[max(a, b)] = min(a, b)
        got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
        assert got == {x: find(x) for x in parent}


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_merged_nodes_are_not_carried_through_rounds(spark, monkeypatch):
    """What rounds after the first work on are the nodes that others were merged into, so a round over all edges is made once."""
    sizes = []

    def counted(df, name, *more, **given):
        out = materialize(df, name, *more, **given)
        if name == "edges":
            sizes.append(out.count())
        return out

    monkeypatch.setattr(components, "materialize", counted)
    # 20 stars of 100, tied in a row by members of theirs
    edges = [(100 * s, 100 * s + i) for s in range(20) for i in range(1, 100)] + [(100 * s + 7, 100 * s + 150) for s in range(19)]
    got = connected_components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()
    assert len(got) == 2000 and {r["component"] for r in got} == {0}
    assert sizes[0] == len(edges) and all(n <= 2 * 19 for n in sizes[1:])


@pytest.mark.parametrize("order", ["up", "down", "mixed", "zigzag"])
def test_components_of_long_paths(spark, order):
    """Paths hardly shrink by merging into neighbours, so they are left to the rounds of stars."""
    ids = list(range(3, 303))
    if order == "down":
        ids.reverse()
    elif order == "mixed":
        random.Random(3).shuffle(ids)
    elif order == "zigzag":
        ids = [x for pair in zip(ids[:150], ids[:149:-1]) for x in pair]
    edges = [*zip(ids, ids[1:]), (900, 900), (901, None)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {**dict.fromkeys(ids, 3), 900: 900}


def test_identifier_clusters(spark):
    a = attrs(spark, [(1, "oclc", "o1"), (2, "oclc", "o1"), (2, "sudoc", "s1"), (3, "sudoc", "s1"), (4, "lccn", "l1"), (5, "title", "t")])
    got = cl.identifier_clusters(a, skip=0)
    assert {r["gd_id"]: r["cluster_id"] for r in got.collect()} == {1: 1, 2: 1, 3: 1, 4: 4}
    relation = cl.cluster_relations(a.select("gd_id"), got, gate=2)
    assert {r["gd_id"]: r["relation"] for r in relation.collect()} == {1: "huge", 2: "huge", 3: "huge", 4: "solo", 5: "unkeyed"}


def test_score(spark):
    a = attrs(spark, [(i, "oclc", "555") for i in (22, 33, 44)] + [(22, "publisher", "congress"), (33, "publisher", "congress"), (44, "publisher", "senate")])
    members = spark.createDataFrame([(1, i) for i in (22, 33, 44)], "set_id int, gd_id bigint")
    assert cl.score_sets(members, a, whole_lists=False).first()["score"] == pytest.approx(0.5787037037)


CASES = {
    "leftover": ({1: "oclc10", 2: "oclc10 sudoc20", 3: "sudoc20"}, [(1, 2)], [(1, 2)]),
    "superset": (
        {1: "oclc10 sudoc20", 2: "oclc10 sudoc20", 3: "oclc10 lccn40", 4: "oclc10 lccn40 sudoc30", 5: "sudoc30"},
        [(1, 2), (3, 4), (1, 2, 3, 4)], [(1, 2, 3, 4)],
    ),
    "unrelated": ({1: "oclc1 sudoc2", 2: "oclc1 lccn3", 3: "oclc1", 4: "sudoc2", 5: "lccn3"}, [(1, 2, 3), (4, 5)], [(1, 2, 3)]),
}


def _values(case):
    out: dict = {}
    for i, text in case.items():
        for word in text.split():
            kind = word.rstrip("0123456789")
            out.setdefault(i, {}).setdefault(kind, []).append(word)
    return out


@pytest.mark.parametrize("name", CASES)
def test_drill_down(name):
    case, faithful, pruned = CASES[name]
    assert sorted(drill_down(_values(case), prune=False, witness=False)) == sorted(faithful)
    assert drill_down(_values(case)) == pruned


def test_related_sets_and_leftovers(spark):
    rows = [(i, kind, v) for i, kinds in _values(CASES["superset"][0]).items() for kind, vs in kinds.items() for v in vs]
    rows += [(10, "oclc", "z"), (11, "oclc", "z")]
    a = attrs(spark, rows)
    c = cl.identifier_clusters(a, skip=0)
    sets = related_sets(c, a)
    assert sorted(tuple(r["ids"]) for r in sets.collect()) == [(1, 2, 3, 4), (10, 11)]
    assert [r["gd_id"] for r in leftovers(c, sets).collect()] == [5]


def test_duplicates_within_a_set(spark):
    a = attrs(spark, [(1, "enumc", "v1"), (2, "enumc", "v2"), (3, "enumc", "v1"), (4, "enumc", "v2")])
    sets = spark.createDataFrame([(1, i) for i in range(1, 7)], "set_id int, gd_id bigint")
    assert sorted(r["ids"] for r in cl.duplicate_sets(sets, a).collect()) == [[1, 3], [2, 4], [5, 6]]


@pytest.mark.parametrize(
    "docs, lines",
    [
        ({1: [], 2: []}, {("duplicates", (1, 2))}),
        ({1: ["v1"], 2: ["v1"]}, {("duplicates", (1, 2))}),
        ({1: ["v1"], 2: ["v2"]}, {("related", (1, 2))}),
        ({1: ["v1"], 2: ["v1"], 3: ["v2"]}, {("duplicates*", (1, 2)), ("related*", (1, 2, 3))}),
        ({1: ["v1", "v2"], 2: ["v3"]}, {("unclear", (1, 2))}),
        ({1: ["v1"], 2: ["v1"], 3: ["v1", "v2", "v3"]}, {("related", (1, 2, 3))}),
        ({1: []}, {("solo", (1,))}),
    ],
)
def test_relations(spark, docs, lines):
    a = attrs(spark, [(i, "enumc", v) for i, vs in docs.items() for v in vs] or [(0, "enumc", "x")])
    members = spark.createDataFrame([(1, i) for i in docs], "set_id int, gd_id bigint")
    assert {(r["relation"], tuple(r["ids"])) for r in cl.classify_groups(members, a).collect()} == lines


def test_resolution_is_one_hop(spark):
    links = spark.createDataFrame([("v1", 5), ("v1", 9), ("v2", 9), ("v2", 12)], "volume_id string, oclc bigint")
    mapping = cl.resolve_canonical(links)
    assert {(r["old"], r["new"]) for r in mapping.collect()} == {(9, 5), (12, 9)}
    a = attrs(spark, [(1, "oclc", "9"), (1, "oclc", "5"), (2, "oclc", "12"), (3, "title", "9")])
    assert {(r["gd_id"], r["str"]) for r in cl.apply_resolution(a, mapping).collect()} == {(1, "5"), (2, "9"), (3, "9")}


def test_title_matches(spark):
    words = {1: "a b c d", 2: "a b c d e", 3: "a b x y", 4: "p q r s t u v", 5: "p q r s t u w"}
    found = tt.match_words(tt.word_bags(attrs(spark, [(i, "title", w) for i, w in words.items()]))).collect()
    assert [(r["id"], r["other_id"], r["score"]) for r in found] == [(1, 2, 0.533)]


def test_bands(spark):
    pairs = spark.createDataFrame([(1, 2, 0.9), (2, 3, 0.6), (7, 8, 0.75), (9, 10, -0.2)], "id bigint, other_id bigint, score double")
    got = {(r["band"], r["gd_id"], r["cluster_id"]) for r in tt.band_clusters(pairs).collect()}
    assert got == {("high", 1, 1), ("high", 2, 1), ("low", 2, 2), ("low", 3, 2), ("low", 7, 7), ("low", 8, 7)}


def test_cascade_does_not_fall_through(spark):
    schema = "id bigint, oclc array<string>, lccn array<string>, issn array<string>, enum_chron array<string>"
    rows = [(1, ["a", "b"], [], [], []), (2, ["b"], [], [], []), (3, [], ["l"], ["i"], ["v1"]), (4, [], ["l"], ["i"], ["v2"]), (5, ["a"], [], [], ["v9"])]
    got = {(r["id"], r["o_id"]): r["verdict"] for r in ru.cascade(all_pairs(spark.createDataFrame(rows, schema))).collect()}
    assert {k: v for k, v in got.items() if v != "unr"} == {(1, 2): "dup", (1, 5): "rel"} and got[3, 4] == "unr"


def test_f1(spark):
    rows = lambda sets: spark.createDataFrame([(k, m) for k, s in sets.items() for m in s], "set_id int, member string")
    found, answers = rows({1: "ab", 2: "xy", 3: "q"}), rows({1: "abc", 2: "xy"})
    assert {r["set_id"]: r["f1"] for r in ru.best_f1(found, answers).collect()} == {1: pytest.approx(0.8), 2: 1.0, 3: 0.0}
    assert ru.mean_f1(found, answers).first()["f1"] == pytest.approx(0.9)


def test_splits(spark):
    rows = [(976, ["vol 1", "volume 2"], ["i1"]), (978, ["v5"], ["i1", "i2"]), (979, None, ["i1", "i2"]), (980, [], []), (981, ["b", "a", "b"], None)]
    df = spark.createDataFrame(rows, "id int, enumc array<string>, item_id array<string>")
    got = sorted((r["id"], r["enumc"]) for r in split_enumerations(df).where("enumc is not null").collect())
    assert got == [(976, "vol 1"), (976, "volume 2"), (978, "v5"), (981, "a"), (981, "b")]
    held = sorted((r["id"], r["enumc_value"] or "", r["item_value"] or "") for r in split_holdings(df).collect())
    assert held == [(976, "vol 1", "i1"), (976, "volume 2", ""), (978, "v5", "i1"), (979, "", "i1"), (980, "", ""), (981, "b", "")]


def plain_drill_down(values):
    """The separation as it is described, without a loop: every step calls itself for the holders and for the rest."""
    sets = []

    def step(ids, tried):
        if len(ids) < 2:
            return False
        best = None
        for attr in ("oclc", "sudoc", "lccn", "issn", "title"):
            if attr in tried:
                continue
            order = []
            for i in ids:
                order += [v for v in values[i].get(attr, ()) if v not in order]
            for v in order:
                held = [i for i in ids if v in values[i].get(attr, ())]
                if len(held) == len(ids):
                    tried.append(attr)
                    sets.append(tuple(ids))
                    return True
                if len(held) > 1 and (best is None or len(held) > len(best[1])):
                    best = attr, held
        if best is None:
            return False
        tried.append(best[0])
        if not step(best[1], tried):
            sets.append(tuple(best[1]))
        rest = [i for i in ids if i not in best[1]]
        if len(rest) > 1 and not step(rest, []):
            sets.append(tuple(rest))
            return True
        return False

    step(sorted(values), [])
    return sets


def test_drill_down_matches_a_plain_version():
    r = random.Random(4)
    for n in range(300):
        kinds = r.sample(["oclc", "sudoc", "lccn", "issn", "title"], r.randrange(1, 6))
        values = {i: {k: sorted({f"v{r.randrange(1 + n % 6)}" for _ in range(r.randrange(3))}) for k in kinds} for i in range(r.randrange(2, 14))}
        want = plain_drill_down(values)
        assert drill_down(values, prune=False, witness=False) == want
        shared = [s for s in want if any(set.intersection(*(set(values[i].get(k, ())) for i in s)) for k in kinds)]
        assert drill_down(values) == sorted(s for s in dict.fromkeys(shared) if not any(set(s) < set(t) for t in shared))


def test_drill_down_of_a_long_chain():
    # a remainder for every pair, many more than calls could nest
    values = {i: {"oclc": [f"v{i // 2}"]} for i in range(6000)}
    assert drill_down(values) == [(i, i + 1) for i in range(0, 6000, 2)]


def test_verdicts_are_those_of_all_pairs(spark):
    r = random.Random(6)
    some = lambda n: [f"x{r.randrange(n)}" for _ in range(r.randrange(3))]
    rows = [(i, *(some(n) for n in (9, 8, 8, 5, 4, 3, 3, 4, 3))) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, " + ", ".join(f"{f} array<string>" for f in ru.FIELDS))
    every = ru.with_both(df.select("id").crossJoin(df.select(F.col("id").alias("o_id"))).where("id < o_id"), df)
    for rule, groups in ((ru.cascade, ru.DECIDING), (ru.cascade_with_review, ru.DECIDING_WITH_REVIEW)):
        want, got = ({(x["id"], x["o_id"]): x["verdict"] for x in rule(p).where("verdict <> 'unr'").collect()} for p in (every, ru.decided_pairs(df, groups)))
        assert got == want and len(want) > 20


def test_shared_words(spark):
    r = random.Random(2)
    words = {i: {f"w{min(r.randrange(30), r.randrange(30))}" for _ in range(r.randrange(9))} for i in range(80)}
    rows = spark.createDataFrame([(i, w) for i, own in words.items() for w in own], "id int, word string")
    for least in (1, 2, 3):
        want = {(i, j): len(words[i] & words[j]) for i in words for j in words if i < j and len(words[i] & words[j]) >= least}
        assert {(x["id"], x["other_id"]): x["shared"] for x in tt.shared_words(rows, least).collect()} == want


def _frames(spark, clusters):
    members = [(i, c) for c, values in clusters.items() for i in values]
    rows = [(i, a, v) for values in clusters.values() for i, own in values.items() for a, vs in own.items() for v in vs]
    return spark.createDataFrame(members, "gd_id long, cluster_id long"), spark.createDataFrame(rows, "gd_id long, attr string, str string")


@pytest.mark.parametrize("rounds", [12, 1])
def test_related_sets_of_many_clusters_match_drill_down(spark, monkeypatch, rounds):
    monkeypatch.setattr("bibweave.operators.related.ROUNDS", rounds)
    r = random.Random(14)
    clusters = {}
    for c in range(250):
        kinds = r.sample(["oclc", "sudoc", "lccn", "issn", "title"], r.randrange(1, 6))
        ids = r.sample(range(c * 100, c * 100 + 100), r.randrange(2, 16))
        clusters[c] = {i: {k: sorted({f"v{r.randrange(1 + c % 7)}" for _ in range(r.randrange(3))}) for k in kinds} for i in ids}
    clusters[999] = {100_000 + i: {"oclc": [f"o{i}"], "title": [f"t{(i + 1) // 2}", f"u{i // 2}"]} for i in range(200)}  # values wait for each other in a row
    got = related_sets(*_frames(spark, clusters))
    want = sorted((c, s) for c, values in clusters.items() for s in drill_down(values))
    assert sorted((x["cluster_id"], tuple(x["ids"])) for x in got.collect()) == want and len(want) > 300
    if rounds == 1:
        faithful = related_sets(*_frames(spark, {c: clusters[c] for c in range(20)}), prune=False, witness=False)
        assert sorted(tuple(x["ids"]) for x in faithful.collect()) == sorted(s for c in range(20) for s in drill_down(clusters[c], prune=False, witness=False))


def test_related_sets_of_a_large_cluster(spark):
    # 20,000 records: stars of a title each, tied by numbers
    members = spark.range(20_000).select(F.col("id").alias("gd_id"), F.lit(0).cast("long").alias("cluster_id"))
    title = members.select("gd_id", F.lit("title").alias("attr"), F.concat(F.lit("t"), F.floor(F.sqrt("gd_id")).cast("string")).alias("str"))
    number = members.select("gd_id", F.lit("oclc").alias("attr"), F.concat(F.lit("o"), (F.col("gd_id") % 9973).cast("string")).alias("str"))
    sets = related_sets(members, title.unionByName(number)).collect()
    placed = [i for s in sets for i in s["ids"]]
    assert len(placed) == len(set(placed)) == 20_000 - sum(1 for i in range(20_000) if i not in set(placed)) and max(len(s["ids"]) for s in sets) == 281
    assert len(placed) > 19_000


def test_lists_of_groups_of_any_size(spark):
    rows = spark.range(3000).select((F.col("id") * 7 % 3001).alias("gd_id"), F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 100).cast("string"))).alias("k"))
    want = {}
    for r in rows.collect():
        want.setdefault(r["k"], set()).add(r["gd_id"])
    rows = rows.unionByName(rows.where("gd_id % 10 = 0")).unionByName(spark.createDataFrame([(None, "k2")], "gd_id long, k string"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for most in (10_000, 64):
            got, parts = {}, {}
            for r in sorted(cl.group_lists(rows, ["k"], 2, most).collect(), key=lambda r: r["part"]):
                assert r["ids"] == sorted(r["ids"]) and len(r["ids"]) <= most and r["n"] == len(want[r["k"]])
                assert r["part"] == parts.get(r["k"], -1) + 1
                parts[r["k"]] = r["part"]
                got.setdefault(r["k"], []).extend(r["ids"])
            assert got == {k: sorted(v) for k, v in want.items()}
            assert (max(parts.values()) > 10) == (most == 64)
        lines = [r["line"] for r in cl.list_lines(cl.group_lists(rows, ["k"], 2, 64), ["k"]).orderBy("line").collect()]
        assert lines[0].startswith("\t0\t") and any(x.startswith("hot\t3\t") for x in lines)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def all_pairs(records):
    """Every pair i < j of records, with both."""
    return ru.with_both(records.select("id").join(records.select(F.col("id").alias("o_id")), F.col("id") < F.col("o_id")), records)


RULED = "id long, oclc array<string>, lccn array<string>, issn array<string>, sudoc array<string>, title array<string>, agency array<string>, publisher array<string>, pub_date array<string>, enum_chron array<string>"


def test_sets_of_verdicts_match_their_pairs(spark):
    r = random.Random(1)
    some = lambda n, most: r.choice([None, []]) if r.random() < 0.25 else [f"v{r.randrange(n)}" for _ in range(r.randrange(1, most))]
    rows = []
    for block in range(12):  # values of blocks are kept apart, so there are many sets
        wide = 1 + block % 4
        for i in range(r.randrange(2, 14)):
            own = [some(2 * wide, 3) for _ in range(8)]
            rows.append((block * 100 + i, *([f"{block}{v}" for v in x] if x else x for x in own), some(1 + block % 5, 4)))
    records = spark.createDataFrame(rows, RULED)
    for verdict, tables in ((ru.cascade, ()), (ru.cascade_with_review, (ru.DUPLICATES_WITH_REVIEW, ru.RELATED_WITH_REVIEW))):
        pairs = verdict(all_pairs(records)).select("id", "o_id", "verdict").collect()
        want = set()
        for relation in ("dup", "rel"):
            links = [(p["id"], p["o_id"]) for p in pairs if p["verdict"] == relation]
            parent = {x: x for link in links for x in link}

            def find(x, parent=parent):
                while parent[x] != x:
                    x = parent[x]
                return x

            for a, b in links:
                a, b = find(a), find(b)
                parent[max(a, b)] = min(a, b)
            want |= {(relation, find(x), x) for x in parent}
        found = ru.verdict_sets(records, *tables)
        assert {tuple(x) for x in found.collect()} == want and {x[0] for x in want} == {"dup", "rel"}
        if tables:
            continue
        answers = spark.createDataFrame([("dup", i % 7, i) for i in range(0, 400, 3)] + [("rel", i % 5, i) for i in range(0, 900, 2)] + [("unr", 1, 1)], "relation string, set_id long, member long")
        judged = lambda df: sorted((x["relation"], x["found"], x["sought"], round(x["f1"], 9)) for x in df.collect() if x["relation"] != "unr")
        verdicts = spark.createDataFrame([tuple(p) for p in pairs if p["verdict"] != "unr"], "id long, o_id long, verdict string")
        assert judged(ru.evaluate_sets(found, answers)) == judged(ru.evaluate(verdicts, answers))


def test_sets_under_a_hot_key_take_no_pairs(spark):
    # one number for all: half of the records have the same enumeration, the others one each or several
    n = 10_000
    one = lambda x: F.array(x.cast("string"))
    i = F.col("id")
    enum = F.when(i % 2 == 0, F.array(F.lit("same"))).when(i % 5 == 0, F.array(i.cast("string"), (i + 2).cast("string"))).otherwise(one(i))
    records = spark.range(n).select("id", F.array(F.lit("hot")).alias("oclc"), one(i).alias("lccn"), enum.alias("enum_chron"))
    got = {r["relation"]: (r["sets"], r["members"]) for r in ru.verdict_sets(records).groupBy("relation").agg(F.count_distinct("set_id").alias("sets"), F.count("*").alias("members")).collect()}
    assert got["rel"] == (1, n)
    assert got["dup"][1] >= n // 2
    same = records.withColumn("enum_chron", F.array(F.lit("x"), i.cast("string")))  # all share one: nothing is related
    assert ru.verdict_sets(same).where("relation = 'rel'").count() == 0
