"""Pairwise rules for duplicate, related and unrelated records, and their evaluation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bibweave.plans.blocks import block_pairs
from bibweave.plans.components import connected_components
from bibweave.plans.scratch import materialize

FIELDS = ("oclc", "lccn", "issn", "sudoc", "title", "agency", "publisher", "pub_date", "enum_chron")


def same_values(a, b) -> Column:
    """The key is there and both lists are equal."""
    return a.isNotNull() & a.eqNullSafe(b)


def shared_value(a, b, empty_is_equal: bool = False) -> Column:
    """Any value in common; for enumerations, two empty lists agree too."""
    a, b = F.coalesce(a, F.array().cast("array<string>")), F.coalesce(b, F.array().cast("array<string>"))
    # most lists are single values, for which no set need be made
    single = (F.size(a) == 1) & (F.size(b) == 1)
    none = (F.size(a) == 0) | (F.size(b) == 0)
    any_equal = F.coalesce(F.when(single, F.get(a, F.lit(0)) == F.get(b, F.lit(0))).when(none, F.lit(False)).otherwise(F.arrays_overlap(a, b)), F.lit(False))
    return (any_equal | ((F.size(a) == 0) & (F.size(b) == 0))) if empty_is_equal else any_equal


#: Fields that must all agree for a verdict other than unr, one line of each rule a group.
DECIDING = (("oclc",), ("lccn", "enum_chron"), ("issn",), ("sudoc", "title", "enum_chron"), ("title", "agency", "pub_date", "enum_chron"))
DECIDING_WITH_REVIEW = (("lccn", "title"), ("oclc", "title"), ("title", "publisher"))


def decided_pairs(records: DataFrame, groups=DECIDING) -> DataFrame:
    """Pairs of records that agree on all fields of a group, every pair once; all other pairs are unrelated.

    A frequent title or number alone makes no pair where the rule asks for more. Where only the sets that pairs form are
    wanted, :func:`verdict_sets` finds them without the pairs.
    Records without an enumeration agree on it. The pairs of a key are made in blocks, however many records hold it, and of several
    keys that two records share the first one gives the pair, so pairs are neither collected nor compared.
    """
    keys = None
    for n, group in enumerate(groups):
        if set(group) <= set(records.columns):
            part = records.select("id", *group)
            for f in group:
                values = F.coalesce(f, F.array().cast("array<string>"))
                if f == "enum_chron":
                    values = F.when(F.size(values) == 0, F.array(F.lit(None).cast("string"))).otherwise(values)
                part = part.withColumn(f, F.explode(values))
            part = part.select("id", F.concat(F.lit(f"{n}:"), F.to_json(F.array(*group), {"ignoreNullFields": "false"})).alias("key"))
            keys = part if keys is None else keys.unionByName(part)
    held = keys.groupBy("id").agg(F.array_sort(F.collect_set("key")).alias("keys"))
    rows = records.join(held, "id").select(*records.columns, F.posexplode("keys").alias("_at", "cls"), "keys")
    rows = rows.select("cls", *records.columns, F.slice("keys", F.lit(1), F.col("_at")).alias("_before"))
    apart = (F.size("_before") == 0) | (F.size("o__before") == 0) | ~F.arrays_overlap("_before", "o__before")
    pairs = block_pairs(rows).where(apart)
    return pairs.select(*records.columns, *(f"o_{c}" for c in records.columns))


#: What makes two records a duplicate, a line each: fields that must agree. The order of the rule plays no part in it, since
#: an earlier number that agrees gives the same verdict where the enumeration does.
DUPLICATES = (("oclc", "enum_chron"), ("lccn", "enum_chron"), ("issn", "enum_chron"), ("sudoc", "title", "enum_chron"), ("title", "agency", "pub_date", "enum_chron"))
DUPLICATES_WITH_REVIEW = (("lccn", "title", "enum_chron"), ("oclc", "title", "enum_chron"), ("title", "publisher", "sudoc", "enum_chron"))
#: What relates them: fields that must agree, and fields that must not.
RELATED = ((("oclc",), ("enum_chron",)), (("issn",), ("enum_chron", "oclc", "lccn")))
RELATED_WITH_REVIEW = ((("oclc", "title"), ("enum_chron", "lccn")),)
#: Records of a key that the others are held against, one after another.
STARS = 4


def _values(records: DataFrame, field: str) -> Column:
    """The values of a field; records without an enumeration agree on it."""
    if field not in records.columns:
        return F.array().cast("array<string>")
    values = F.array_distinct(F.filter(F.coalesce(field, F.array().cast("array<string>")), lambda x: x.isNotNull()))
    return F.when(F.size(values) == 0, F.array(F.lit(None).cast("string"))).otherwise(values) if field == "enum_chron" else values


def _keyed(records: DataFrame, fields, *more) -> DataFrame:
    """``id, key`` for every combination of a record's values of ``fields``."""
    part = records.select("id", *(_values(records, f).alias(f"_{f}") for f in fields), *more)
    for f in fields:
        part = part.withColumn(f"_{f}", F.explode(f"_{f}"))
    key = F.to_json(F.array(*(f"_{f}" for f in fields)), {"ignoreNullFields": "false"})
    return part.select("id", F.concat(F.lit(",".join(fields)), key).alias("key"), *(F.col(m) for m in part.columns if m != "id" and m[0] != "_")).distinct()


def _stars(keyed: DataFrame) -> DataFrame:
    """Every record of a key tied to the smallest one."""
    centre = keyed.groupBy("key").agg(F.min("id").alias("centre"))
    return keyed.join(centre, "key").where("id <> centre").select("id", F.col("centre").alias("o_id"))


def _unlike(keyed: DataFrame) -> DataFrame:
    """Edges that join what pairs of one key without a common value (``held``) would join.

    Records of a key with the same values are one class, which has no edge within. A class is held against a few classes of the
    key that have nothing in common with each other, and tied to one that it shares nothing with; that joins all such classes. Only
    classes that share a value with each of them are held against all others of their key, and none where one value is held by all.
    """
    keyed = materialize(keyed, "keyed")
    classes = keyed.groupBy("key", "held").agg(F.min("id").alias("id"))
    sizes = classes.groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
    common = classes.select("key", F.explode("held").alias("v")).groupBy("key", "v").agg(F.count("*").alias("c"))
    barred = common.join(sizes, "key").where("c = m").select("key").distinct()
    open_ = classes.join(sizes, "key", "left_semi").join(barred, "key", "left_anti")
    state = materialize(open_.select("key", "held", "id", F.lit(False).alias("tied"), F.lit(True).alias("free")), "classes")
    apart = ~F.arrays_overlap("held", "of.held")
    found = []
    for _ in range(STARS):
        centre = state.where("free").groupBy("key").agg(F.min(F.struct(F.size("held").alias("n"), "held", "id")).alias("of"))
        met = materialize(state.join(centre, "key", "left").withColumn("apart", F.col("of").isNotNull() & F.coalesce(apart, F.lit(False))), "classes")
        found.append(met.where("apart").select("key", "held", "id", F.col("of.held").alias("o_held"), F.col("of.id").alias("o_id")))
        state = met.select("key", "held", "id", (F.col("tied") | F.col("apart")).alias("tied"), (F.col("free") & F.col("apart")).alias("free"))
    rest = state.where("not tied").select("key", F.struct(F.lit(0).alias("n"), "held", "id").alias("of"))
    found.append(state.join(rest, "key").where(apart).select("key", "held", "id", F.col("of.held").alias("o_held"), F.col("of.id").alias("o_id")))
    edges = found[0]
    for more in found[1:]:
        edges = edges.unionByName(more)
    edges = materialize(edges, "class-edges")
    ends = edges.select("key", "held").unionByName(edges.select("key", F.col("o_held").alias("held"))).distinct()
    centres = ends.join(classes, ["key", "held"]).withColumnRenamed("id", "o_id")
    members = keyed.join(centres, ["key", "held"]).where("id <> o_id").select("id", "o_id")
    return edges.select("id", "o_id").unionByName(members)


def _tagged(values: Column, field: str) -> Column:
    """Values with their field; a missing enumeration is a value too, and equals another one."""
    return F.transform(values, lambda x: F.when(x.isNull(), F.lit(field)).otherwise(F.concat(F.lit(f"{field}="), x)))


def verdict_sets(records: DataFrame, duplicates=DUPLICATES, related=RELATED) -> DataFrame:
    """``relation, set_id, member``: the sets that the pairs of a verdict form, without the pairs.

    They are what :func:`cascade` (or, with the other tables, :func:`cascade_with_review`) and components over its dup and rel pairs give. A key
    that many records hold costs a row for each of them; records without a partner are in no set.
    """
    parts = {"dup": [_stars(_keyed(records, fields)) for fields in duplicates if set(fields) <= {*records.columns, "enum_chron"}], "rel": []}
    for fields, others in related:
        if set(fields) <= set(records.columns):
            tagged = [_tagged(_values(records, f), f) for f in others]
            parts["rel"].append(_unlike(_keyed(records, fields, F.array_sort(F.concat(*tagged)).alias("held"))))
    out = None
    for relation, edges in parts.items():
        for more in edges[1:]:
            edges[0] = edges[0].unionByName(more)
        if edges:
            sets = connected_components(edges[0], "id", "o_id").select(F.lit(relation).alias("relation"), F.col("component").alias("set_id"), F.col("node").alias("member"))
            out = sets if out is None else out.unionByName(sets)
    return out


def with_both(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """Pairs ``id, o_id`` with the columns of both records; those of the second begin with ``o_``."""
    other = records.select(*(F.col(c).alias(f"o_{c}") for c in records.columns))
    return pairs.join(records, "id").join(other, "o_id")


def _eq(field: str, columns: list[str]) -> Column:
    if field not in columns:
        return F.lit(False)
    return shared_value(F.col(field), F.col(f"o_{field}"), field == "enum_chron")


def cascade(pairs: DataFrame) -> DataFrame:
    """Adds ``verdict`` (dup, rel, unr): the first identifier that matches decides, a miss after it does not fall through."""
    q = {f: _eq(f, pairs.columns) for f in FIELDS}
    dup, rel, unr = F.lit("dup"), F.lit("rel"), F.lit("unr")
    verdict = (
        F.when(q["oclc"], F.when(q["enum_chron"], dup).otherwise(rel))
        .when(q["lccn"], F.when(q["enum_chron"], dup).otherwise(unr))
        .when(q["issn"], F.when(q["enum_chron"], dup).otherwise(rel))
        .when(q["sudoc"], F.when(q["title"] & q["enum_chron"], dup).otherwise(unr))
        .when(q["title"] & q["agency"] & q["pub_date"] & q["enum_chron"], dup)
        .otherwise(unr)
    )
    return pairs.withColumn("verdict", verdict)


def cascade_with_review(pairs: DataFrame) -> DataFrame:
    """Adds ``verdict`` (dup, rel, unr, rev): titles must agree; what differs in enumeration or number goes to review."""
    q = {f: _eq(f, pairs.columns) for f in FIELDS}
    dup, rel, unr, rev = (F.lit(x) for x in ("dup", "rel", "unr", "rev"))
    verdict = (
        F.when(q["lccn"], F.when(q["title"], F.when(q["enum_chron"], dup).otherwise(rev)).otherwise(unr))
        .when(q["oclc"], F.when(q["title"], F.when(q["enum_chron"], dup).otherwise(rel)).otherwise(unr))
        .when(q["title"] & q["publisher"], F.when(q["sudoc"] & q["enum_chron"], dup).otherwise(rev))
        .otherwise(unr)
    )
    return pairs.withColumn("verdict", verdict)


#: The lines of :func:`cascade`, first that holds: fields that must agree, fields that must not, fields that decide, and the verdicts where those agree and where not.
CASCADE = (
    (("oclc",), (), ("enum_chron",), "dup", "rel"),
    (("lccn", "enum_chron"), ("oclc",), (), "dup", None),
    (("issn",), ("oclc", "lccn"), ("enum_chron",), "dup", "rel"),
    (("sudoc", "title", "enum_chron"), ("oclc", "lccn", "issn"), (), "dup", None),
    (("title", "agency", "pub_date", "enum_chron"), ("oclc", "lccn", "issn", "sudoc"), (), "dup", None),
)
#: The same of :func:`cascade_with_review`.
CASCADE_WITH_REVIEW = (
    (("lccn", "title"), (), ("enum_chron",), "dup", "rev"),
    (("oclc", "title"), ("lccn",), ("enum_chron",), "dup", "rel"),
    (("title", "publisher"), ("lccn", "oclc"), ("sudoc", "enum_chron"), "dup", "rev"),
)
#: Records of a key that meet as many others in one block, and pairs of a task.
BLOCK, TASK_PAIRS = 1000, 4_000_000


def verdict_pairs(records: DataFrame, lines=CASCADE) -> DataFrame:
    """``id, o_id, verdict``: what :func:`cascade` (or, with the other lines, :func:`cascade_with_review`) says of all pairs, without the unrelated ones.

    Each line makes its own pairs of the records that agree on its fields, and these hold only what the line still has to ask, so
    a pair costs little more than its row. Fields without a second value in any record are compared as strings. The records of a key
    are dealt into blocks; two blocks meet once, and give each pair with the lower ``id`` first.
    """
    fields = [f for f in FIELDS if f in records.columns]
    empty = F.array().cast("array<string>")
    lists = materialize(records.where("id is not null").select("id", *(F.coalesce(f, empty).alias(f) for f in fields)), "rule-records")
    plain = {f: (F.size(f) < 2) & ~F.exists(f, lambda x: x.isNull()) for f in fields}
    told = lists.agg(F.lit(True).alias("any"), *(F.coalesce(F.bool_and(c), F.lit(True)).alias(f) for f, c in plain.items())).first()
    single = {f for f in fields if told[f]}
    rows = lists.select("id", *((F.get(f, F.lit(0)) if f in single else F.col(f)).alias(f) for f in fields))
    lines = [line for line in lines if set(line[0]) <= set(fields)]
    members = [_members(rows, n, line, single) for n, line in enumerate(lines)]
    if not members:
        return rows.select("id", F.col("id").alias("o_id"), F.lit("unr").alias("verdict")).where("false")
    keys = members[0].select("line", "key")
    for more in members[1:]:
        keys = keys.unionByName(more.select("line", "key"))
    sizes = materialize(keys.groupBy("line", "key").agg(F.count("*").alias("size")).where("size > 1"), "sizes")
    total = {r["line"]: r["n"] for r in sizes.groupBy("line").agg(F.sum(F.col("size").cast("double") * F.col("size") / 2).alias("n")).collect()}  # a row a line
    out = None
    for n, line in enumerate(lines):
        found = _line_pairs(members[n], sizes.where(F.col("line") == n).drop("line"), max(1, int(total.get(n, 0) / TASK_PAIRS) + 1), line, single)
        out = found if out is None else out.unionByName(found)
    return out


def _longer(keys: Column, values: Column) -> Column:
    return F.flatten(F.transform(keys, lambda k: F.transform(values, lambda x: F.concat(k, F.array(x)))))


def _members(rows: DataFrame, n: int, line, single: set[str]) -> DataFrame:
    """``line, key, id`` and what the line compares; ``before`` are the keys ahead of this one, where a record can have several."""
    agree, apart, ask, yes, no = line
    asked = [f for f in rows.columns if f in (*apart, *ask)]
    held = rows.select("id", *asked, *(F.col(f).alias(f"k_{f}") for f in agree))
    for f in agree:
        if f in single:
            held = held if f == "enum_chron" else held.where(F.col(f"k_{f}").isNotNull())
        else:
            values = F.array_distinct(F.filter(f"k_{f}", lambda x: x.isNotNull()))
            values = F.when(F.size(f"k_{f}") == 0, F.array(F.lit(None).cast("string"))).otherwise(values) if f == "enum_chron" else values
            held = held.withColumn(f"k_{f}", values)
    several = [f for f in agree if f not in single]
    if not several:
        return held.select(F.lit(n).alias("line"), F.to_json(F.array(*(f"k_{f}" for f in agree)), {"ignoreNullFields": "false"}).alias("key"), "id", *asked)
    keys = F.array(F.array().cast("array<string>"))
    for f in agree:
        keys = _longer(keys, F.array(f"k_{f}") if f in single else F.col(f"k_{f}"))
    held = held.withColumn("_keys", F.array_sort(F.transform(keys, lambda k: F.to_json(k, {"ignoreNullFields": "false"}))))
    held = held.select("id", *asked, "_keys", F.posexplode("_keys").alias("_at", "key"))
    return held.select(F.lit(n).alias("line"), "key", "id", *asked, F.slice("_keys", F.lit(1), F.col("_at")).alias("before"))


def _line_pairs(members: DataFrame, sizes: DataFrame, parts: int, line, single: set[str]) -> DataFrame:
    agree, apart, ask, yes, no = line
    own = [c for c in members.columns if c not in ("line", "key", "id")]
    dealt = members.join(sizes, "key").withColumn("of", F.ceil(F.col("size") / BLOCK).cast("int")).withColumn("at", F.pmod(F.xxhash64("id"), F.col("of")).cast("int"))
    left = dealt.select("key", F.col("at").alias("i"), F.explode(F.sequence("at", F.col("of") - 1)).alias("j"), "id", *own)
    right = dealt.select("key", F.explode(F.sequence(F.lit(0), "at")).alias("i"), F.col("at").alias("j"), F.col("id").alias("o_id"), *(F.col(c).alias(f"o_{c}") for c in own))
    keys = ["key", "i", "j"]

    def same(f: str) -> Column:
        a, b = F.col(f), F.col(f"o_{f}")
        if f not in single:
            return shared_value(a, b, f == "enum_chron")
        return a.eqNullSafe(b) if f == "enum_chron" else F.coalesce(a == b, F.lit(False))

    pairs = left.repartition(parts, *keys).join(right.repartition(parts, *keys), keys).where("i <> j or id < o_id")
    for f in apart:
        if f in members.columns:
            pairs = pairs.where(~same(f))
    if "before" in own:
        pairs = pairs.where((F.size("before") == 0) | (F.size("o_before") == 0) | ~F.arrays_overlap("before", "o_before"))
    verdict = F.lit(yes)
    if ask:
        both = [same(f) if f in members.columns else F.lit(False) for f in ask]
        verdict = F.when(both[0] if len(both) == 1 else both[0] & both[1], F.lit(yes)).otherwise(F.lit(no))
    return pairs.select(F.least("id", "o_id").alias("id"), F.greatest("id", "o_id").alias("o_id"), verdict.alias("verdict"))


def best_f1(found: DataFrame, answers: DataFrame) -> DataFrame:
    """``set_id, f1`` of found sets against answer sets (both ``set_id, member``): the best F1 over all answers, 0 without overlap."""
    a = answers.select(F.col("set_id").alias("answer"), "member").distinct()
    f = found.select("set_id", "member").distinct()
    sizes_a = a.groupBy("answer").agg(F.count("*").alias("na"))
    sizes_f = f.groupBy("set_id").agg(F.count("*").alias("nf"))
    shared = f.join(a, "member").groupBy("set_id", "answer").agg(F.count("*").alias("k")).join(sizes_a, "answer").join(sizes_f, "set_id")
    best = shared.groupBy("set_id").agg(F.max(2 * F.col("k") / (F.col("na") + F.col("nf"))).alias("f1"))
    return sizes_f.select("set_id").join(best, "set_id", "left").select("set_id", F.coalesce("f1", F.lit(0.0)).alias("f1"))


def mean_f1(found: DataFrame, answers: DataFrame) -> DataFrame:
    """One row ``f1``: the sum over found sets divided by the number of answer sets."""
    n = answers.agg(F.count_distinct("set_id")).scalar()
    return best_f1(found, answers).agg(F.sum("f1").alias("s")).select(F.coalesce(F.try_divide(F.col("s"), n), F.lit(0.0)).alias("f1"))


def evaluate(verdicts: DataFrame, answers: DataFrame) -> DataFrame:
    """``relation, found, sought, f1`` of verdicts (``id, o_id, verdict``) against answer sets (``relation, set_id, member``).

    The pairs of a verdict are merged into sets and those judged by :func:`evaluate_sets`.
    """
    parts = []
    for relation in ("unr", "rel", "dup"):
        sets = connected_components(verdicts.where(F.col("verdict") == relation), "id", "o_id")
        parts.append(sets.select(F.lit(relation).alias("relation"), F.col("component").alias("set_id"), F.col("node").alias("member")))
    return evaluate_sets(parts[0].unionByName(parts[1]).unionByName(parts[2]), answers)


def evaluate_sets(found: DataFrame, answers: DataFrame) -> DataFrame:
    """``relation, found, sought, f1`` of found sets against answer sets (both ``relation, set_id, member``).

    ``f1`` is the sum of the best F1 of each set over the number of answers. Relations without answers are left out, those without sets have 0.
    """
    a = answers.select("relation", F.col("set_id").alias("answer"), "member").distinct()
    f = found.select("relation", "set_id", "member").distinct()
    sizes_a = a.groupBy("relation", "answer").agg(F.count("*").alias("na"))
    sizes_f = f.groupBy("relation", "set_id").agg(F.count("*").alias("nf"))
    shared = f.join(a, ["relation", "member"]).groupBy("relation", "set_id", "answer").agg(F.count("*").alias("k"))
    shared = shared.join(sizes_a, ["relation", "answer"]).join(sizes_f, ["relation", "set_id"])
    best = shared.groupBy("relation", "set_id").agg(F.max(2 * F.col("k") / (F.col("na") + F.col("nf"))).alias("f1"))
    each = sizes_f.join(best, ["relation", "set_id"], "left").groupBy("relation").agg(F.count("*").alias("found"), F.sum(F.coalesce("f1", F.lit(0.0))).alias("s"))
    sought = sizes_a.groupBy("relation").agg(F.count("*").alias("sought"))
    return sought.join(each, "relation", "left").select(
        "relation", F.coalesce("found", F.lit(0)).alias("found"), "sought", (F.coalesce("s", F.lit(0.0)) / F.col("sought")).alias("f1")
    )


def review_list(verdicts: DataFrame) -> DataFrame:
    """``line``: the pairs that need a person's judgement."""
    return verdicts.where("verdict = 'rev'").select(F.concat_ws(" <?> ", F.col("id").cast("string"), F.col("o_id").cast("string")).alias("line"))
