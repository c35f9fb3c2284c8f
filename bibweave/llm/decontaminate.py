"""Benchmark decontamination by template windows, with DataFrame operations only.

Texts are brought to templates: numbers, names (capitalised words) and units after a number become
typed placeholders, all else lower-cased words. A window with names has a second template without them, so that
it also meets a copy in another case. Every window of ``WINDOW`` template words of an item meets
every such window of a document by its hash; an item shorter than a window is one window of its own
length. The matches of one alignment count together if their slots are consistent (each value of the item stands for
one value of the document and the other way round) and they hold evidence for ``LITERAL`` words: a plain word or a slot of equal
value is one, a number is half of one, whatever its value. So a window of few plain words counts by what the whole alignment
holds. Where an alignment falls short, its windows with equal values count. Windows without any plain word are hashed on
their actual words, so they match where those are equal.

Most documents match nothing, and a cheaper test finds them: a window of n words holds, wherever it stands,
one run of n - step + 1 words that begins at a multiple of ``step``. Documents give only those runs, and the ones
that share none with an item's runs are left out before any window is made. The test loses no match.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bibweave.llm.rows import without
from bibweave.plans.scratch import discard, materialize

WINDOW = 8
#: Evidence, in plain words, that an alignment must hold to count by its templates.
LITERAL = 4
#: Windows of the benchmark (some 100 bytes each) and hashes of its runs (8 bytes) that may be broadcast; with more, Spark chooses the join.
BROADCAST_WINDOWS, BROADCAST_RUNS = 1 << 20, 1 << 22
#: Units that are replaced after a number.
UNITS = (
    "mm cm m km inch inches ft feet yard yards mile miles mg g kg lb lbs oz ton tons ml l liter liters litre litres gallon gallons "
    "s sec second seconds min minute minutes h hour hours day days week weeks month months year years "
    "percent dollar dollars euro euros cent cents pound pounds degree degrees c f k mph kmh w kw v hz j n pa mb gb tb"
)
#: Stand-ins from the private use area, which the words of a text cannot hold.
_NAME, _NUMBER, _UNIT = "\ue000", "\ue001", "\ue002"


def words_of(text) -> F.Column:
    """Words of letters, digits and underscores in order, one string with single spaces; a number is one word."""
    s = F.regexp_replace(F.coalesce(text, F.lit("")), r"[.,](?<=[0-9][.,])(?=[0-9])", "_")
    return F.trim(F.regexp_replace(s, r"[^\p{L}\p{N}_]+", " "))


def _numbered(words) -> F.Column:
    """Placeholders in place of numbers and of units after one; word by word as many as there are.

    The patterns begin with a character, and look behind it for the word's start, since that fails fastest.
    """
    s = F.regexp_replace(words, r"[0-9](?<![^ ].)[0-9_]*(?= |$)", _NUMBER)
    return F.regexp_replace(s, f"{_NUMBER} (?i:{'|'.join(UNITS.split())})(?= |$)", f"{_NUMBER} {_UNIT}")


def _templates(df: DataFrame, text_col: str) -> DataFrame:
    """Adds the words of a text as arrays: ``t`` with typed numbers, units and names, ``u`` without the names, ``w`` as they are; ``n`` is their number."""
    df = df.withColumn("s", words_of(F.col(text_col))).withColumn("x", _numbered(F.col("s")))
    named = F.regexp_replace("x", r"\p{Lu}(?<![^ ].)\p{Ll}[^ ]*", _NAME)
    df = df.withColumns({c: F.split(F.lower(x), " ") for c, x in (("t", named), ("u", F.col("x")), ("w", F.col("s")))})
    return df.withColumn("n", F.when(F.col("s") == "", 0).otherwise(F.size("t"))).drop("s", "x")


def _is_slot(x) -> F.Column:
    return x.isin(_NAME, _NUMBER, _UNIT)


def _need(size: int) -> int:
    """Evidence that an alignment of windows of ``size`` words must hold."""
    return min(LITERAL, (size + 1) // 2)


def _step(size: int) -> int:
    return max(1, size // 2)


def _both(i, size: int, one) -> F.Column:
    """What ``one`` makes of ``size`` words from the ``i``-th on: of the template, and of that without names where it has some."""
    typed, plain = F.slice("t", i, F.lit(size)), F.slice("u", i, F.lit(size))
    return F.when(F.array_contains(typed, _NAME), F.array(one(typed), one(plain))).otherwise(F.array(one(typed)))


def _runs(size: int, step: int) -> F.Column:
    """Hashes of the runs that every window of ``size`` words holds one of, from every ``step``-th word on."""
    run = size - _step(size) + 1
    at = F.sequence(F.lit(1), F.col("n") - run + 1, F.lit(step))
    made = F.flatten(F.transform(at, lambda i: _both(i, run, lambda t: F.xxhash64(F.lit(size), t))))
    return F.when(F.col("n") >= run, made).otherwise(F.array().cast("array<bigint>"))


def _hash(t, w, size: int, floor: int) -> F.Column:
    """The hash of a window's template, or of its words if fewer than ``floor`` of the template's are plain."""
    plain = lambda x: ~_is_slot(x)
    by_template = F.exists(t, plain) if floor == 1 else F.size(F.filter(t, plain)) >= floor
    return F.when(by_template, F.xxhash64(F.lit(size), t)).otherwise(F.xxhash64(F.lit(-size), t, w))


def _words_at(i, size: int) -> F.Column:
    return F.slice("w", i + 1, F.lit(size))


def _hashes(size: int, floor: int) -> F.Column:
    """``size, at, named, h`` of every window; ``named`` tells the template with names from that without."""

    def window(i):
        one = lambda t, named: F.struct(F.lit(size).alias("size"), i.alias("at"), F.lit(named).alias("named"), _hash(t, _words_at(i, size), size, floor).alias("h"))
        typed, plain = F.slice("t", i + 1, F.lit(size)), F.slice("u", i + 1, F.lit(size))
        return F.when(F.array_contains(typed, _NAME), F.array(one(typed, True), one(plain, False))).otherwise(F.array(one(typed, True)))

    made = F.flatten(F.transform(F.sequence(F.lit(0), F.col("n") - size), window))
    return F.when(F.col("n") >= size, made).otherwise(F.array().cast("array<struct<size:int,at:int,named:boolean,h:bigint>>"))


def _places_of(size: int) -> F.Column:
    return F.filter("places", lambda p: p["size"] == size)


def _windows(places, size: int, floor: int) -> F.Column:
    """``at, h, slots, literal`` of the windows at some places (``at, named``).

    ``slots`` are the values at a window's placeholders with their kind and place, and none if it is matched by its words;
    ``literal`` has the places of its plain words.
    """

    def window(p):
        i = p["at"]
        t = F.when(p["named"], F.slice("t", i + 1, F.lit(size))).otherwise(F.slice("u", i + 1, F.lit(size)))
        held = F.arrays_zip(t.alias("k"), _words_at(i, size).alias("v"), F.sequence(i, i + size - 1).alias("j"))
        slots = F.transform(F.filter(held, lambda p: _is_slot(p["k"])), lambda p: F.struct(p["j"].alias("j"), F.concat(p["k"], p["v"]).alias("v")))
        literal = F.transform(F.filter(held, lambda p: ~_is_slot(p["k"])), lambda p: p["j"])
        by_template = F.size(literal) >= floor
        slots = F.when(by_template, slots).otherwise(F.array().cast("array<struct<j:int,v:string>>"))
        return F.struct(i.alias("at"), _hash(t, _words_at(i, size), size, floor).alias("h"), slots.alias("slots"), literal.alias("literal"), (by_template | F.array_contains(t, _NAME)).alias("told"))

    return F.transform(places, window)


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = WINDOW,
) -> DataFrame:
    """Pairs of documents and benchmark items that share consistent template windows.

    Returns ``doc_id, item_id, n_windows`` (pairs of equal windows that count, by their places) and ``n_exact`` (those with
    equal slot values). Items shorter than a window are matched as a whole: by template if half of
    their words are no placeholders, else by their actual words, if one is no number or unit. What an item
    matches does not depend on the other items. Null and empty texts match nothing; rows with a null id take
    no part. Rows that share an id are one document; repeated items count once per item id. Other columns are ignored.
    """
    items = _templates(benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text).alias("x")).where("item_id is not null"), "x")
    items = materialize(items.where("n > 0").withColumn("size", F.least("n", F.lit(window))), "items")
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect())
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("x")).where("doc_id is not null and x is not null")
    if not sizes:
        return base.where("false").selectExpr("doc_id", "cast(null as bigint) as item_id", "0l as n_windows", "0l as n_exact")
    # a short item has no alignment beyond itself
    floors = {size: 1 if size == window else _need(size) for size in sizes}
    asked, runs = [], []
    for size in sizes:
        own = items.where(F.col("size") == size)
        made = own.select("item_id", "size", F.explode(_windows(_hashes(size, floors[size]), size, floors[size])).alias("x")).select("item_id", "size", "x.*")
        if size < window:
            made = made.where("told")
        asked.append(made.select("h", "size", "item_id", F.col("at").alias("item_at"), "slots", "literal").distinct())
        runs.append(own.select(F.explode(_runs(size, 1)).alias("h")))
    wanted, keys = asked[0], runs[0]
    for more, other in zip(asked[1:], runs[1:]):
        wanted, keys = wanted.unionByName(more), keys.unionByName(other)
    wanted, keys = materialize(wanted, "windows"), materialize(keys.distinct(), "runs")
    discard(items)
    small, few = wanted.count() <= BROADCAST_WINDOWS, keys.count() <= BROADCAST_RUNS
    # only hashes and ids of the documents' runs meet the benchmark's
    held = [_runs(size, _step(size)) for size in sizes]
    given = _templates(base, "x").select("doc_id", F.explode(F.concat(*held) if len(held) > 1 else held[0]).alias("h"))
    hits = materialize(given.join(F.broadcast(keys) if few else keys, "h", "left_semi").select("doc_id").distinct(), "hits")
    discard(keys)
    some = _templates(base.join(F.broadcast(hits) if hits.count() <= BROADCAST_WINDOWS else hits, "doc_id", "left_semi"), "x")
    # only hashes of the rest's windows meet the benchmark's; values are looked up at the places that match
    every = [_hashes(size, floors[size]) for size in sizes]
    made = some.select("doc_id", F.explode(F.concat(*every) if len(every) > 1 else every[0]).alias("x")).select("doc_id", "x.*")
    sought = wanted.select("h", "size").distinct()
    met = made.join(F.broadcast(sought) if small else sought, ["h", "size"], "left_semi")
    places = materialize(met.groupBy("doc_id").agg(F.collect_set(F.struct("size", "at", "named")).alias("places")), "places")
    total = places.agg(F.coalesce(F.sum(F.size("places")), F.lit(0))).first()[0]
    some = _templates(base.join(F.broadcast(places) if total <= BROADCAST_WINDOWS else places, "doc_id"), "x")
    parts = []
    for size in sizes:
        own = _windows(_places_of(size), size, floors[size])
        parts.append(some.select("doc_id", F.explode(own).alias("x")).select("doc_id", F.lit(size).alias("size"), "x.at", "x.h", F.col("x.slots.v").alias("own")))
    found = parts[0]
    for more in parts[1:]:
        found = found.unionByName(more)
    both = found.join(F.broadcast(wanted) if small else wanted, ["h", "size"])
    # windows of one alignment of a text with an item share their slots
    same = F.col("slots.v") == F.col("own")
    aligned = both.groupBy("doc_id", "item_id", "size", (F.col("at") - F.col("item_at")).alias("shift")).agg(
        F.array_distinct(F.flatten(F.collect_set(F.arrays_zip(F.col("slots.j").alias("j"), F.col("slots.v").alias("v"), "own")))).alias("slots"),
        F.size(F.array_distinct(F.flatten(F.collect_set("literal")))).alias("plain"),
        F.size(F.collect_set("at")).alias("n"), F.size(F.collect_set(F.when(same, F.col("at")))).alias("exact"),
    )
    pairs = F.array_distinct(F.transform("slots", lambda p: F.struct(p["v"].alias("v"), p["own"].alias("own"))))
    aligned = aligned.withColumn("pairs", pairs)
    consistent = (F.size("pairs") == F.size(F.array_distinct("pairs.v"))) & (F.size("pairs") == F.size(F.array_distinct("pairs.own")))
    spots = lambda test: F.size(F.array_distinct(F.transform(F.filter("slots", test), lambda p: p["j"])))
    evidence = 2 * F.col("plain") + 2 * spots(lambda p: p["v"] == p["own"]) + spots(lambda p: p["v"].startswith(_NUMBER))
    need = F.least(F.lit(LITERAL), F.floor((F.col("size") + 1) / 2))
    counts = aligned.select("doc_id", "item_id", "n", "exact", (consistent & (evidence >= 2 * need)).alias("whole")).where("whole or exact > 0")
    counted = F.when(F.col("whole"), F.col("n")).otherwise(F.col("exact"))
    return counts.groupBy("doc_id", "item_id").agg(F.sum(counted).cast("long").alias("n_windows"), F.sum("exact").cast("long").alias("n_exact"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **params) -> DataFrame:
    """``docs`` without the documents that :func:`contaminated` pairs with an item.

    Columns stay as they are, and so do rows with a null id or a null or empty text; all rows of an id go together.
    """
    return without(docs, contaminated(docs, benchmark, id_col, **params).select("doc_id"), id_col)
