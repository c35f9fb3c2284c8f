"""Fuzzy matches by weighted words, bands of pairs and their clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bibweave.plans.blocks import block_pairs
from bibweave.plans.components import connected_components
from bibweave.plans.scratch import materialize


def word_bags(attrs: DataFrame, stop_words: list[str] | None = None, kinds=("publisher", "title", "pubdate", "enumc")) -> DataFrame:
    """``gd_id, attr, str, words``: the distinct words of every attribute row without stop words."""
    words = F.array_distinct(F.filter(F.split(F.trim("str"), r"\s+"), lambda w: w != ""))
    if stop_words:
        words = F.array_except(words, F.array(*map(F.lit, stop_words)))
    return attrs.where(F.col("attr").isin(*kinds)).select("gd_id", "attr", "str", words.alias("words"))


def word_weights(bags: DataFrame) -> DataFrame:
    """``word, freq, weight``: 1 - frequency over all frequencies, rounded to 3 places."""
    freq = bags.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("freq"))
    total = freq.agg(F.sum("freq")).scalar()
    return freq.select("word", "freq", (1 - F.round(F.col("freq") / total, 3)).alias("weight"))


def by_rarity(bags: DataFrame) -> DataFrame:
    """``gd_id, attr, str, words`` with the words from the rarest to the most frequent, equal ones in order."""
    freq = word_weights(bags).select("word", "freq")
    rows = bags.select("gd_id", "attr", "str", F.explode("words").alias("word")).join(freq, "word")
    each = rows.groupBy("gd_id", "attr", "str").agg(F.array_sort(F.collect_list(F.struct("freq", "word"))).alias("w"))
    return each.select("gd_id", "attr", "str", F.transform("w", lambda x: x["word"]).alias("words"))


def _word_classes(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``cls, id`` of all records, and ``cls, words`` (in order): records with the same words are one class, named by its smallest id."""
    sets = materialize(words.groupBy("id").agg(F.array_sort(F.collect_set("word")).alias("words")), "word-sets")
    classes = materialize(sets.groupBy("words").agg(F.min("id").alias("cls")), "word-classes")
    return sets.join(classes, "words").select("cls", "id"), classes.select("cls", "words")


#: Classes of a word that meet as many others in one block, and pairs of classes that a task compares.
CLASSES, COMPARED = 500, 500_000


def _meeting(rare: DataFrame) -> DataFrame:
    """Pairs ``a < b`` of classes (``rare``: ``a, word``) with a word in common. However few rows the words are, their pairs are many tasks' work."""
    found = block_pairs(rare.select(F.col("word").alias("cls"), F.col("a").alias("id")), size=CLASSES, pairs_a_task=COMPARED)
    pairs = found.select(F.col("id").alias("a"), F.col("o_id").alias("b"))
    return pairs.repartition(found._bibweave_tasks, "a", "b").distinct()


def _both_ways(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs ``a < b`` of classes, the same turned round, and every class with itself."""
    return pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).unionByName(classes.select(F.col("cls").alias("a"), F.col("cls").alias("b")))


def shared_words(rows: DataFrame, least: int = 3) -> DataFrame:
    """``id, other_id, shared`` of pairs ``id < other_id`` with ``least`` words in common or more; ``rows`` are ``id, word``.

    Records with the same words are one class, and classes are compared. Two that share k words share one of the first
    n - k + 1 of each in order of rarity, so only those are joined, and the pairs found are counted on all words. What is found of two
    classes holds for all pairs of their records, which come in blocks.
    """
    members, classes = _word_classes(rows.select("id", "word"))
    each_word = classes.select("cls", F.explode("words").alias("word"))
    often = each_word.groupBy("word").agg(F.count("*").alias("freq"))
    each = Window.partitionBy("cls")
    placed = each_word.join(often, "word").select("cls", "word", F.row_number().over(each.orderBy("freq", "word")).alias("at"), F.count("*").over(each).alias("n"))
    rare = placed.where(F.col("at") <= F.col("n") - least + 1).select(F.col("cls").alias("a"), "word")
    pairs = _both_ways(_meeting(rare), classes)
    both = pairs.join(classes.select(F.col("cls").alias("a"), F.col("words").alias("x")), "a").join(classes.select(F.col("cls").alias("b"), F.col("words").alias("y")), "b")
    links = both.select("a", "b", F.size(F.array_intersect("x", "y")).cast("bigint").alias("shared")).where(F.col("shared") >= least)
    return block_pairs(members, links).select("id", F.col("o_id").alias("other_id"), "shared")


def match_words(bags: DataFrame, more_than: int = 5, cutoff: float = 0.5) -> DataFrame:
    """Pairs ``id < other_id`` whose words weigh more in common than apart: ``score`` (3 places) and ``overlap``.

    Of an attribute's rows the greatest counts. A pair is compared if the lower id has all its
    words in common, or more than ``more_than`` are. With the weight sums A, B, O of both and of the overlap the score
    is (3 O - A - B) / (|x| + |y| - |x & y|).

    Above the cutoff c, O is more than (A + c |x|) / 2, so what precedes the first shared word in order of rarity weighs
    less than (A - c |x|) / 2, and the same holds for y: only words within that bound are joined, and frequent words
    make no pairs. Each pair found is then scored on all words. Records with the same words are one class; classes are
    compared, and the pairs of their records come in blocks.
    """
    weights = word_weights(bags)
    last = bags.groupBy("gd_id", "attr").agg(F.max_by("words", "str").alias("words"))
    members, classes = _word_classes(last.select(F.col("gd_id").alias("id"), F.explode("words").alias("word")))
    words = materialize(classes.select("cls", F.explode("words").alias("word")).join(weights, "word"), "class-words")
    each = Window.partitionBy("cls")
    before = each.orderBy("freq", "word").rowsBetween(Window.unboundedPreceding, -1)
    placed = words.select("cls", "word", F.coalesce(F.sum("weight").over(before), F.lit(0.0)).alias("ahead"), F.sum("weight").over(each).alias("w"), F.count("*").over(each).alias("n"))
    # a hair more than the bound, for what sums lose to rounding
    rare = placed.where(F.col("ahead") < (F.col("w") - max(cutoff, 0.0) * F.col("n")) / 2 + 1e-9).select(F.col("cls").alias("a"), "word")
    pairs = _both_ways(_meeting(rare), classes)
    lists = words.groupBy("cls").agg(F.array_sort(F.collect_list(F.struct("word", "weight"))).alias("x"))
    lists = lists.withColumn("wx", F.aggregate("x", F.lit(0.0), lambda acc, s: acc + s["weight"])).withColumnRenamed("cls", "a")
    other = lists.select(F.col("a").alias("b"), F.transform("x", lambda s: s["word"]).alias("y"), F.col("wx").alias("wy"))
    both = pairs.join(lists, "a").join(other, "b").withColumn("both", F.filter("x", lambda s: F.array_contains("y", s["word"])))
    k, nx, ny = F.size("both"), F.size("x"), F.size("y")
    o = F.aggregate("both", F.lit(0.0), lambda acc, s: acc + s["weight"])
    score = (3 * o - F.col("wx") - F.col("wy")) / (nx + ny - k)
    found = both.where((k == nx) | (k > more_than)).select("a", "b", score.alias("score"), F.transform("both", lambda s: s["word"]).alias("overlap"))
    links = found.where(F.col("score") > cutoff).select("a", "b", F.round(F.round("score", 9), 3).alias("score"), "overlap")
    return block_pairs(members, links).select("id", F.col("o_id").alias("other_id"), "score", "overlap")


def band_clusters(pairs: DataFrame, high: float = 0.75) -> DataFrame:
    """``band, gd_id, cluster_id``: components of the pairs above ``high`` and of the others, apart. Negative scores go."""
    parts = []
    for band, rule in (("high", F.col("score") > high), ("low", F.col("score") <= high)):
        found = connected_components(pairs.where((F.col("score") >= 0) & rule), "id", "other_id")
        parts.append(found.select(F.lit(band).alias("band"), F.col("node").alias("gd_id"), F.col("component").alias("cluster_id")))
    return parts[0].unionByName(parts[1])


def unmatched(solos: DataFrame, clusters: DataFrame) -> DataFrame:
    """Solo records that no title cluster holds."""
    return solos.join(clusters.select("gd_id").distinct(), "gd_id", "left_anti")
