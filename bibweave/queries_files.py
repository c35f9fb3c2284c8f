"""Queries that write and read files, and the rest of the operators' queries."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bibweave.functions import marc8
from bibweave.functions.text import normalize_form, one_of
from bibweave.operators import agencies as ag
from bibweave.operators import catalog as ct
from bibweave.operators import clusters as cl
from bibweave.operators import rules as ru
from bibweave.operators import titles as tt
from bibweave.operators.dictionary import Dictionary
from bibweave.operators.growing import Clusters
from bibweave.operators.postings import kept_postings
from bibweave.plans import views as V
from bibweave.plans.scratch import at_end, materialize, shared_dir
from bibweave.queries import _AGROWS, _BAG, _CASCADE, _FREQ, _KEEP, _REACH, _REVIEWED, _RULED, ACRONYMS, Source, _agency_sql, _clusters, _fold_sql, _ruled, query
from bibweave.queries_marc import marc_lines, records
from bibweave.sources import dump as dp
from bibweave.sources import jdbc
from bibweave.sources import marc as ms
from bibweave.streaming.ingest import Store, lines_of


def _folder(s: Source, name: str) -> str:
    path = f"{shared_dir(s.spark)}/{name}-{uuid.uuid4().hex}"
    at_end(s.spark, path)
    return path


def _values(read: DataFrame, *more) -> DataFrame:
    """``id``, number of fields, title and date of records that were read."""
    value = lambda tag, code: F.get(F.filter(F.get(F.filter("fields", lambda f: f["tag"] == tag), F.lit(0))["subfields"], lambda x: x["code"] == code), F.lit(0))["value"]
    number = F.get(F.filter("fields", lambda f: f["tag"] == "001"), F.lit(0))["value"]
    return read.select(number.cast("bigint").alias("id"), F.size("fields").cast("bigint").alias("n"), value("245", "a").alias("title"), value("260", "c").alias("date"), *more)


_READ = "SELECT p_partkey AS id, CAST(7 AS BIGINT) AS n, '  The  ' || p_name || ':' AS title, 'c' || CAST(1900 + p_partkey % 100 AS VARCHAR) AS date FROM part"


@query("src2_sequential_records", _READ)
def _(s):
    path = _folder(s, "sequential")
    ms.write_sequential(records(s).withColumnRenamed("id", "number"), path)
    return _values(ms.read_sequential(s.spark, path))


@query("src3_records_of_a_file", "SELECT p_partkey AS id, 'file-' || p_size % 3 AS file_path FROM part WHERE p_size % 3 = 1")
def _(s):
    path = _folder(s, "collection")
    file_path = F.concat(F.lit("file-"), (F.col("p_size") % 3).cast("string")).alias("file_path")
    lines = marc_lines(s, "p_size").where("p_size is not null").select(F.concat(F.lit('{"source":'), "value", F.lit("}")).alias("value"), file_path)
    ms.write_collection(lines, path)
    found = ms.read_collection(s.spark, path, "file-1")
    number = F.get(F.filter("fields", lambda f: f["tag"] == "001"), F.lit(0))["value"]
    return found.select(number.cast("bigint").alias("id"), "file_path")


@query("src6_prepared_statement", "SELECT gd_id, str FROM a WHERE attr = 'title' AND str LIKE '%1997%' UNION ALL SELECT gd_id, str FROM a WHERE attr = 'enumc' AND str LIKE 'v.1%'", a=V.CLEAN)
def _(s):
    ask = jdbc.prepare(s.spark, "SELECT gd_id, str FROM {attrs} WHERE attr = ? AND str LIKE ?", attrs=s.attrs)
    return ask("title", "%1997%").unionByName(ask("enumc", "v.1%"))


@query("src8_listed_files", "SELECT DISTINCT 'http://example.org/dump_full_' || strftime(ts, '%Y%m%d') || '.txt.gz' AS path FROM events")
def _(s):
    link = F.concat(F.lit('<li><a href="http://example.org/dump_full_'), F.date_format("ts", "yyyyMMdd"), F.lit('.txt.gz">full</a> <a href="http://example.org/dump_upd.txt.gz">update</a></li>'))
    pages = s.table("events").groupBy("event_type").agg(F.array_join(F.collect_set(link), "\n").alias("body"))
    return dp.listed_files(pages)


@query("src10_word_lists", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN (SELECT DISTINCT c_mktsegment FROM customer WHERE c_mktsegment < 'F')")
def _(s):
    path = _folder(s, "words")
    s.table("customer").select(F.concat(F.lit(" "), "c_mktsegment").alias("value")).where("value < ' F'").distinct().write.text(path)
    words = dp.read_words(s.spark, path)
    return s.table("customer").where(F.col("c_mktsegment").rlike(one_of(words, True))).select("c_custkey", "c_mktsegment")


# ---- record formats ----------------------------------------------------------------------------------------------


def _binary(s: Source) -> str:
    path = _folder(s, "binary")
    ms.write_binary(records(s), path)
    return path


@query("mrc1_strict_reader", _READ)
def _(s):
    return _values(ms.read_binary(s.spark, _binary(s)))


@query("mrc2_forgiving_reader", f"SELECT *, CAST(NULL AS VARCHAR) AS corrupt FROM ({_READ}) UNION ALL SELECT NULL, NULL, NULL, NULL, 'corrupt' FROM range(2)")
def _(s):
    """A damaged record and a fragment among the others are told apart, not dropped."""
    path = _binary(s)
    s.spark.sql("select explode(array('00026     2200026   4500 no directory', 'ab', ' ')) as value").write.mode("append").option("lineSep", "\x1d").text(path)
    read = ms.read_binary(s.spark, path, forgiving=True)
    good = _values(read.where("corrupt is null")).withColumn("corrupt", F.lit(None).cast("string"))
    return good.unionByName(read.where("corrupt is not null").selectExpr("cast(null as bigint) as id", "cast(null as bigint) as n", "cast(null as string) as title", "cast(null as string) as date", "'corrupt' as corrupt"))


@query("mrc3_field_parse", """
SELECT p_partkey AS id, '001' AS tag, NULL AS ind1, CAST(p_partkey AS VARCHAR) AS value, NULL AS codes FROM part UNION ALL
SELECT p_partkey, '245', '1', NULL, 'a,b' FROM part UNION ALL SELECT p_partkey, '260', '1', NULL, 'a,b,c' FROM part""")  # fmt: skip
def _(s):
    """Fields of records that were written and read; a field without subfields is left out."""
    empty = F.struct(F.lit("999").alias("tag"), F.lit("1").alias("ind1"), F.lit(" ").alias("ind2"), F.lit(None).cast("string").alias("value"), F.array().cast("array<struct<code:string,value:string>>").alias("subfields"))
    path = _folder(s, "fields")
    ms.write_binary(records(s).withColumn("fields", F.concat("fields", F.array(empty))), path)
    read = ms.read_binary(s.spark, path)
    number = F.get(F.filter("fields", lambda f: f["tag"] == "001"), F.lit(0))["value"].cast("bigint")
    each = read.select(number.alias("id"), F.explode("fields").alias("f")).where("f.tag in ('001', '245', '260', '999')")
    return each.select("id", "f.tag", "f.ind1", "f.value", F.when(F.col("f.subfields").isNotNull(), F.array_join(F.transform("f.subfields", lambda x: x["code"]), ",")).alias("codes"))


@query("mrc4_text_validation", "SELECT doc_id, md5(coalesce(text, '') || chr(65533) || 'x') AS mended, false AS valid FROM documents")
def _(s):
    raw = F.concat(F.coalesce("text", F.lit("")).cast("binary"), F.unhex(F.lit("FF78")))
    return s.table("documents").select("doc_id", F.md5(ms.valid_text(raw).cast("binary")).alias("mended"), F.is_valid_utf8(raw.cast("string")).alias("valid"))


@query("mrc5_marc8_text", "SELECT p_partkey AS id, p_name || ' é ₂α Жя אב Ωω ئ ' || chr(8364) AS text FROM part")
def _(s):
    tail = b" \xe2e \x1bb2\x1bs\x1bga\x1bs \x1b(NvQ\x1b(B \x1b(2`a\x1b(B \x1b(S]}\x1b(B \x1b(3F\x1b(B &#x20AC;"
    raw = F.concat(F.col("p_name").cast("binary"), F.lit(bytearray(tail)))
    return s.table("part").select(F.col("p_partkey").alias("id"), marc8.decoded()(raw).alias("text"))


@query("mrc6_normal_forms", "SELECT doc_id, md5(nfc_normalize(coalesce(text, ''))) AS nfc FROM documents")
def _(s):
    text = normalize_form("NFC")(normalize_form("NFD")(F.coalesce("text", F.lit(""))))
    return s.table("documents").select("doc_id", F.md5(text).alias("nfc"))


@query("mrc7_xml_reader", _READ)
def _(s):
    path = _folder(s, "xml")
    ms.write_xml(records(s), path)
    return _values(ms.read_xml(s.spark, path))


@query("mrc9_xml_writer", "SELECT CAST(count(*) AS BIGINT) AS records, CAST(count(*) * 2 AS BIGINT) AS control, CAST(count(*) * 5 AS BIGINT) AS data, CAST(count(*) * 9 AS BIGINT) AS subfields, '00000nam a2200000 a 4500' AS leader FROM part")
def _(s):
    """The elements that are in the written text."""
    path = _folder(s, "xml")
    ms.write_xml(records(s), path)
    text = s.spark.read.text(path)
    has = lambda part: F.sum(((F.length("value") - F.length(F.replace("value", F.lit(part), F.lit("")))) / len(part)).cast("bigint")).alias
    counted = text.agg(has("<record>")("records"), has("<controlfield tag=")("control"), has("<datafield tag=")("data"), has("<subfield code=")("subfields"), F.max(F.when(F.contains("value", F.lit("<leader>")), F.regexp_extract("value", "<leader>(.*)</leader>", 1)).otherwise("")).alias("leader"))
    return counted.select("records", "control", "data", "subfields", "leader")


@query("mrc8_binary_round_trip", """
SELECT p_partkey AS id, CAST(24 + 7 * 12 + 1 + length(CAST(p_partkey AS VARCHAR)) + 1 + length('890123s1990    xxu           f    eng  ') + 1 + 2 + 2 + length('ocm' || p_size) + 1
 + 2 + 2 + length('  The  ' || p_name || ':') + 2 + length(p_brand) + 1 + 2 + 2 + length('[S.l.]') + 2 + length(p_type) + 2 + 5 + 1 + 2 + 2 + length('Note.') + 1
 + 2 + 2 + length('u' || p_partkey) + 2 + length('v.' || p_size) + 1 + 1 AS BIGINT) AS length, '  The  ' || p_name || ':' AS title FROM part""")  # fmt: skip
def _(s):
    """Records written as ISO 2709 and read again: the length and the title of each."""
    length = F.substring("leader", 1, 5).cast("bigint").alias("length")
    return _values(ms.read_binary(s.spark, _binary(s)), length).select("id", "length", "title")


# ---- tables that are kept ----------------------------------------------------------------------------------------


@query("prj7_dictionary_loads", """
SELECT str, CASE WHEN first = 0 THEN row_number() OVER (PARTITION BY first ORDER BY str) ELSE (SELECT count(DISTINCT str) FROM a WHERE attr IN ('oclc', 'title')) + row_number() OVER (PARTITION BY first ORDER BY str) END AS str_id, first::INT AS load
FROM (SELECT str, min(CASE WHEN attr IN ('oclc', 'title') THEN 0 ELSE 1 END) AS first FROM a GROUP BY str)""", a=V.CLEAN)  # fmt: skip
def _(s):
    """Two loads of strings, the second given twice: numbers are dense and stay."""
    words = Dictionary(s.spark, _folder(s, "dictionary"))
    words.insert(s.attrs.where("attr in ('oclc', 'title')"))
    words.insert(s.attrs, 1)
    words.insert(s.attrs, 1)
    return words.entries()


@query("dml6_file_ids_kept", "SELECT file_path, CASE WHEN file_path = 'file-O' THEN 1 ELSE 1 + row_number() OVER (PARTITION BY file_path = 'file-O' ORDER BY file_path) END AS file_id FROM (SELECT DISTINCT file_path FROM r)", r=V.RECORDS)
def _(s):
    """Ids of files that were there before stay, new files get the next ones."""
    files = Dictionary(s.spark, _folder(s, "files"), "file_path", "file_id")
    files.insert(s.records.where("file_path = 'file-O'"))
    files.insert(s.records)
    return files.entries().drop("load")


_CONTENT = "SELECT c_custkey AS id, c_nationkey AS nation, c_mktsegment AS segment, c_custkey % 3 AS batch FROM {customer}"


@query("dml1_continuous_load", "SELECT nation, segment, arg_min(id, (batch, id)) AS id, CAST(min(batch) AS INT) AS load FROM c GROUP BY nation, segment", c=_CONTENT)
def _(s):
    """Three batches of a stream that hold late repeats of each other's contents; the second is given again."""
    rows, source, schema = s(_CONTENT), _folder(s, "arrived"), "id long, nation long, segment string"
    store = Store(s.spark, _folder(s, "store"), schema, ["nation", "segment"], ["id"])
    checkpoint = _folder(s, "progress")
    for batch in range(3):
        arrived = rows.where(F.col("batch") == batch).select(F.to_json(F.struct("id", "nation", "segment")).alias("value"))
        arrived.coalesce(1).write.mode("append").text(source)
        store.follow(lines_of(s.spark, source, schema), checkpoint).awaitTermination()
    store.insert(rows.where("batch = 1").select("id", F.col("nation").cast("long").alias("nation"), "segment"), 1)
    return store.read().drop("hashsum")


@query("clu1_components_in_loads", f"WITH RECURSIVE {_REACH} SELECT gd_id, cluster_id FROM comp", a=V.CLEAN)
def _(s):
    """Clusters after three loads of records, the second given twice, as all records at once give them."""
    kept = Clusters(s.spark, _folder(s, "clusters"))
    for load, part in enumerate((0, 1, 1, 2)):
        kept.insert(s.attrs.where(F.col("gd_id") % 3 == part), min(load, part))
    return kept.read()


@query("qry1_posting_lists", """SELECT gd_id FROM a WHERE (attr, str) IN (('pubdate', '1997'), ('publisher', 'GPO')) AND gd_id NOT IN (SELECT gd_id FROM a WHERE attr = 'enumc' AND str = 'v.3') GROUP BY gd_id HAVING count(DISTINCT attr) = 2""", a=V.CLEAN)
def _(s):
    """Records of two values that lack a third, from posting lists."""
    return kept_postings(s.dealt_attrs(), _folder(s, "postings")).find([("pubdate", "1997"), ("publisher", "GPO")], [("enumc", "v.3")])


@query("qry4_posting_strings", "SELECT DISTINCT str FROM a WHERE attr = 'publisher' ORDER BY str", a=V.CLEAN)
def _(s):
    return kept_postings(s.dealt_attrs(), _folder(s, "postings")).strings("publisher")


# ---- clusters, rules, agencies, maintenance ----------------------------------------------------------------------


@query("joi5_bipartite_traversal", f"WITH RECURSIVE {_REACH} SELECT cluster_id, count(DISTINCT k.gd_id) AS records, count(DISTINCT attr || chr(31) || str) AS values FROM k JOIN comp ON comp.gd_id = k.gd_id GROUP BY cluster_id", a=V.CLEAN)
def _(s):
    return cl.traverse(cl.identifier_keys(s.attrs, 0))


@query("joi9_pairs_of_a_set", f"SELECT x_.* FROM ({_CASCADE}) x_ WHERE verdict <> 'unr' AND id % 3 = 0 AND o_id % 3 = 0", s=_RULED)
def _(s):
    """All pairs i < j of a stated set of records that are not unrelated."""
    some = _ruled(s).where("id % 3 = 0")
    return ru.cascade(ru.decided_pairs(some)).select("id", "o_id", "verdict").where("verdict <> 'unr'")


@query("srt3_words_by_rarity", "SELECT gd_id, attr, bag.str, string_agg(x.word, ' ' ORDER BY freq, x.word) AS words FROM bag, (SELECT gd_id AS g, attr AS k, str AS t, unnest(words) AS word FROM bag) x JOIN f ON f.word = x.word WHERE g = gd_id AND k = attr AND t = bag.str GROUP BY 1, 2, 3", t=V.TITLES, bag=_BAG, f=_FREQ)
def _(s):
    return tt.by_rarity(tt.word_bags(s(V.TITLES))).select("gd_id", "attr", "str", F.array_join("words", " ").alias("words"))


_ANSWERED = "SELECT CASE s_suppkey % 2 WHEN 0 THEN 'dup' ELSE 'rel' END AS relation, s_suppkey % 13 AS set_id, s_suppkey AS member FROM {supplier}"


@query("rul5_evaluation", f"""WITH RECURSIVE v AS ({_REVIEWED}), e AS (SELECT verdict AS relation, id AS u, o_id AS w FROM v WHERE verdict IN ('dup', 'rel') UNION SELECT verdict, o_id, id FROM v WHERE verdict IN ('dup', 'rel')),
reach AS (SELECT DISTINCT relation, u AS n, u AS root FROM e UNION SELECT e.relation, e.w, r.root FROM reach r JOIN e ON e.relation = r.relation AND e.u = r.n WHERE r.root < e.w),
found AS (SELECT relation, n AS member, min(root) AS set_id FROM reach GROUP BY 1, 2), nf AS (SELECT relation, set_id, count(*) AS n FROM found GROUP BY 1, 2), na AS (SELECT relation, set_id, count(*) AS n FROM ans GROUP BY 1, 2),
sh AS (SELECT f.relation, f.set_id, a.set_id AS answer, count(*) AS k FROM found f JOIN ans a ON a.relation = f.relation AND a.member = f.member GROUP BY 1, 2, 3),
best AS (SELECT nf.relation, nf.set_id, coalesce(max(2 * k / (nf.n + na.n)), 0) AS f1 FROM nf LEFT JOIN sh ON sh.relation = nf.relation AND sh.set_id = nf.set_id LEFT JOIN na ON na.relation = sh.relation AND na.set_id = sh.answer GROUP BY 1, 2)
SELECT q.relation, coalesce(b.found, 0) AS found, q.sought, round(coalesce(b.s, 0) / q.sought, 6) AS f1 FROM (SELECT relation, count(*) AS sought FROM na GROUP BY 1) q LEFT JOIN (SELECT relation, count(*) AS found, sum(f1) AS s FROM best GROUP BY 1) b ON b.relation = q.relation""", s=_RULED, ans=_ANSWERED)  # fmt: skip
def _(s):
    """The sets of duplicates and of related records against answers; no pairs are made."""
    found = ru.verdict_sets(_ruled(s), ru.DUPLICATES_WITH_REVIEW, ru.RELATED_WITH_REVIEW)
    return ru.evaluate_sets(found, s(_ANSWERED)).withColumn("f1", F.round("f1", 6))


@query("rul5_review_list", f"SELECT id || ' <?> ' || o_id AS line FROM ({_REVIEWED}) WHERE verdict = 'rev'", s=_RULED)
def _(s):
    return ru.review_list(ru.cascade_with_review(ru.decided_pairs(_ruled(s), ru.DECIDING_WITH_REVIEW)))


@query("qry6_candidate_documents", rf"""
WITH n AS (SELECT agency, count(*) AS c FROM r GROUP BY agency),
m AS (SELECT DISTINCT r.sudoc_stem, r.agency FROM r JOIN n ON n.agency = r.agency WHERE {_agency_sql('r.agency', 'r.sudoc_stem')} AND (c >= 2 OR len(list_distinct(regexp_extract_all(r.agency, '{_KEEP}', 1))) >= 2)),
q AS (SELECT c_custkey AS id, {_fold_sql('upper(p)', True)} AS agency FROM c)
SELECT q.id || chr(9) || string_agg(DISTINCT regexp_replace(sudoc_stem, '^([A-Z]+)([0-9]+)$', '\1 \2'), chr(9) ORDER BY regexp_replace(sudoc_stem, '^([A-Z]+)([0-9]+)$', '\1 \2')) AS line FROM q JOIN m ON m.agency = q.agency GROUP BY q.id""",
    g=V.AGENCIES, r=_AGROWS, c=f"SELECT c_custkey, {V.pick(V.PUBLISHERS, 'c_custkey')} AS p FROM {{customer}}")
def _(s):
    """The map of agencies is built and written as blocks, and records are looked up in it."""
    rows = s(V.AGENCIES).select(F.array("sudoc").alias("sudoc"), F.array("agency", "agency2").alias("agency"))
    blocks = materialize(ag.agency_map_lines(ag.agency_map(rows, ACRONYMS)), "agencies")
    asked = s(f"SELECT c_custkey AS id, {V.pick(V.PUBLISHERS, 'c_custkey')} AS p FROM {{customer}}").select("id", F.array("p").alias("agency"))
    return ag.candidate_lines(asked, blocks)


@query("dml3_wipe", "SELECT 'attrs' AS name, CAST(0 AS BIGINT) AS n UNION ALL SELECT 'records', 0 UNION ALL SELECT 'strings', count(DISTINCT str) FROM a", a=V.CLEAN)
def _(s):
    left = ct.wipe({"records": s.records, "attrs": s.attrs, "strings": ct.dictionary(s.attrs)})
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name, df in sorted(left.items())]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
