"""Queries over MARC records made from the table of parts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bibweave.functions import marc as mc
from bibweave.functions.text import unicode_fold
from bibweave.plans import views as V
from bibweave.plans.spread import spread
from bibweave.queries import Source, query
from bibweave.sources import dump as dp
from bibweave.sources import marc as ms
from bibweave.sources.profiles import extract, to_attributes

PROFILE = [("001", "record_id"), ("035a", "oclc"), ("245a", "title"), ("245b", "title"), ("260b", "publisher"), ("260c", "pubdate"), ("974u", "item_id"), ("974z", "enumc")]


def marc_lines(s: Source, *keep: str) -> DataFrame:
    """``id, value``: a line of MARC in JSON for every part, and a banner line that is none; with columns of the part."""
    p = spread(s.table("part"), "p_partkey")
    text = lambda c: F.col(c).cast("string")
    data = lambda tag, *subs: F.concat(F.lit(f'{{"{tag}":{{"ind1":"1","ind2":" ","subfields":['), *subs, F.lit("]}}"))
    sub = lambda code, v, last=False: F.concat(F.lit(f'{{"{code}":"'), v, F.lit('"}' if last else '"},'))
    year = (1900 + F.col("p_partkey") % 100).cast("string")
    fields = [
        F.concat(F.lit('{"001":"'), text("p_partkey"), F.lit('"}')),
        F.concat(F.lit('{"008":"890123s'), year, F.lit("    xxu           f    eng  \"}")),
        data("035", sub("a", F.concat(F.lit("ocm"), text("p_size")), True)),
        data("245", sub("a", F.concat(F.lit("  The  "), F.col("p_name"), F.lit(":"))), sub("b", F.col("p_brand"), True)),
        data("260", sub("a", F.lit("[S.l.]")), sub("b", F.col("p_type")), sub("c", F.concat(F.lit("c"), year), True)),
        data("500", sub("a", F.lit("Note."), True)),
        data("974", sub("u", F.concat(F.lit("u"), text("p_partkey"))), sub("z", F.concat(F.lit("v."), text("p_size")), True)),
    ]
    line = F.concat(F.lit('{"leader":"00000nam a2200000 a 4500","fields":['), F.concat_ws(",", *fields), F.lit("]}"))
    banner = s.spark.sql("select cast(-1 as bigint) as id, '# a banner' as value")
    return p.select(F.col("p_partkey").alias("id"), line.alias("value"), *keep).unionByName(banner, allowMissingColumns=True)


def records(s: Source, *keep: str) -> DataFrame:
    return marc_lines(s, *keep).select("id", *keep, ms.parsed(F.col("value")))


@query("src1_json_records", "SELECT p_partkey AS id, '00000nam a2200000 a 4500' AS leader, CAST(7 AS BIGINT) AS n, '001,008,035,245,260,500,974' AS tags FROM part")
def _(s):
    return records(s).select("id", "leader", F.size("fields").cast("bigint").alias("n"), F.array_join(F.transform("fields", lambda f: f["tag"]), ",").alias("tags"))


@query("src4_normalized_override", "SELECT p_partkey AS id, CASE WHEN p_size % 3 = 0 THEN '' WHEN p_size % 3 = 1 THEN '999x:n' || p_size ELSE '035a:ocm' || p_size END AS oclc FROM part")
def _(s):
    given = F.when(F.col("p_size") % 3 == 0, F.array().cast("array<string>")).when(F.col("p_size") % 3 == 1, F.array(F.concat(F.lit("n"), F.col("p_size").cast("string"))))
    out = extract(records(s, "p_size").withColumn("oclc_resolved", given), PROFILE, fold=(), keep=("id",))
    return out.select("id", F.array_join(F.transform("oclc", lambda x: F.concat(x["marc_field"], F.lit(":"), x["value"])), ",").alias("oclc"))


@query("src5_dump_projection", "SELECT htid, title, pubdate FROM d WHERE gov_doc = '1'", d=V.DUMP)
def _(s):
    return dp.government_documents(s(V.DUMP)).select("htid", "title", "pubdate")


@query("src7_item_numbers", "SELECT CAST(p_partkey AS VARCHAR) AS htid, p_brand AS num FROM part JOIN (SELECT DISTINCT l_partkey FROM lineitem WHERE l_returnflag = 'A') ON l_partkey = p_partkey")
def _(s):
    bibs = s.table("part").select(F.col("p_partkey").alias("bibid"), F.concat(F.lit(" "), F.col("p_partkey").cast("string")).alias("htid"), "p_brand")
    kinds = s.table("lineitem").select(F.col("l_partkey").alias("bibid"), F.when(F.col("l_returnflag") == "A", "sudoc").otherwise("other").alias("type")).distinct()
    return dp.classified_numbers(bibs.withColumnRenamed("p_brand", "num"), kinds)


@query("src8_newest_file", "SELECT max('full_' || strftime(ts, '%Y%m%d') || '.txt') AS path FROM events")
def _(s):
    return dp.newest(s.table("events").select(F.concat(F.lit("full_"), F.date_format("ts", "yyyyMMdd"), F.lit(".txt")).alias("path")))


@query("src9_yaml_names", "SELECT DISTINCT upper(c_mktsegment) AS name FROM customer")
def _(s):
    return dp.names_in_yaml(s.table("customer").select(F.concat(F.lit("  - name: '"), F.lower("c_mktsegment"), F.lit("'")).alias("value")))


@query("src11_distinct_paths", "SELECT DISTINCT file_path FROM r", r=V.RECORDS)
def _(s):
    return s.records.select("file_path").distinct()


@query("prj1_field_values", "SELECT p_partkey AS id, 'The ' || p_name || ':|' || p_brand AS title, 'ocm' || p_size AS oclc, CAST(p_partkey AS VARCHAR) AS control FROM part")
def _(s):
    join = lambda spec: F.array_join(mc.values_of(spec), "|")
    return records(s).select("id", join("245").alias("title"), join("035a").alias("oclc"), join("001").alias("control"))


@query("prj2_publication_date", "SELECT p_partkey AS id, CAST(1900 + p_partkey % 100 AS VARCHAR) AS date FROM part")
def _(s):
    return records(s).select("id", mc.publication_date(mc.single_008(mc.values_of("008"))).alias("date"))


@query("prj5_folded_text", "SELECT p_partkey AS id, lower(p_name) || ' ecole ' || lower(replace(p_brand, '#', ' ')) AS text FROM part")
def _(s):
    return s.table("part").select(F.col("p_partkey").alias("id"), unicode_fold(F.concat("p_name", F.lit(" École "), "p_brand")).alias("text"))


@query("prj5_attributes", "SELECT p_partkey AS gd_id, 'title' AS attr, '245a' AS marc_field, 'the ' || lower(p_name) AS str FROM part UNION ALL SELECT p_partkey, 'title', '245b', lower(replace(p_brand, '#', ' ')) FROM part UNION ALL SELECT p_partkey, 'publisher', '260b', lower(p_type) FROM part UNION ALL SELECT p_partkey, 'pubdate', '008', CAST(1900 + p_partkey % 100 AS VARCHAR) FROM part UNION ALL SELECT p_partkey, 'pubdate', '260c', 'c' || CAST(1900 + p_partkey % 100 AS VARCHAR) FROM part")
def _(s):
    return to_attributes(extract(records(s), PROFILE, keep=("id",)), "id", ["title", "publisher", "pubdate"])


@query("prj16_flat_lines", "SELECT p_partkey AS id, '001' || chr(9) || p_partkey AS first, '974z' || chr(9) || 'v.' || p_size AS last, CAST(11 AS BIGINT) AS n FROM part")
def _(s):
    lines = mc.flat_lines()
    return records(s).select("id", F.get(lines, F.lit(0)).alias("first"), F.element_at(lines, -1).alias("last"), F.size(lines).cast("bigint").alias("n"))


@query("prj17_small_projection", "SELECT p_partkey AS id, '890123s' || CAST(1900 + p_partkey % 100 AS VARCHAR) || '    xxu           f    eng  ' AS f008, p_type AS f260_b, CAST(NULL AS VARCHAR) AS f710 FROM part")
def _(s):
    last = lambda tag: F.try_element_at(mc.fields_of(tag), F.lit(-1))
    letters = F.transform(F.filter(last("710")["subfields"], lambda x: x["code"].rlike("[a-z]")), lambda x: x["value"])
    return records(s).select("id", last("008")["value"].alias("f008"), mc.subfield_of(last("260"), "b").alias("f260_b"), F.array_join(letters, "|").alias("f710"))


@query("flt6_marc_grep", "SELECT p_partkey AS id, '260b' || chr(9) || p_type AS lines FROM part WHERE p_type ILIKE 'econ%' AND ('ocm' || p_size) LIKE 'ocm1%'")
def _(s):
    lines = mc.flat_lines()
    found = records(s).where(mc.matches_lines(lines, ["260b=econ", "035a=ocm1"]))
    return found.select("id", F.array_join(mc.matching_lines(lines, ["260b=econ"]), "|").alias("lines"))


@query("mrc10_json_round_trip", "SELECT p_partkey AS id, true AS same FROM part")
def _(s):
    again = records(s).select("id", "leader", "fields", ms.parsed(ms.to_json()).alias("again", "fields_again"))
    return again.select("id", ((F.col("fields_again") == F.col("fields")) & (F.col("again") == F.col("leader"))).alias("same"))


@query("mrc11_field_lookup", "SELECT p_partkey AS id, p_brand AS b, CAST(3 AS BIGINT) AS early, CAST(2 AS BIGINT) AS some FROM part")
def _(s):
    size = lambda x: F.size(x).cast("bigint")
    return records(s).select("id", mc.subfield_of(mc.first_field("245"), "b").alias("b"), size(mc.fields_of("001", "099")).alias("early"), size(mc.fields_of(["245", "500", "999"])).alias("some"))


@query("mrc12_field_text", "SELECT p_partkey AS id, '035 1  $a ocm' || p_size AS line, '  The  ' || p_name || ':' || p_brand AS value, 'a,b,c' AS codes FROM part")
def _(s):
    return records(s).select("id", mc.field_text(mc.first_field("035")).alias("line"), mc.field_value(mc.first_field("245")).alias("value"), F.array_join(mc.codes_of(mc.first_field("260")), ",").alias("codes"))


_ELEMENTS = ("title", "creator", "subject", "publisher", "date", "type", "format", "identifier", "source", "language", "coverage", "rights", "description", "relation")
_MORE = (
    ("100", "a", "p_brand"), ("650", "a", "p_type"), ("655", "a", "p_brand"), ("856", "q", "p_type"), ("856", "u", "p_name"), ("786", "t", "p_brand"), ("546", "a", "p_type"), ("651", "a", "p_name"), ("540", "a", "p_brand"), ("530", "a", "p_type"), ("773", "t", "p_name"),
)


@query("mrc13_dublin_core", "SELECT p_partkey AS id, '  The  ' || p_name || ':' AS title, p_brand AS creator, p_type AS subject, p_type AS publisher, 'c' || CAST(1900 + p_partkey % 100 AS VARCHAR) AS date, p_brand AS type, p_type AS format, p_name AS identifier, p_brand AS source, p_type AS language, p_name AS coverage, p_brand AS rights, 'Note.' AS description, p_type || '|' || p_brand || '|' || p_name AS relation FROM part")
def _(s):
    sub = lambda code, c: F.array(F.struct(F.lit(code).alias("code"), F.col(c).alias("value")))
    more = F.array(*(F.struct(F.lit(tag).alias("tag"), F.lit(" ").alias("ind1"), F.lit(" ").alias("ind2"), F.lit(None).cast("string").alias("value"), sub(code, c).alias("subfields")) for tag, code, c in _MORE))
    dc = records(s, "p_name", "p_brand", "p_type").withColumn("fields", F.concat("fields", more)).select("id", mc.dublin_core().alias("d"))
    return dc.select("id", *(F.array_join(F.col(f"d.{k}"), "|").alias(k) for k in _ELEMENTS))
