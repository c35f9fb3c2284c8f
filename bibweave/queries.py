"""One query per operator over whole tables, each with the SQL that it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bibweave.functions import text as tx
from bibweave.operators import agencies as ag
from bibweave.operators import catalog as ct
from bibweave.operators import clusters as cl
from bibweave.operators import lookup as lk
from bibweave.operators import related as rl
from bibweave.operators import rules as ru
from bibweave.operators import titles as tt
from bibweave.plans import views as V
from bibweave.plans.spread import dealt

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
ACRONYMS = ("NASA", "GPO", "USGPO", "NIH", "USDA")


class Source:
    """Views and tables of one folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def __call__(self, sql: str) -> DataFrame:
        return V.view(self.spark, self.dir, sql)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def attr_rows(self) -> int:
        """A bound of the attribute rows: up to seven of an order, and as many as it has items at most, of which most are returned or old."""
        return 9 * self.table("orders").count()

    def dealt_attrs(self, *keys: str) -> DataFrame:
        """Attribute rows dealt by ``keys``, if any, in parts of bounded size; what a line item holds is made distinct in such parts too."""
        items = self.table("lineitem")
        rows = V.view(self.spark, self.dir, V.CLEAN, lineitem=dealt(items, items.count(), "l_orderkey"))
        return dealt(rows, self.attr_rows(), *keys) if keys else rows

    attrs = property(lambda self: self(V.CLEAN))
    raw = property(lambda self: self(V.ATTRS))
    records = property(lambda self: self(V.RECORDS))


def query(name: str, sql: str | None = None, **views: str):
    """Register a query of a :class:`Source`; ``views`` become common table expressions before ``sql``."""

    def add(f):
        QUERIES[name] = lambda spark, sf_dir: f(Source(spark, sf_dir))
        if sql is not None:
            parts = [f"{k} AS ({V.for_duckdb(v)})" for k, v in views.items()]
            body = sql.strip()
            if body.upper().startswith("WITH RECURSIVE"):
                SQL[name] = "WITH RECURSIVE " + ", ".join([*parts, body[len("WITH RECURSIVE") :]])
            elif body.upper().startswith("WITH"):
                SQL[name] = "WITH " + ", ".join([*parts, body[len("WITH") :]])
            else:
                SQL[name] = ("WITH " + ", ".join(parts) + " " if parts else "") + body
        return f

    return add


def joined(column: str) -> F.Column:
    """An array as text, so engines compare it alike."""
    return F.array_join(F.col(column).cast("array<string>"), ",")


# ---- projections -------------------------------------------------------------------------------------------------

_HELD = "SELECT l_orderkey AS id, 'v.' || CAST(l_linenumber AS STRING) AS e, 'i' || CAST(l_partkey AS STRING) AS i, l_linenumber AS k, l_partkey AS p FROM {lineitem}"


def _lists(s: Source) -> DataFrame:
    rows = s(_HELD)
    e = F.array_sort(F.collect_set("e"))
    i = F.slice(F.array_sort(F.collect_set(F.when(F.col("p") % 3 == 0, F.col("i")))), 1, 2)
    return rows.groupBy("id").agg(F.when(F.col("id") % 6 != 0, e).alias("enumc"), i.alias("item_id"))


_LISTS = "SELECT id, CASE WHEN id % 6 <> 0 THEN list_sort(list_distinct(list(e))) END AS enumc, coalesce(list_sort(list_distinct(list(i) FILTER (WHERE p % 3 = 0)))[1:2], []) AS item_id FROM held GROUP BY id"


@query("prj3_holdings_split", """
WITH x AS (SELECT *, coalesce(len(enumc), 0) > 0 AND len(item_id) > 0 AS b FROM lists)
SELECT id, CAST(n - 1 AS INTEGER) AS pos, enumc[n] AS enumc_value, item_id[n] AS item_value FROM (SELECT *, unnest(range(1, len(enumc) + 1)) AS n FROM x WHERE b)
UNION ALL SELECT id, 0, enumc[1], item_id[1] FROM x WHERE NOT b""", held=_HELD, lists=_LISTS)  # fmt: skip
def _(s):
    return ct.split_holdings(_lists(s))


@query("prj4_enumeration_split", "SELECT id, unnest(enumc) AS enumc FROM lists WHERE enumc IS NOT NULL UNION ALL SELECT id, NULL FROM lists WHERE enumc IS NULL", held=_HELD, lists=_LISTS)
def _(s):
    return ct.split_enumerations(_lists(s)).select("id", "enumc")


@query("prj6_string_folding", r"SELECT doc_id, substr(regexp_replace(regexp_replace(text, '[ \t\n\x0B\f\r]+', ' ', 'g'), '^ | $', '', 'g'), 1, 750) AS str FROM documents")
def _(s):
    return s.table("documents").select("doc_id", tx.fold_spaces("text").alias("str"))


@query("prj7_dictionary", "SELECT DISTINCT CAST('0x' || substr(md5(str), 1, 15) AS BIGINT) AS str_id, str FROM a", a=V.CLEAN)
def _(s):
    return ct.dictionary(s.attrs)


@query("prj8_cleaned_attributes", "SELECT attr, count(*) AS n, count(DISTINCT str) AS d FROM a WHERE str <> '' GROUP BY attr", a=V.CLEAN)
def _(s):
    return ct.clean_attributes(s.raw).groupBy("attr").agg(F.count("*").alias("n"), F.count_distinct("str").alias("d"))


# The rules as they are stated, for SQL only; the operators have tables of their own, so neither vouches for itself.
_REWRITES = (
    (r"[,\.:;]|'S?", "", "g"), (r"[\(\)\{\}\[\]]", "", "g"), ("FOR SALE BY.*", "", "g"), (r"\b(THE) ", "", "g"), ("DEPARTMENT", "DEPT", "g"), ("DEPTOF", "DEPT OF", "g"),
    ("UNITED STATES( OF AMERICA)?", "US", "g"), (r"U\sS\s|U S$", "US ", "g"), ("GOVERNMENT", "GOVT", "g"), (" SPN$", "", "g"),
    (r"(US\s?)?GOVT\s?PRINT(ING)?\s?OFF(ICE)?", "USGPO", ""), (r"U\s?S\s?G\s?P\s?O", "USGPO", ""), ("US.*GO.+P.*O", "USGPO", "publisher"), ("^GPO$", "USGPO", ""),
)
_DATE_SQL = r"c?-?\d{4}\??(\s*(-|i.\s*e.|or)?\s*c?\d{0,4})\??"
_OPEN_DATE_SQL = r"c?-?[0-9u]{4}\??(\s*(-|i.\s*e.|or)?\s*c?[0-9u]{0,4})\??"
_JUNK_SQL = r"""[,:;\.\-\(\)\[\]\{\}<>\|\$!"'#\*\+\/\\]"""
_STATES_SQL = (
    "ALABAMA|ALASKA|ARIZONA|ARKANSAS|CALIFORNIA|COLORADO|CONNECTICUT|DELAWARE|DISTRICT OF COLUMBIA|FLORIDA|GEORGIA|HAWAII|IDAHO|ILLINOIS|INDIANA|IOWA|KANSAS|KENTUCKY|LOUISIANA|MAINE|"
    "MARYLAND|MASSACHUSETTS|MICHIGAN|MINNESOTA|MISSISSIPPI|MISSOURI|MONTANA|NEBRASKA|NEVADA|NEW HAMPSHIRE|NEW JERSEY|NEW MEXICO|NEW YORK|NORTH CAROLINA|NORTH DAKOTA|OHIO|OKLAHOMA|OREGON|"
    "PENNSYLVANIA|RHODE ISLAND|SOUTH CAROLINA|SOUTH DAKOTA|TENNESSEE|TEXAS|UTAH|VERMONT|VIRGINIA|WASHINGTON|WEST VIRGINIA|WISCONSIN|WYOMING"
)
_STOP_SQL = (
    "ACADEMY|ADMINISTRATION|AGENCY|ASSOCIATION|BOARD|BRANCH|BUREAU|CENTER|COMMAND|COMMISSION|COMMITTEE|CORPS|COUNCIL|COURT|DEPT|DIRECTORATE|DISTRICT|DIVISION|FOUNDATION|GROUP|INSTITUTE|"
    "LABORATORY|LIBRARY|OFFICE|PROGRAM|REGION|SCHOOL|SECTION|SERVICE|SERVICES|SN|STAFF|STATION|SURVEY|TEAM|US"
)
_KEEP_SQL = (
    "ADMIN|ADVISORY|AGENCY|AID|AIR|ARMED|ARMY|ATTORNEY|BOARD|BUREAU|CENSUS|CENTER|CHIEF|COMMAND|COMMISSION|COMMITTEE|COMPTROLLER|CONGRESS|CORPS|COUNCIL|COUNSEL|COURT|DEFENSE|DELEGATION|DEPT|"
    "DIRECTORATE|DIVISION|EEUU|ENDOWMENT|ESTADOS UNIDOS|FEDERAL|FORCE|GEOLOGICAL SURVEY|GOVT|GROUP|HEARING|INSTITUTE|JOINT VENTURE|LEGISL|MANAGEMENT|MARINE|MARITIME|MISSION|NATIONAL|NAVAL|"
    "NAVY|OFFICE|PANEL|PEACE|POLICY|PRESIDENT|PROGRAM|PROJECT|RESERVE|RURAL|SCIENCE CENTER|SECRETARY|SENATE|SERVICE|SUPERINTENDENT|TASK FORCE|TEAM|TRADE|US|VETERAN|WAR|WHITE HOUSE"
)


def _fold_sql(x: str, agency: bool) -> str:
    for p, to, kind in _REWRITES:
        if not (agency and kind == "publisher"):
            x = f"regexp_replace({x}, '{p.replace(chr(39), chr(39) * 2)}', '{to}'{', ' + chr(39) + 'g' + chr(39) if kind == 'g' else ''})"
    return f"regexp_replace(regexp_replace({x}, ' +', ' ', 'g'), '^ | $', '', 'g')"


_PUB = f"SELECT c_custkey AS k, {V.pick(V.PUBLISHERS, 'c_custkey')} AS p FROM {{customer}}"


@query("prj9_publisher_names", f"SELECT k, {_fold_sql('p', False)} AS name FROM p", p=_PUB)
def _(s):
    return s(_PUB).select("k", tx.normalize_publisher("p").alias("name"))


@query("prj10_agency_counts", f"SELECT agency, CAST(sum(c) AS BIGINT) AS c FROM (SELECT {_fold_sql('upper(p)', True)} AS agency, count(*) AS c FROM p GROUP BY p) WHERE agency <> '' GROUP BY agency", p=_PUB)
def _(s):
    return ag.normalized_counts(s(_PUB).groupBy(F.col("p").alias("agency")).agg(F.count("*").alias("c")))


_STEM = r"CASE WHEN contains(regexp_extract(sudoc, '^([^.]+)', 1), '-') OR NOT regexp_matches(regexp_replace(upper(regexp_extract(sudoc, '^([^.]+)', 1)), 'II0\s*A', '', 'g'), '[a-zA-Z]') THEN NULL ELSE regexp_replace(upper(regexp_extract(sudoc, '^([^.]+)', 1)), 'II0\s*A', '', 'g') END"


@query("prj11_sudoc_stems", f"SELECT id, {_STEM} AS stem FROM g", g=V.AGENCIES)
def _(s):
    return s(V.AGENCIES).select("id", tx.stem_sudoc("sudoc").alias("stem"))


_CODES = "SELECT s_suppkey AS id, CASE s_suppkey % 3 WHEN 0 THEN 'Y' || CAST(s_nationkey AS STRING) WHEN 1 THEN 'Y ' || CAST(s_nationkey AS STRING) ELSE 'y' || CAST(s_nationkey AS STRING) END AS code FROM {supplier}"


@query("prj12_sudoc_spacing", r"SELECT id, regexp_replace(code, '^([A-Z]+)([0-9]+)$', '\1 \2') AS code FROM c", c=_CODES)
def _(s):
    return s(_CODES).select("id", tx.space_sudoc("code").alias("code"))


_PIECES = r"list_transform(string_split_regex(imprint, '[,:;]'), lambda x: regexp_replace(trim(x), '[\[\]<>\(\)]', '', 'g'))"


@query("prj13_imprint_parse", rf"""
WITH u AS (SELECT htid, {_PIECES} AS a FROM d), v AS (SELECT htid, a[len(a)] AS z FROM u), w AS (SELECT htid, nullif(regexp_extract(z, '{_DATE_SQL}', 0), '') AS pub_date FROM v),
n AS (SELECT u.htid, i, CASE WHEN i = len(a) AND pub_date IS NOT NULL THEN replace(a[i], pub_date, '') ELSE a[i] END AS x FROM (SELECT htid, a, unnest(range(1, len(a) + 1)) AS i FROM u) u JOIN w ON w.htid = u.htid),
m AS (SELECT htid, {_fold_sql('x', False)} AS p FROM n)
SELECT w.htid, w.pub_date, coalesce((SELECT string_agg(DISTINCT p, '|' ORDER BY p) FROM m WHERE m.htid = w.htid AND p <> ''), '') AS publishers FROM w""", d=V.DUMP)  # fmt: skip
def _(s):
    return s(V.DUMP).select("htid", tx.imprint_date("imprint").alias("pub_date"), F.array_join(F.array_sort(tx.imprint_publishers("imprint")), "|").alias("publishers"))


@query("prj14_title_folding", "SELECT p_partkey, regexp_replace(regexp_replace(lower(p_name || ' #' || p_brand), '[^a-z0-9 ]', '', 'g'), ' +', ' ', 'g') AS title FROM part")
def _(s):
    return s.table("part").select("p_partkey", tx.fold_title(F.concat("p_name", F.lit(" #"), "p_brand")).alias("title"))


_JUNK = _JUNK_SQL.replace("'", "''")
_CANON = f"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(imprint), '{_OPEN_DATE_SQL}', '', 'g'), '{_JUNK}', ' ', 'g'), 'for sale by.+', '', 'g'), ' +', ' ', 'g'))"


@query("prj15_imprint_canonical", f"SELECT htid, CASE WHEN regexp_matches({_CANON}, '[a-z]') THEN {_CANON} END AS name FROM d", d=V.DUMP)
def _(s):
    return s(V.DUMP).select("htid", tx.canonical_imprint("imprint").alias("name"))


@query("prj18_content_hash", """SELECT c_custkey, sha256('{"c_custkey":' || c_custkey || ',"c_mktsegment":"' || c_mktsegment || '","c_name":"' || c_name || '"}') AS hashsum FROM customer""")
def _(s):
    return s.table("customer").select("c_custkey", ct.content_hash(["c_custkey", "c_mktsegment", "c_name"]).alias("hashsum"))


_WIDE = ", ".join(f"max(CASE WHEN attr = '{k}' THEN str END) AS {k}" for k in ("pubdate", "publisher", "sudoc", "oclc", "lccn", "issn", "title"))
_FIVE = "md5(concat_ws(',', " + ", ".join(f"coalesce({k}, '')" for k in cl.CHECKSUM) + "))"


@query("prj19_checksums", f"SELECT gd_id, {_FIVE} AS checksum FROM (SELECT gd_id, {_WIDE} FROM a GROUP BY gd_id)", a=V.CLEAN)
def _(s):
    return cl.checksums(s.attrs, s.records)


@query("prj20_scalars", """
SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'F'), 'none') AS status, concat_ws('-', o_orderstatus, o_orderpriority) AS joined, md5(o_orderpriority) AS digest,
 CAST(coalesce(nullif(regexp_extract(o_orderpriority, '^\\s*(\\d+)', 1), ''), '0') AS BIGINT) AS leading, strftime(o_orderdate, '%Y-%m') AS month, sha256(o_orderpriority) AS password FROM orders""".replace("\\\\", "\\"))  # fmt: skip
def _(s):
    return s.table("orders").select(
        "o_orderkey", F.coalesce(F.nullif("o_orderstatus", F.lit("F")), F.lit("none")).alias("status"), F.concat_ws("-", "o_orderstatus", "o_orderpriority").alias("joined"),
        F.md5("o_orderpriority").alias("digest"), tx.lenient_int("o_orderpriority").alias("leading"), F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.sha2("o_orderpriority", 256).alias("password"),
    )


# ---- filters -----------------------------------------------------------------------------------------------------



def _f008(s: Source) -> DataFrame:
    o = s.table("orders")
    flag = F.when(F.col("o_orderkey") % 2 == 0, "u").otherwise(" ")
    fed = F.when(F.col("o_custkey") % 3 == 0, "f").otherwise(" ")
    line = F.concat(F.lit('{"001":"x","008":"890123s1990    '), F.lower(F.substring("o_orderpriority", 3, 2)), flag, F.lit(" " * 10), fed, F.lit('  eng"}'))
    return o.select(F.col("o_orderkey").alias("id"), line.alias("line"))


_LINES = "SELECT o_orderkey AS id, '{\"001\":\"x\",\"008\":\"890123s1990    ' || lower(substr(o_orderpriority, 3, 2)) || CASE WHEN o_orderkey % 2 = 0 THEN 'u' ELSE ' ' END || '          ' || CASE WHEN o_custkey % 3 = 0 THEN 'f' ELSE ' ' END || '  eng\"}' AS line FROM orders"


def _first_008(line: str = "line") -> F.Column:
    return F.regexp_extract(line, r'"008"\s*:\s*"([^"]*)"', 1)


@query("flt1_single_008", "WITH l AS (" + _LINES + """), n AS (SELECT id, CASE WHEN id % 4 = 0 THEN 2 ELSE 1 END AS k, regexp_extract(line, '"008":"([^"]*)"', 1) AS f FROM l) SELECT id, CASE WHEN k = 1 THEN f END AS f008 FROM n""")
def _(s):
    from bibweave.functions.marc import single_008

    lists = _f008(s).select("id", F.array_repeat(_first_008(), F.when(F.col("id") % 4 == 0, 2).otherwise(1)).alias("f"))
    return lists.select("id", single_008(F.col("f")).alias("f008"))


@query("flt2_us_federal", "WITH l AS (" + _LINES + """) SELECT id FROM (SELECT id, regexp_extract(line, '"008":"([^"]*)"', 1) AS f FROM l) WHERE substr(f, 18, 1) = 'u' AND substr(f, 29, 1) = 'f'""")
def _(s):
    from bibweave.functions.marc import is_us_federal

    return _f008(s).where(is_us_federal(_first_008())).select("id")


@query("flt3_federal_lines", "WITH l AS (" + _LINES + """) SELECT id, line FROM l WHERE regexp_matches(substr(regexp_extract(line, '"008":"([^"]*)"', 1), 16, 3), '^[a-z]{2}u$') AND substr(regexp_extract(line, '"008":"([^"]*)"', 1), 29, 1) = 'f'""")
def _(s):
    f = _first_008()
    return _f008(s).where(F.substring(f, 16, 3).rlike("^[a-z]{2}u$") & (F.substring(f, 29, 1) == "f"))


@query("flt4_not_federal", "WITH l AS (" + _LINES + """) SELECT id FROM l WHERE substr(regexp_extract(line, '"008":"([^"]*)"', 1), 29, 1) <> 'f'""")
def _(s):
    f = _first_008()
    return _f008(s).where((f != "") & (F.substring(f, 29, 1) != "f")).select("id")


@query("flt5_json_lines", "SELECT event_id FROM events WHERE props LIKE '{%'")
def _(s):
    return s.table("events").where(F.col("props").startswith("{")).select("event_id")


@query("flt7_where_fragment", "SELECT gd_id, str FROM a WHERE attr = 'title' AND (str LIKE '%URGENT%' AND marc_field = '245a')", a=V.CLEAN)
def _(s):
    return s.attrs.where("attr = 'title'").where(F.expr("str like '%URGENT%' and marc_field = '245a'")).select("gd_id", "str")


@query("flt8_in_list", "SELECT gd_id, attr, str FROM a WHERE gd_id IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 49)", a=V.CLEAN)
def _(s):
    ids = s.table("lineitem").where("l_quantity > 49").select(F.col("l_orderkey").alias("gd_id"))
    # in as many parts as the attribute rows, which would be dealt again otherwise; a semi-join would be moved ahead of the dealing
    ids = dealt(ids, s.attr_rows(), "gd_id").distinct()
    return s.dealt_attrs("gd_id").join(ids, "gd_id").select("gd_id", "attr", "str")


def _agency_sql(name: str, stem: str) -> str:
    """The conditions in the order in which they are stated."""
    def m(p: str) -> str:
        return f"regexp_matches({name}, '{p}')"

    acronyms = "|".join(ACRONYMS)
    return " AND ".join([
        f"{name} <> ''", f"NOT {m(f'^({_STOP_SQL})$')}", f"NOT (NOT contains({name}, ' ') AND NOT {m(f'^({acronyms})$')})", f"NOT {m('UNIVERSITY OF')}",
        f"NOT (NOT regexp_matches({stem}, 'GP|PR') AND contains({name}, 'GPO'))", f"NOT ({m('UNIVERSITY')} AND NOT {m('OFFICE|US DEPT|ADMINISTRATION')})",
        f"NOT ({m('COLLEGE|SCHOOL')} AND NOT {m('DEFENSE|NAVAL|ARMED FORCES|USAF|INFANTRY|COMMITTEE|COMMISSION|OFFICE')})",
        f"NOT ({m('CORPORATION')} AND NOT {m('^US.+(AGENCY|COMMITTEE|CONGRESS|DEPT|SENATE)')})",
        "NOT " + m(r"\b((AND)? CO(MPANY)?|INC(ORPORATED)?|L(IMI)?TE?D|ASSOCIATES|FIRM|LLC)\b"),
        f"NOT ({m('FOUNDATION')} AND NOT {m('(AFRICAN DEVELOPMENT|INTER-AMERICAN|NATIONAL SCIENCE)')})",
        "NOT " + m(rf"({_STATES_SQL})\s*(STATE)?\s*DEPT OF"), f"NOT {m(f'^((NORTH|EAST|SOUTH|WEST)(ERN)?|CENTRAL| )*({_STATES_SQL})')}", f"NOT {m(f'^[^ ]+ ({_STATES_SQL})')}",
        f"NOT {m('^[^ ]+ AND [^ ]+$')}", f"NOT {m('(SOCIETY (OF|FOR)|SOCIETY( US)?$)')}", "NOT (" + m(r"\bCOUNTY\b") + " AND NOT " + m(r"\bUS\b") + ")",
    ])


_AGROWS = f"SELECT stem AS sudoc_stem, {_fold_sql('upper(agency)', True)} AS agency FROM (SELECT {_STEM} AS stem, unnest([agency, agency2]) AS agency FROM g) WHERE stem IS NOT NULL"


@query("flt9_agency_exclusions", f"SELECT sudoc_stem, agency, count(*) AS n FROM r WHERE {_agency_sql('agency', 'sudoc_stem')} GROUP BY 1, 2", g=V.AGENCIES, r=_AGROWS)
def _(s):
    names = F.transform(F.array("agency", "agency2"), tx.normalize_agency)
    rows = s(V.AGENCIES).select(tx.stem_sudoc("sudoc").alias("sudoc_stem"), F.explode(names).alias("agency")).where("sudoc_stem is not null")
    return rows.where(ag.is_agency(F.col("agency"), F.col("sudoc_stem"), ACRONYMS)).groupBy("sudoc_stem", "agency").agg(F.count("*").alias("n"))


@query("flt10_strange_years", r"""
WITH x AS (SELECT htid, pubdate, unnest([0, 1, 2, 3]) AS pos, unnest([htid, record_id, imprint, title]) AS v FROM d)
SELECT pos, count(*) AS n FROM x WHERE regexp_matches(v, '\b' || pubdate || '\b') GROUP BY pos""", d=V.DUMP)  # fmt: skip
def _(s):
    rows = s(V.DUMP).select("pubdate", F.posexplode(F.array("htid", "record_id", "imprint", "title")).alias("pos", "v"))
    return rows.where(F.expr(r"v rlike concat('\\b', pubdate, '\\b')")).groupBy("pos").agg(F.count("*").alias("n"))


@query("flt11_last_row_per_key", """
SELECT record_id, htid FROM (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY CAST(substr(htid, 2) AS BIGINT) DESC) AS n FROM d WHERE CAST(record_id AS INTEGER) < 40) WHERE n = 1""", d=V.DUMP)  # fmt: skip
def _(s):
    rows = s(V.DUMP).where("cast(record_id as int) < 40").withColumn("at", F.substring("htid", 2, 20).cast("bigint"))
    return ct.last_wins(rows, ["record_id"], ["at"]).select("record_id", "htid")


# ---- joins and sets ----------------------------------------------------------------------------------------------


@query("joi1_decode", "SELECT a.gd_id, a.attr, d.str FROM a JOIN (SELECT DISTINCT str, md5(str) AS h FROM a) d ON md5(a.str) = d.h WHERE attr IN ('title', 'publisher')", a=V.CLEAN)
def _(s):
    coded = s.attrs.where("attr in ('title', 'publisher')").select("gd_id", "attr", ct.string_id(F.col("str")).alias("str_id"))
    return coded.join(ct.dictionary(s.attrs), "str_id").select("gd_id", "attr", "str")


_KINDS = ("oclc", "title", "enumc", "publisher", "lccn")
_FAN = "w AS (SELECT gd_id, " + ", ".join(f"list(str) FILTER (WHERE attr = '{k}') AS {k}" for k in _KINDS) + " FROM a GROUP BY gd_id), f0 AS (SELECT r.gd_id, " + ", ".join(f"coalesce(w.{k}, [NULL]) AS {k}" for k in _KINDS) + " FROM r LEFT JOIN w ON w.gd_id = r.gd_id)"
for _i, _k in enumerate(_KINDS):
    _FAN += f", f{_i + 1} AS (SELECT gd_id, " + ", ".join(f"unnest({k}) AS {k}" if k == _k else k for k in _KINDS) + f" FROM f{_i})"
_FAN = f"WITH {_FAN} SELECT * FROM f{len(_KINDS)}"


@query("joi2_left_fan_out", _FAN, a=V.CLEAN, r=V.RECORDS)
def _(s):
    kinds = _KINDS
    wide = s.attrs.where(F.col("attr").isin(*kinds)).groupBy("gd_id").agg(*(F.collect_list(F.when(F.col("attr") == k, F.col("str"))).alias(k) for k in kinds))
    out = s.records.select("gd_id").join(wide, "gd_id", "left")
    for k in kinds:
        out = out.withColumn(k, F.explode_outer(k))
    return out


_CANONICAL = "SELECT old, min(new) AS new FROM (SELECT x.oclc AS old, y.oclc AS new FROM v x JOIN v y ON x.volume_id = y.volume_id) GROUP BY old HAVING old <> min(new)"


@query("joi3_volume_self_join", "SELECT x.oclc AS old, min(y.oclc) AS least FROM v x JOIN v y ON x.volume_id = y.volume_id GROUP BY x.oclc", v=V.VOLUMES)
def _(s):
    v = s(V.VOLUMES)
    least = v.groupBy("volume_id").agg(F.min("oclc").alias("m"))
    return v.join(least, "volume_id").groupBy(F.col("oclc").alias("old")).agg(F.min("m").alias("least"))


@query("joi4_token_self_join", """
WITH t AS (SELECT DISTINCT p_partkey AS id, unnest(string_split(p_name, ' ') || [p_brand]) AS word FROM part)
SELECT x.id, y.id AS other_id, count(*) AS shared FROM t x JOIN t y ON x.word = y.word AND x.id < y.id GROUP BY x.id, y.id HAVING count(*) > 2""")  # fmt: skip
def _(s):
    return tt.shared_words(s.table("part").select(F.col("p_partkey").alias("id"), F.explode(F.concat(F.split("p_name", " "), F.array("p_brand"))).alias("word")))


@query("joi6_semi_imprints", "SELECT htid, imprint FROM d WHERE imprint IN (SELECT DISTINCT imprint FROM d WHERE gov_doc = '1')", d=V.DUMP)
def _(s):
    listed = s(V.DUMP).where("gov_doc = '1'").select("imprint").distinct()
    return s(V.DUMP).join(listed, "imprint", "left_semi").select("htid", "imprint")


@query("joi7_unused_strings", "SELECT DISTINCT str FROM a WHERE str NOT IN (SELECT str FROM a WHERE attr IN ('title', 'pubdate', 'enumc'))", a=V.CLEAN)
def _(s):
    return ct.unused_strings(ct.dictionary(s.attrs).select("str"), s.attrs.where("attr in ('title', 'pubdate', 'enumc')"))


@query("joi8_anti_matched", "SELECT gd_id FROM r WHERE gd_id NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')", r=V.RECORDS)
def _(s):
    found = s.table("lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("gd_id"))
    return tt.unmatched(s.records.select("gd_id"), found)


@query("joi10_stems_of_agencies", rf"""
WITH m AS (SELECT DISTINCT sudoc_stem, agency FROM r WHERE {_agency_sql('agency', 'sudoc_stem')}), q AS (SELECT id, {_fold_sql('upper(agency2)', True)} AS agency FROM g)
SELECT id, string_agg(DISTINCT regexp_replace(sudoc_stem, '^([A-Z]+)([0-9]+)$', '\1 \2'), ',' ORDER BY regexp_replace(sudoc_stem, '^([A-Z]+)([0-9]+)$', '\1 \2')) AS stems FROM q JOIN m ON m.agency = q.agency GROUP BY id""", g=V.AGENCIES, r=_AGROWS)  # fmt: skip
def _(s):
    rows = s(V.AGENCIES).select(F.array("sudoc").alias("sudoc"), F.array("agency", "agency2").alias("agency"))
    mapping = ag.agency_map(rows, ACRONYMS, threshold=1)
    return ag.likely_documents(s(V.AGENCIES).select("id", F.array("agency2").alias("agency")), mapping).select("id", joined("stems").alias("stems"))


@query("joi11_record_file_join", "SELECT r.gd_id, r.lineno, f.file_path FROM r, (SELECT DISTINCT file_path FROM r) f WHERE r.file_path = f.file_path", r=V.RECORDS)
def _(s):
    return s.records.join(s.records.select("file_path").distinct(), "file_path").select("gd_id", "lineno", "file_path")




@query("joi12_items_per_file", "SELECT f.file_path, count(r.gd_id) AS c FROM (SELECT DISTINCT file_path FROM r UNION SELECT 'file-none') f LEFT JOIN r ON r.file_path = f.file_path GROUP BY f.file_path", r=V.RECORDS)
def _(s):
    files = s.records.select("file_path").union(s.spark.sql("select 'file-none'")).distinct()
    return files.join(s.records, "file_path", "left").groupBy("file_path").agg(F.count("gd_id").alias("c"))


@query("joi13_key_insert", "SELECT gd_id, 'sudoc' AS attr, '086a' AS marc_field, h.num AS str FROM r JOIN (SELECT 'rec' || CAST(c_custkey AS STRING) AS id, trim(' ' || c_mktsegment || ' ') AS num FROM customer WHERE c_acctbal < 0) h ON h.id = r.record_id", r=V.RECORDS)
def _(s):
    nums = s.table("customer").where("c_acctbal < 0").select(F.concat(F.lit("rec"), F.col("c_custkey").cast("string")).alias("record_id"), F.trim(F.concat(F.lit(" "), "c_mktsegment", F.lit(" "))).alias("str"))
    return s.records.join(nums, "record_id").select("gd_id", F.lit("sudoc").alias("attr"), F.lit("086a").alias("marc_field"), "str")


@query("joi14_update_join", f"WITH m AS ({_CANONICAL}), w AS (SELECT s_suppkey AS gd_id, 'oclc' AS attr, s_suppkey AS o FROM supplier UNION ALL SELECT s_suppkey, 'oclc', s_suppkey // 2 FROM supplier) SELECT DISTINCT gd_id, attr, CAST(coalesce(m.new, o) AS STRING) AS str FROM w LEFT JOIN m ON m.old = w.o", v=V.VOLUMES)
def _(s):
    sup = s.table("supplier")
    rows = sup.select(F.col("s_suppkey").alias("gd_id"), F.explode(F.array("s_suppkey", F.floor(F.col("s_suppkey") / 2))).alias("o"))
    attrs = rows.select("gd_id", F.lit("oclc").alias("attr"), F.lit("035a").alias("marc_field"), F.col("o").cast("string").alias("str"))
    return cl.apply_resolution(attrs, cl.resolve_canonical(s(V.VOLUMES))).select("gd_id", "attr", "str")


@query("srt1_skip_most_frequent", """
WITH c AS (SELECT attr, str, count(DISTINCT gd_id) AS c FROM a WHERE attr IN ('oclc', 'sudoc', 'lccn', 'issn') GROUP BY attr, str), k AS (SELECT *, row_number() OVER (PARTITION BY attr ORDER BY c DESC, str) AS n FROM c)
SELECT a.gd_id, a.attr, a.str FROM (SELECT DISTINCT gd_id, attr, str FROM a) a JOIN k ON k.attr = a.attr AND k.str = a.str WHERE n > 10""", a=V.CLEAN)  # fmt: skip
def _(s):
    return cl.identifier_keys(s.attrs, 10).select("gd_id", "attr", "str")


@query("srt2_sorted_strings", "SELECT DISTINCT str FROM a WHERE attr = 'title' ORDER BY str", a=V.CLEAN)
def _(s):
    return s.attrs.where("attr = 'title'").select("str").distinct().orderBy("str")


@query("srt4_sorted_distinct", "SELECT DISTINCT l_orderkey AS gd_id FROM lineitem ORDER BY 1")
def _(s):
    return s.table("lineitem").select(F.col("l_orderkey").alias("gd_id")).distinct().orderBy("gd_id")


@query("set1_all_attributes", "SELECT DISTINCT attr AS t, gd_id, str FROM a", a=V.CLEAN)
def _(s):
    return s.attrs.select(F.col("attr").alias("t"), "gd_id", "str").distinct()


@query("set2_used_strings", "SELECT str FROM a WHERE attr = 'oclc' UNION SELECT str FROM a WHERE attr = 'title' UNION SELECT str FROM a WHERE attr = 'enumc'", a=V.CLEAN)
def _(s):
    return s.attrs.where("attr in ('oclc', 'title', 'enumc')").select("str").distinct()


@query("set3_append", "SELECT gd_id, attr FROM a WHERE attr = 'lccn' UNION ALL SELECT gd_id, attr FROM a WHERE attr = 'issn'", a=V.CLEAN)
def _(s):
    part = lambda k: s.attrs.where(F.col("attr") == k).select("gd_id", "attr")
    return part("lccn").unionByName(part("issn"))


@query("set4_array_sets", """
WITH b AS (SELECT l_orderkey AS id, list_sort(list_distinct(list(l_returnflag))) AS x, list_sort(list_distinct(list(l_linestatus))) AS y FROM lineitem GROUP BY l_orderkey)
SELECT id, array_to_string(list_sort(list_filter(x, lambda v: list_contains(y, v))), ',') AS both, array_to_string(list_sort(list_filter(x, lambda v: NOT list_contains(y, v))), ',') AS only_x, array_to_string(list_sort(list_distinct(x || y)), ',') AS any_of FROM b""")  # fmt: skip
def _(s):
    b = s.table("lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.collect_set("l_returnflag").alias("x"), F.collect_set("l_linestatus").alias("y"))
    text = lambda c: F.array_join(F.array_sort(c), ",")
    return b.select("id", text(F.array_intersect("x", "y")).alias("both"), text(F.array_except("x", "y")).alias("only_x"), text(F.array_union("x", "y")).alias("any_of"))


@query("set5_separate_imprints", f"""
WITH c AS (SELECT {_CANON} AS imprint, imprint AS original, gov_doc FROM d WHERE gov_doc IN ('0', '1'))
SELECT imprint, CASE WHEN bool_or(gov_doc = '1') AND bool_or(gov_doc = '0') THEN 'both' WHEN bool_or(gov_doc = '1') THEN 'gov' ELSE 'non' END AS side, string_agg(DISTINCT original, '|' ORDER BY original) AS originals
FROM c WHERE regexp_matches(imprint, '[a-z]') GROUP BY imprint""", d=V.DUMP)  # fmt: skip
def _(s):
    return ag.separate_imprints(s(V.DUMP)).select("imprint", "side", F.array_join("originals", "|").alias("originals"))


# ---- aggregations ------------------------------------------------------------------------------------------------


@query("agg1_value_counts", "SELECT attr, str, count(DISTINCT gd_id) AS c FROM a GROUP BY attr, str", a=V.CLEAN)
def _(s):
    # a record's equal rows meet in its part, so a value that many records hold is no part of its own
    return s.dealt_attrs("gd_id").select("gd_id", "attr", "str").distinct().groupBy("attr", "str").agg(F.count("*").alias("c"))


_SEVEN = ["pubdate", "publisher", "sudoc", "oclc", "lccn", "issn", "title"]


@query("agg2_key_groups", f"SELECT DISTINCT string_agg(CAST(gd_id AS STRING), ',' ORDER BY gd_id) AS ids FROM (SELECT gd_id, {_WIDE} FROM a GROUP BY gd_id) GROUP BY publisher, sudoc, lccn, title HAVING count(*) >= 2", a=V.CLEAN)
def _(s):
    wide = s.attrs.groupBy("gd_id").agg(*(F.max(F.when(F.col("attr") == k, F.col("str"))).alias(k) for k in _SEVEN))
    return cl.key_groups(wide, ["publisher", "sudoc", "lccn", "title"]).select(joined("ids").alias("ids"))


_SUMS = "SELECT DISTINCT doc_id AS gd_id, md5(coalesce(text, '')) AS checksum FROM documents"


@query("agg3_checksum_groups", f"SELECT checksum, string_agg(CAST(gd_id AS STRING), ',' ORDER BY gd_id) AS ids FROM ({_SUMS}) GROUP BY checksum")
def _(s):
    sums = s.table("documents").select(F.col("doc_id").alias("gd_id"), F.md5(F.coalesce("text", F.lit(""))).alias("checksum"))
    return cl.checksum_groups(sums).select("checksum", joined("ids").alias("ids"))


@query("agg4_values_per_group", "SELECT r.file_path, attr, count(DISTINCT str) AS d FROM a JOIN r ON r.gd_id = a.gd_id GROUP BY 1, 2", a=V.CLEAN, r=V.RECORDS)
def _(s):
    return s.attrs.join(s.records, "gd_id").groupBy("file_path", "attr").agg(F.count_distinct("str").alias("d"))


@query("agg5_least_per_volume", "SELECT volume_id, min(oclc) AS least FROM v GROUP BY volume_id", v=V.VOLUMES)
def _(s):
    return s(V.VOLUMES).groupBy("volume_id").agg(F.min("oclc").alias("least"))


@query("agg6_distinct_before_after", f"WITH m AS ({_CANONICAL}) SELECT count(DISTINCT v.oclc) AS before, count(DISTINCT coalesce(m.new, v.oclc)) AS after FROM v LEFT JOIN m ON m.old = v.oclc", v=V.VOLUMES)
def _(s):
    v = s(V.VOLUMES)
    both = v.select("oclc").distinct().join(cl.resolve_canonical(v), F.col("oclc") == F.col("old"), "left")
    return both.agg(F.count_distinct("oclc").alias("before"), F.count_distinct(F.coalesce("new", "oclc")).alias("after"))


_BAG = "SELECT gd_id, attr, str, list_distinct(list_filter(string_split_regex(trim(str), '\\s+'), lambda w: w <> '')) AS words FROM t"
_FREQ = "SELECT word, count(*) AS freq FROM (SELECT unnest(words) AS word FROM bag) GROUP BY word"


@query("agg7_word_frequencies", "SELECT word, freq FROM f", t=V.TITLES, bag=_BAG, f=_FREQ)
def _(s):
    return tt.word_weights(tt.word_bags(s(V.TITLES))).select("word", "freq")


@query("agg8_agency_frequencies", "SELECT agency, count(*) AS c FROM (SELECT unnest([agency, agency2]) AS agency FROM g) GROUP BY agency", g=V.AGENCIES)
def _(s):
    return ag.agency_counts(s(V.AGENCIES).select(F.array("agency", "agency2").alias("agency")))


@query("agg9_map_cardinality", f"SELECT agency, count(DISTINCT sudoc_stem) AS c FROM r WHERE {_agency_sql('agency', 'sudoc_stem')} GROUP BY agency", g=V.AGENCIES, r=_AGROWS)
def _(s):
    rows = s(V.AGENCIES).select(F.array("sudoc").alias("sudoc"), F.array("agency", "agency2").alias("agency"))
    blocks = ag.agency_map_lines(ag.agency_map(rows, ACRONYMS, threshold=1))
    return ag.read_agency_map(blocks).groupBy("agency").agg(F.count("*").alias("c"))


@query("agg10_enumeration_stats", "SELECT count(*) FILTER (WHERE n > 0) AS has, count(*) FILTER (WHERE n = 0) AS none, CAST(sum(n) AS BIGINT) AS total, round(sum(n) / count(*), 6) AS mean FROM (SELECT coalesce(len(enumc), 0) AS n FROM lists)", held=_HELD, lists=_LISTS)
def _(s):
    n = _lists(s).select(F.size(F.coalesce("enumc", F.array())).alias("n"))
    return n.agg(F.count_if(F.col("n") > 0).alias("has"), F.count_if(F.col("n") == 0).alias("none"), F.sum("n").alias("total"), F.round(F.sum("n") / F.count("*"), 6).alias("mean"))


@query("agg11_inspect_solos", "SELECT str, string_agg(DISTINCT CAST(a.gd_id AS STRING), ',') AS ids0, count(DISTINCT a.gd_id) AS n FROM a WHERE attr = 'oclc' GROUP BY str HAVING count(DISTINCT a.gd_id) >= 2".replace("string_agg(DISTINCT CAST(a.gd_id AS STRING), ',') AS ids0, ", "array_to_string(list_sort(list_distinct(list(a.gd_id))), ',') AS ids, "), a=V.CLEAN)
def _(s):
    found = lk.inspect_solos(s.records, s.attrs, "oclc", 2)
    return found.select("str", joined("ids").alias("ids"), F.size("ids").cast("bigint").alias("n"))


@query("agg12_ordered_file_counts", "SELECT file_path, count(*) AS c FROM r GROUP BY file_path ORDER BY c DESC, file_path", r=V.RECORDS)
def _(s):
    return s.records.groupBy("file_path").agg(F.count("*").alias("c")).orderBy(F.desc("c"), "file_path")


@query("agg13_shared_values", "SELECT attr, str, count(*) AS n FROM a GROUP BY attr, str HAVING count(*) BETWEEN 2 AND 50", a=V.CLEAN)
def _(s):
    return s.attrs.groupBy("attr", "str").agg(F.count("*").alias("n")).where("n between 2 and 50")


@query("agg14_identity_hash", "SELECT gd_id, md5(array_to_string(list_sort(list_distinct(list(str))), ',')) AS identity FROM a GROUP BY gd_id", a=V.CLEAN)
def _(s):
    return s.attrs.groupBy("gd_id").agg(F.md5(F.array_join(F.array_sort(F.collect_set("str")), ",")).alias("identity"))


_KEEP = f"({_KEEP_SQL}|\\b(?:{'|'.join(ACRONYMS)})\\b)"


@query("agg15_agency_map", f"""
WITH n AS (SELECT agency, count(*) AS c FROM r GROUP BY agency)
SELECT DISTINCT r.sudoc_stem, r.agency FROM r JOIN n ON n.agency = r.agency WHERE {_agency_sql('r.agency', 'r.sudoc_stem')} AND (c >= 4 OR len(list_distinct(regexp_extract_all(r.agency, '{_KEEP}', 1))) >= 2)""", g=V.AGENCIES, r=_AGROWS)  # fmt: skip
def _(s):
    rows = s(V.AGENCIES).select(F.array("sudoc").alias("sudoc"), F.array("agency", "agency2").alias("agency"))
    return ag.agency_map(rows, ACRONYMS, threshold=4)


# ---- clusters ----------------------------------------------------------------------------------------------------

_REACH = """
k AS (SELECT DISTINCT gd_id, attr, str FROM a WHERE attr IN ('oclc', 'sudoc', 'lccn', 'issn')), e AS (SELECT DISTINCT x.gd_id AS u, y.gd_id AS v FROM k x JOIN k y ON x.attr = y.attr AND x.str = y.str),
reach AS (SELECT DISTINCT gd_id, gd_id AS root FROM k UNION SELECT e.v, r.root FROM reach r JOIN e ON e.u = r.gd_id WHERE r.root < e.v),
comp AS (SELECT gd_id, min(root) AS cluster_id FROM reach GROUP BY gd_id)
"""


def _clusters(s: Source) -> DataFrame:
    return cl.identifier_clusters(s.attrs, 0)


@query("clu1_components", f"WITH RECURSIVE {_REACH} SELECT gd_id, cluster_id FROM comp", a=V.CLEAN)
def _(s):
    return _clusters(s)


@query("clu1_components_skipping", f"""WITH RECURSIVE b AS (SELECT attr, str, row_number() OVER (PARTITION BY attr ORDER BY count(DISTINCT gd_id) DESC, str) AS n FROM a0 WHERE attr IN ('oclc', 'sudoc', 'lccn', 'issn') GROUP BY attr, str),
a AS (SELECT a0.* FROM a0 JOIN b ON b.attr = a0.attr AND b.str = a0.str WHERE n > 10), {_REACH} SELECT gd_id, cluster_id FROM comp""", a0=V.CLEAN)
def _(s):
    return cl.identifier_clusters(s.attrs, 10)


@query("clu4_size_gate", f"""WITH RECURSIVE {_REACH} SELECT r.gd_id, c.cluster_id, CASE WHEN n IS NULL THEN 'unkeyed' WHEN n = 1 THEN 'solo' WHEN n > 8 THEN 'huge' ELSE 'cluster' END AS relation
FROM r LEFT JOIN comp c ON c.gd_id = r.gd_id LEFT JOIN (SELECT cluster_id, count(*) AS n FROM comp GROUP BY cluster_id) s ON s.cluster_id = c.cluster_id""", a=V.CLEAN, r=V.RECORDS)  # fmt: skip
def _(s):
    return cl.cluster_relations(s.records, _clusters(s), gate=8)


# of what is left of a cluster, the holders of the value that most records share are taken, until no value is shared
_PEEL = f"""{_REACH},
v AS (SELECT DISTINCT comp.cluster_id, comp.gd_id, CASE attr WHEN 'oclc' THEN 0 WHEN 'sudoc' THEN 1 WHEN 'lccn' THEN 2 WHEN 'issn' THEN 3 ELSE 4 END AS o, str FROM comp JOIN a ON a.gd_id = comp.gd_id WHERE attr IN ('oclc', 'sudoc', 'lccn', 'issn', 'title')),
peel AS (SELECT cluster_id, 0 AS n, CAST([] AS BIGINT[]) AS ids, list(gd_id) AS rest FROM comp GROUP BY cluster_id HAVING count(*) BETWEEN 2 AND 25000
UNION ALL SELECT cluster_id, n + 1, held, list_filter(rest, lambda x: NOT list_contains(held, x)) FROM
 (SELECT p.cluster_id, p.n, p.rest, v.o, v.str, list_sort(list(v.gd_id)) AS held FROM (SELECT *, unnest(rest) AS g FROM peel WHERE len(rest) > 1) p JOIN v ON v.cluster_id = p.cluster_id AND v.gd_id = p.g GROUP BY ALL HAVING count(*) > 1)
 QUALIFY row_number() OVER (PARTITION BY cluster_id ORDER BY len(held) DESC, o, held[1], str) = 1)"""


@query("clu2_related_sets", f"WITH RECURSIVE {_PEEL} SELECT cluster_id, array_to_string(ids, ',') AS ids FROM peel WHERE n > 0", a=V.CLEAN)
def _(s):
    return rl.related_sets(_clusters(s), s.attrs).select("cluster_id", joined("ids").alias("ids"))


@query("clu2_leftovers", f"WITH RECURSIVE {_PEEL} SELECT comp.cluster_id, comp.gd_id FROM comp WHERE cluster_id IN (SELECT cluster_id FROM comp GROUP BY cluster_id HAVING count(*) > 1) AND gd_id NOT IN (SELECT unnest(ids) FROM peel)", a=V.CLEAN)
def _(s):
    c = _clusters(s)
    return rl.leftovers(c, rl.related_sets(c, s.attrs)).select("cluster_id", "gd_id")


_SETS = "SELECT o_orderkey AS gd_id, o_custkey AS set_id FROM {orders}"
_BUCKETS = "SELECT s.set_id, e.str AS enumc, list_sort(list_distinct(list(s.gd_id))) AS ids FROM s LEFT JOIN (SELECT DISTINCT gd_id, str FROM a WHERE attr = 'enumc') e ON e.gd_id = s.gd_id GROUP BY 1, 2"


@query("clu3_duplicates", f"SELECT set_id, enumc, array_to_string(ids, ',') AS ids FROM ({_BUCKETS}) WHERE len(ids) > 1", a=V.CLEAN, s=_SETS)
def _(s):
    return cl.duplicate_sets(s(_SETS), s.attrs).select("set_id", "enumc", joined("ids").alias("ids"))


def _checksum_sql(kinds) -> str:
    cols = ", ".join(f"{k}.str AS {k}" for k in kinds)
    joins = " ".join(f"LEFT JOIN (SELECT gd_id, str FROM a WHERE attr = '{k}') {k} ON {k}.gd_id = r.gd_id" for k in kinds)
    body = ", ".join(f"coalesce({k}, '')" for k in kinds)
    return f"SELECT md5(concat_ws(',', {body})) AS checksum, array_to_string(list_sort(list_distinct(list(gd_id))), ',') AS ids FROM (SELECT r.gd_id, {cols} FROM r {joins}) GROUP BY 1"


@query("clu5_checksums_listed", _checksum_sql(cl.CHECKSUM).replace("FROM r LEFT", "FROM (SELECT * FROM r WHERE file_path <> 'file-P') r LEFT"), a=V.CLEAN, r=V.RECORDS)
def _(s):
    ids = s.records.where("file_path <> 'file-P'")
    return cl.checksum_groups(cl.checksums(s.attrs.join(ids.select("gd_id"), "gd_id", "left_semi"), ids)).select("checksum", joined("ids").alias("ids"))


@query("clu5_checksums_all", _checksum_sql(("pubdate", "publisher", "sudoc", "oclc", "lccn", "issn")), a=V.CLEAN, r=V.RECORDS)
def _(s):
    kinds = ("pubdate", "publisher", "sudoc", "oclc", "lccn", "issn")
    return cl.checksum_groups(cl.checksums(s.attrs, s.records, kinds)).select("checksum", joined("ids").alias("ids"))


_CLASSIFIED = """
x AS (SELECT set_id, str AS enumc, list_sort(list_distinct(list(gd_id))) AS ids FROM (SELECT s.set_id, s.gd_id, e.str FROM s LEFT JOIN (SELECT DISTINCT gd_id, str FROM a WHERE attr = 'enumc') e ON e.gd_id = s.gd_id) GROUP BY 1, 2),
g AS (SELECT set_id, list_sort(list_distinct(flatten(list(ids)))) AS ids, count(*) AS e, bool_or(len(ids) > 1) AS any_two FROM x GROUP BY set_id),
j AS (SELECT set_id, ids, CASE WHEN len(ids) = 1 THEN 'solo' WHEN e = 1 THEN 'duplicates' WHEN e = len(ids) THEN 'related' WHEN any_two THEN 'related*' ELSE 'unclear' END AS relation FROM g),
lines AS (SELECT set_id, relation, ids FROM j UNION ALL SELECT x.set_id, 'duplicates*', x.ids FROM x JOIN j ON j.set_id = x.set_id AND relation = 'related*' WHERE len(x.ids) > 1)
"""


@query("clu6_relations", f"WITH {_CLASSIFIED} SELECT set_id, relation, array_to_string(ids, ',') AS ids FROM lines", a=V.CLEAN, s=_SETS)
def _(s):
    return cl.classify_groups(s(_SETS), s.attrs).select("set_id", "relation", joined("ids").alias("ids"))


@query("clu7_final_files", f"WITH {_CLASSIFIED} SELECT DISTINCT replace(relation, '*', '') AS relation, CASE WHEN relation LIKE 'dup%' THEN round(len(ids) / 2.0, 6) END AS score, array_to_string(ids, ',') AS ids FROM lines", a=V.CLEAN, s=_SETS)
def _(s):
    lines = cl.classify_groups(s(_SETS), s.attrs).withColumn("score", F.round(F.col("n") / F.lit(2.0), 6))
    return cl.final_relations(lines).select("relation", "score", joined("ids").alias("ids"))


_PAIRS = "SELECT DISTINCT l_partkey AS id, l_partkey + l_suppkey + 1 AS other_id, CAST(l_linenumber AS DOUBLE) / 7 - 0.2 AS score FROM {lineitem}"


def _band_sql(test: str) -> str:
    return f"(SELECT id AS u, other_id AS v FROM p WHERE score >= 0 AND {test} UNION SELECT other_id, id FROM p WHERE score >= 0 AND {test})"


@query("clu9_score_bands", f"""WITH RECURSIVE eh AS {_band_sql('score > 0.75')}, el AS {_band_sql('score <= 0.75')},
rh AS (SELECT DISTINCT u AS n, u AS root FROM eh UNION SELECT e.v, r.root FROM rh r JOIN eh e ON e.u = r.n WHERE r.root < e.v), rlo AS (SELECT DISTINCT u AS n, u AS root FROM el UNION SELECT e.v, r.root FROM rlo r JOIN el e ON e.u = r.n WHERE r.root < e.v)
SELECT 'high' AS band, n AS gd_id, min(root) AS cluster_id FROM rh GROUP BY n UNION ALL SELECT 'low', n, min(root) FROM rlo GROUP BY n""", p=_PAIRS)  # fmt: skip
def _(s):
    return tt.band_clusters(s(_PAIRS))


@query("clu8_union_of_pairs", f"""WITH RECURSIVE e AS {_band_sql('true')}, r AS (SELECT DISTINCT u AS n, u AS root FROM e UNION SELECT e.v, r.root FROM r JOIN e ON e.u = r.n WHERE r.root < e.v)
SELECT n AS node, min(root) AS component FROM r GROUP BY n""", p=_PAIRS)  # fmt: skip
def _(s):
    from bibweave.plans.components import connected_components

    return connected_components(s(_PAIRS).where("score >= 0"), "id", "other_id")


@query("clu10_canonical_ids", _CANONICAL, v=V.VOLUMES)
def _(s):
    return cl.resolve_canonical(s(V.VOLUMES))


# ---- scores, rules, evaluation -----------------------------------------------------------------------------------


def _scores(s: Source, **options) -> DataFrame:
    members = s(_SETS)
    n = members.count()
    # values of eight attributes and one for a missing enumeration
    return cl.score_sets(members, s.dealt_attrs("gd_id"), most=(n, 9 * n), **options)


@query("sco1_cluster_scores", """
WITH l AS (SELECT gd_id, attr, array_to_string(list_sort(list_distinct(list(str))), chr(31)) AS value FROM a GROUP BY gd_id, attr), w AS (SELECT * FROM l UNION ALL SELECT DISTINCT gd_id, 'enumc', '' FROM s WHERE gd_id NOT IN (SELECT gd_id FROM l WHERE attr = 'enumc')),
c AS (SELECT set_id, value, count(*) AS v FROM s JOIN w ON w.gd_id = s.gd_id GROUP BY 1, 2), t AS (SELECT set_id, sum(v) AS total, count(*) AS m FROM c GROUP BY 1), n AS (SELECT set_id, count(DISTINCT gd_id) AS n FROM s GROUP BY 1)
SELECT n.set_id, n.n, round(pow(1 - n.n / total + 1.0 / m, 3), 6) AS score FROM n JOIN t ON t.set_id = n.set_id""", a=V.CLEAN, s=_SETS)  # fmt: skip
def _(s):
    return _scores(s).withColumn("score", F.round("score", 6))


@query("agg16_checksum_scores", """
WITH w AS (SELECT gd_id, attr, max(str) AS value FROM a WHERE attr NOT IN ('enumc', 'pubdate') GROUP BY gd_id, attr), c AS (SELECT set_id, value, count(*) AS v FROM s JOIN w ON w.gd_id = s.gd_id GROUP BY 1, 2),
t AS (SELECT set_id, sum(v) AS total, count(*) AS m FROM c GROUP BY 1), n AS (SELECT set_id, count(DISTINCT gd_id) AS n FROM s GROUP BY 1)
SELECT n.set_id, n.n, round(pow(1 - n.n / total + 1.0 / m, 3), 6) AS score FROM n JOIN t ON t.set_id = n.set_id""", a=V.CLEAN, s=_SETS)  # fmt: skip
def _(s):
    return _scores(s, whole_lists=False).withColumn("score", F.round("score", 6))


@query("sco2_title_matches", r"""
WITH tot AS (SELECT sum(freq) AS n FROM f), wt AS (SELECT word, 1 - round(freq / n, 3) AS weight FROM f, tot), last AS (SELECT gd_id, attr, arg_max(words, str) AS words FROM bag GROUP BY 1, 2),
d AS (SELECT DISTINCT gd_id, unnest(words) AS word FROM last), w AS (SELECT d.gd_id, d.word, weight FROM d JOIN wt ON wt.word = d.word), o AS (SELECT gd_id, count(*) AS n, sum(weight) AS s FROM w GROUP BY 1),
p AS (SELECT x.gd_id AS id, y.gd_id AS other_id, count(*) AS k, sum(x.weight) AS o, string_agg(x.word, ',' ORDER BY x.word) AS overlap FROM w x JOIN w y ON x.word = y.word AND x.gd_id < y.gd_id GROUP BY 1, 2)
SELECT id, other_id, round(round((3 * p.o - a.s - b.s) / (a.n + b.n - k), 9), 3) AS score, overlap FROM p JOIN o a ON a.gd_id = id JOIN o b ON b.gd_id = other_id WHERE (k = a.n OR k > 5) AND (3 * p.o - a.s - b.s) / (a.n + b.n - k) > 0.5""", t=V.TITLES, bag=_BAG, f=_FREQ)  # fmt: skip
def _(s):
    found = tt.match_words(tt.word_bags(s(V.TITLES)))
    return found.select("id", "other_id", "score", F.array_join("overlap", ",").alias("overlap"))


_RULED = """
SELECT s_suppkey AS id, CASE WHEN s_suppkey % 4 <> 0 THEN 'o' || CAST(s_suppkey % 13 AS STRING) END AS oclc, CASE WHEN s_suppkey % 3 = 0 THEN 'l' || CAST(s_nationkey AS STRING) END AS lccn,
 CASE WHEN s_suppkey % 5 = 0 THEN 's' || CAST(s_nationkey % 7 AS STRING) END AS issn, 'x' || CAST(s_nationkey % 9 AS STRING) AS sudoc, 't' || CAST(s_suppkey % 11 AS STRING) AS title, 'p' || CAST(s_nationkey % 4 AS STRING) AS publisher,
 CASE WHEN s_suppkey % 2 = 0 THEN 'v' || CAST(s_suppkey % 6 AS STRING) END AS enum_chron FROM {supplier}
"""


def _ruled(s: Source) -> DataFrame:
    rows = s(_RULED)
    lists = [F.when(F.col(c).isNull(), F.array().cast("array<string>")).otherwise(F.array(c)).alias(c) for c in rows.columns[1:]]
    return rows.select("id", *lists)


_EQ = {c: f"(x.{c} IS NOT NULL AND x.{c} = y.{c})" for c in ("oclc", "lccn", "issn", "sudoc", "title", "publisher")} | {"enum": "(x.enum_chron IS NOT DISTINCT FROM y.enum_chron)"}
_ANY = " OR ".join(_EQ[c] for c in ("oclc", "lccn", "issn", "sudoc", "title"))


# the pairs to compare are given: suppliers of one part
_GIVEN = "SELECT DISTINCT x.l_suppkey AS id, y.l_suppkey AS o_id FROM {lineitem} x JOIN {lineitem} y ON x.l_orderkey = y.l_orderkey AND x.l_suppkey < y.l_suppkey"


def _given(s: Source) -> DataFrame:
    """The pairs of ``_GIVEN``; items are dealt by order before they are joined, and pairs before they are made distinct."""
    items = s.table("lineitem").select("l_orderkey", "l_suppkey")
    n = items.count()
    pairs = V.view(s.spark, s.dir, _GIVEN.replace("DISTINCT ", "", 1), lineitem=dealt(items, n, "l_orderkey"))
    # an order has seven items at most, so three pairs for each of them
    return dealt(pairs, 3 * n, "id", "o_id").distinct()


@query("rul1_equal_lists", "SELECT p.id, p.o_id, coalesce(x.oclc = y.oclc, false) OR (x.oclc IS NULL AND y.oclc IS NULL) AS same FROM p JOIN s x ON x.id = p.id JOIN s y ON y.id = p.o_id", s=_RULED, p=_GIVEN)
def _(s):
    p = ru.with_both(_given(s), _ruled(s))
    return p.select("id", "o_id", ru.same_values(F.col("oclc"), F.col("o_oclc")).alias("same"))


@query("rul2_overlapping_lists", f"SELECT p.id, p.o_id, coalesce({_EQ['oclc']}, false) AS oclc, {_EQ['enum']} AS enum FROM p JOIN s x ON x.id = p.id JOIN s y ON y.id = p.o_id", s=_RULED, p=_GIVEN)
def _(s):
    p = ru.with_both(_given(s), _ruled(s))
    return p.select("id", "o_id", ru.shared_value(F.col("oclc"), F.col("o_oclc")).alias("oclc"), ru.shared_value(F.col("enum_chron"), F.col("o_enum_chron"), True).alias("enum"))


_CASCADE = f"""SELECT x.id, y.id AS o_id, CASE WHEN {_EQ['oclc']} THEN CASE WHEN {_EQ['enum']} THEN 'dup' ELSE 'rel' END WHEN {_EQ['lccn']} THEN CASE WHEN {_EQ['enum']} THEN 'dup' ELSE 'unr' END
 WHEN {_EQ['issn']} THEN CASE WHEN {_EQ['enum']} THEN 'dup' ELSE 'rel' END WHEN {_EQ['sudoc']} THEN CASE WHEN {_EQ['title']} AND {_EQ['enum']} THEN 'dup' ELSE 'unr' END ELSE 'unr' END AS verdict FROM s x JOIN s y ON x.id < y.id"""
_REVIEWED = f"""SELECT x.id, y.id AS o_id, CASE WHEN {_EQ['lccn']} THEN CASE WHEN {_EQ['title']} THEN CASE WHEN {_EQ['enum']} THEN 'dup' ELSE 'rev' END ELSE 'unr' END
 WHEN {_EQ['oclc']} THEN CASE WHEN {_EQ['title']} THEN CASE WHEN {_EQ['enum']} THEN 'dup' ELSE 'rel' END ELSE 'unr' END WHEN {_EQ['title']} AND {_EQ['publisher']} THEN CASE WHEN {_EQ['sudoc']} AND {_EQ['enum']} THEN 'dup' ELSE 'rev' END ELSE 'unr' END AS verdict
 FROM s x JOIN s y ON x.id < y.id"""


@query("rul3_cascade", f"SELECT * FROM ({_CASCADE}) WHERE verdict <> 'unr'", s=_RULED)
def _(s):
    return ru.verdict_pairs(_ruled(s))


@query("rul4_cascade_with_review", f"SELECT * FROM ({_REVIEWED}) WHERE verdict <> 'unr'", s=_RULED)
def _(s):
    return ru.verdict_pairs(_ruled(s), ru.CASCADE_WITH_REVIEW)


_FOUND = "SELECT o_custkey AS set_id, o_orderkey AS member FROM {orders}"
_ANSWERS = "SELECT o_custkey * 10 + year(o_orderdate) % 2 AS set_id, o_orderkey AS member FROM {orders}"
_F1 = "SELECT n.set_id, coalesce(max(2 * k / (na + n.nf)), 0) AS f1 FROM (SELECT set_id, count(*) AS nf FROM f GROUP BY 1) n LEFT JOIN (SELECT f.set_id, a.set_id AS answer, count(*) AS k FROM f JOIN a ON a.member = f.member GROUP BY 1, 2) s ON s.set_id = n.set_id LEFT JOIN (SELECT set_id, count(*) AS na FROM a GROUP BY 1) z ON z.set_id = s.answer GROUP BY n.set_id"


@query("sco3_best_f1", f"SELECT set_id, round(f1, 6) AS f1 FROM ({_F1})", f=_FOUND, a=_ANSWERS)
def _(s):
    return ru.best_f1(s(_FOUND), s(_ANSWERS)).withColumn("f1", F.round("f1", 6))


@query("agg17_mean_f1", f"SELECT round((SELECT sum(f1) FROM ({_F1})) / (SELECT count(DISTINCT set_id) FROM a), 6) AS f1", f=_FOUND, a=_ANSWERS)
def _(s):
    return ru.mean_f1(s(_FOUND), s(_ANSWERS)).withColumn("f1", F.round("f1", 6))


# ---- lookup and maintenance --------------------------------------------------------------------------------------

_ASK = "pubdate=1997\npublisher=GPO\nenumc=v.1\n!title\n;"


@query("qry1_conjunctive", "SELECT gd_id FROM a WHERE (attr, str) IN (('pubdate', '1997'), ('publisher', 'GPO'), ('enumc', 'v.1')) GROUP BY gd_id HAVING count(DISTINCT attr) = 3", a=V.CLEAN)
def _(s):
    return lk.find_records(s.attrs, lk.parse_query(_ASK)[0])


@query("qry2_formatted_records", "SELECT gd_id, array_to_string(coalesce(list_sort(list_distinct(list(str) FILTER (WHERE attr = 'title'))), []), '|') AS title, array_to_string(coalesce(list_sort(list_distinct(list(str) FILTER (WHERE attr = 'enumc'))), []), '|') AS enumc FROM a GROUP BY gd_id", a=V.CLEAN)
def _(s):
    found = lk.format_records(s.records.select("gd_id"), s.attrs, ("title", "enumc"))
    return found.select("gd_id", F.array_join("title", "|").alias("title"), F.array_join("enumc", "|").alias("enumc"))


@query("qry3_display", "SELECT r.gd_id, file_path, record_id, attr, marc_field, str FROM r JOIN a ON a.gd_id = r.gd_id WHERE r.gd_id % 50 = 0", a=V.CLEAN, r=V.RECORDS)
def _(s):
    return lk.display_records(s.records.where("gd_id % 50 = 0").select("gd_id"), s.records, s.attrs)


@query("qry4_strings_of_attribute", "SELECT DISTINCT str FROM a WHERE attr = 'publisher' ORDER BY str", a=V.CLEAN)
def _(s):
    return s.attrs.where("attr = 'publisher'").select("str").distinct().orderBy("str")


@query("qry5_membership", "SELECT DISTINCT str FROM a WHERE attr = 'lccn' AND str IN (SELECT 'l' || CAST(c_custkey AS STRING) || '|1997-01-0' || CAST(c_custkey % 9 + 1 AS STRING) FROM customer UNION SELECT str FROM a WHERE gd_id % 50 = 0)", a=V.CLEAN)
def _(s):
    asked = s.attrs.where("gd_id % 50 = 0").select("str").union(s.table("customer").selectExpr("'l' || cast(c_custkey as string) || '|1997-01-0' || cast(c_custkey % 9 + 1 as string)")).distinct()
    return s.attrs.where("attr = 'lccn'").select("str").distinct().join(asked, "str", "left_semi")


@query("dml1_insert_new", "SELECT min(doc_id) AS doc_id, hashsum FROM (SELECT doc_id, sha256(text) AS hashsum FROM documents) WHERE hashsum NOT IN (SELECT sha256(text) FROM documents WHERE lang = 'de') GROUP BY hashsum")
def _(s):
    d = s.table("documents").select("doc_id", "lang", F.sha2("text", 256).alias("hashsum"))
    return ct.new_records(d, d.where("lang = 'de'"), ["doc_id"]).select("doc_id", "hashsum")


@query("dml2_last_row_wins", "SELECT l_orderkey, l_returnflag, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_linenumber DESC, l_partkey DESC) AS n FROM lineitem) WHERE n = 1")
def _(s):
    return ct.last_wins(s.table("lineitem"), ["l_orderkey", "l_returnflag"], ["l_linenumber", "l_partkey"]).select("l_orderkey", "l_returnflag", "l_partkey")


@query("dml4_delete_file", "SELECT a.attr, count(*) AS n FROM a JOIN r ON r.gd_id = a.gd_id WHERE r.file_path <> 'file-P' GROUP BY a.attr", a=V.CLEAN, r=V.RECORDS)
def _(s):
    files = ct.file_ids(s.records)
    return ct.delete_file(s.records.join(files, "file_path"), s.attrs, files.where("file_path = 'file-P'"))[1].groupBy("attr").agg(F.count("*").alias("n"))


@query("dml5_rewrite_values", "SELECT DISTINCT gd_id, attr, CASE WHEN attr = 'title' AND marc_field = '245a' THEN regexp_replace(str, '[0-9]+', '#', 'g') ELSE str END AS str FROM a", a=V.CLEAN)
def _(s):
    return ct.rewrite_values(s.dealt_attrs("gd_id"), "title", "[0-9]+", "#", "marc_field = '245a'").select("gd_id", "attr", "str")


@query("dml6_file_ids", "SELECT file_path, row_number() OVER (ORDER BY file_path) AS file_id FROM (SELECT DISTINCT file_path FROM r)", r=V.RECORDS)
def _(s):
    return ct.file_ids(s.records)
